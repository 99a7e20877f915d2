"""Terminal dimension with full version history (SCD2), without UPDATE.

History rows: the tracked attributes, ``deleted_flg`` (1 = tombstone),
``effective_from`` and ``effective_to`` (``OPEN_END`` while open).  A daily
full cut (snapshot) is applied as of a business time ``as_of``:

* new key: open a version from ``as_of``;
* changed key (any attribute differs, null-safe): close the open version at
  ``as_of - 1 s`` and open the new one;
* deleted key (live key missing from the cut): close it and open a tombstone
  carrying the last known attributes;
* returning key (open tombstone, key back in the cut): close the tombstone
  and open the new version, so a key never has two open rows.

``scd2_apply`` does all of it with one full outer join of the open rows and
the snapshot on the key (one shuffle by key, or none when both sides are
bucketed alike), classifies with ``when`` and emits the 1–2 resulting rows
per key with ``explode``.  Closed rows pass through untouched, so the cost
of a day follows the open rows and the cut, not the whole history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.functions import attrs_changed, seconds, ts_literal
from cardsentry.schemas import OPEN_END, TERMINAL_ATTRS, TERMINAL_KEY, TERMINALS_HIST
from cardsentry.session import materialize

NEW, DELETED, CHANGED, SAME = "new", "deleted", "changed", "same"


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TERMINALS_HIST)


def current(hist: DataFrame, as_of, key: str = TERMINAL_KEY,
            attrs: Iterable[str] = TERMINAL_ATTRS) -> DataFrame:
    """Live rows at ``as_of``: valid then (closed range) and not a tombstone."""
    at = as_of if isinstance(as_of, Column) else ts_literal(as_of)
    return hist.where(
        (F.col("deleted_flg") == 0) & at.between(F.col("effective_from"), F.col("effective_to"))
    ).select(key, *attrs)


def snapshot_diff(current_rows: DataFrame, snapshot: DataFrame, key: str = TERMINAL_KEY,
                  attrs: Iterable[str] = TERMINAL_ATTRS) -> DataFrame:
    """Classify every key of the current state and the new cut.

    Returns ``change_kind`` (new, deleted, changed, same), the key and the
    attributes: the new ones, or the last known ones for a deleted key.
    One full outer join instead of two anti joins and an inner join.
    """
    attrs = tuple(attrs)
    c, s = current_rows.alias("c"), snapshot.alias("s")
    j = s.join(c, F.col(f"s.{key}") == F.col(f"c.{key}"), "full_outer")
    in_c, in_s = F.col(f"c.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    kind = (
        F.when(~in_c, F.lit(NEW))
        .when(~in_s, F.lit(DELETED))
        .when(attrs_changed("s", "c", attrs), F.lit(CHANGED))
        .otherwise(F.lit(SAME))
    )
    return j.select(
        kind.alias("change_kind"),
        F.coalesce(F.col(f"s.{key}"), F.col(f"c.{key}")).alias(key),
        *[F.when(in_s, F.col(f"s.{a}")).otherwise(F.col(f"c.{a}")).alias(a) for a in attrs],
    )


def scd2_apply(hist: DataFrame, snapshot: DataFrame, as_of, key: str = TERMINAL_KEY,
               attrs: Iterable[str] = TERMINAL_ATTRS) -> DataFrame:
    """History after applying the full cut ``snapshot`` at ``as_of``.

    ``as_of`` must be later than every ``effective_from`` already in ``hist``
    (the daily cycle checks it).  The snapshot must hold each key once.
    """
    attrs = tuple(attrs)
    at = as_of if isinstance(as_of, Column) else ts_literal(as_of)
    open_end = ts_literal(OPEN_END)
    is_open = F.col("effective_to") == open_end
    closed = hist.where(~is_open)
    o = hist.where(is_open).alias("o")
    s = snapshot.select(key, *attrs).alias("s")
    j = o.join(s, F.col(f"o.{key}") == F.col(f"s.{key}"), "full_outer")

    in_o, in_s = F.col(f"o.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    live = F.col("o.deleted_flg") == 0
    changed = attrs_changed("o", "s", attrs)
    unchanged_live = in_o & in_s & live & ~changed
    # The open row stays open when nothing happened to it; otherwise it closes.
    keep_open = unchanged_live | (in_o & ~live & ~in_s)
    opens_new = in_s & ~unchanged_live
    tombstone = in_o & live & ~in_s

    def version(prefix: str, flag: Column, frm: Column, to: Column) -> Column:
        return F.struct(
            F.col(f"{prefix}.{key}").alias(key),
            *[F.col(f"{prefix}.{a}").alias(a) for a in attrs],
            flag.cast("int").alias("deleted_flg"),
            frm.alias("effective_from"),
            to.alias("effective_to"),
        )

    emitted = F.array(
        F.when(in_o, version("o", F.col("o.deleted_flg"), F.col("o.effective_from"),
                             F.when(keep_open, F.col("o.effective_to")).otherwise(at - seconds(1)))),
        F.when(opens_new, version("s", F.lit(0), at, open_end)),
        F.when(tombstone, version("o", F.lit(1), at, open_end)),
    )
    fresh = (
        j.select(F.explode(emitted).alias("v"))
        .where(F.col("v").isNotNull())
        .select("v.*")
    )
    cols = [key, *attrs, "deleted_flg", "effective_from", "effective_to"]
    return closed.select(*cols).unionByName(fresh.select(*cols))


def history_from_cuts(snapshots: DataFrame, key: str = TERMINAL_KEY,
                      attrs: Iterable[str] = TERMINAL_ATTRS,
                      days: Iterable[dt.date | dt.datetime] | None = None) -> DataFrame:
    """The history that folding every cut in ``as_of`` order would give, in
    one pass (backfill): one shuffle by key and two windows, no key × day grid.

    Per key and cut, the previous and next cut *days* come from the list of
    cut days (one row per day, broadcast: it grows by one row a day).  A key
    present on a cut opens a version when it was not present on the previous
    cut day or its attributes changed; it leaves a tombstone on the next cut
    day when it is missing there.  ``effective_to`` is the next version's
    start minus one second.
    """
    attrs = tuple(attrs)
    spark = snapshots.sparkSession
    if days is None:
        days = [r[0] for r in snapshots.select("as_of").distinct().collect()]
    day_list = sorted(d if isinstance(d, dt.datetime) else dt.datetime.combine(d, dt.time())
                      for d in days)
    nxt = day_list[1:] + [None]
    prv = [None] + day_list[:-1]
    calendar = spark.createDataFrame(
        list(zip(day_list, prv, nxt)),
        "as_of timestamp_ntz, prev_cut timestamp_ntz, next_cut timestamp_ntz")
    cuts = snapshots.select("as_of", key, *attrs).join(F.broadcast(calendar), "as_of")

    w = Window.partitionBy(key).orderBy("as_of")
    seq = cuts.select(
        "*",
        F.lag("as_of").over(w).alias("_p_as_of"),
        F.lead("as_of").over(w).alias("_n_as_of"),
        *[F.lag(a).over(w).alias(f"_p_{a}") for a in attrs],
    )
    changed = reduce(lambda acc, a: acc | ~F.col(a).eqNullSafe(F.col(f"_p_{a}")), attrs, F.lit(False))
    starts = F.col("_p_as_of").isNull() | (F.col("_p_as_of") != F.col("prev_cut")) | changed
    leaves = F.col("next_cut").isNotNull() & (
        F.col("_n_as_of").isNull() | (F.col("_n_as_of") != F.col("next_cut")))

    def version(flag: int, frm: str) -> Column:
        return F.struct(*[F.col(a).alias(a) for a in attrs],
                        F.lit(flag).alias("deleted_flg"), F.col(frm).alias("effective_from"))

    # The key stays a plain column so the second window reuses the shuffle.
    versions = seq.select(key, F.explode(F.array(
        F.when(starts, version(0, "as_of")), F.when(leaves, version(1, "next_cut")),
    )).alias("v")).where(F.col("v").isNotNull()).select(key, "v.*")
    w2 = Window.partitionBy(key).orderBy("effective_from")
    return versions.select(
        key, *attrs, "deleted_flg", "effective_from",
        F.coalesce(F.lead("effective_from").over(w2) - seconds(1), ts_literal(OPEN_END))
        .alias("effective_to"),
    )


def changes_from_cuts(snapshots: DataFrame, days: Iterable[dt.date | dt.datetime], key: str = TERMINAL_KEY,
                      attrs: Iterable[str] = TERMINAL_ATTRS) -> DataFrame:
    """Every new, deleted and changed key of every cut against the cut before
    it (``as_of``, ``change_kind``, key, attributes; the last known ones for a
    deleted key), in one window over the cuts.  On the first cut every key is
    new."""
    attrs = tuple(attrs)
    day_list = sorted(d if isinstance(d, dt.datetime) else dt.datetime.combine(d, dt.time()) for d in days)
    calendar = snapshots.sparkSession.createDataFrame(
        list(zip(day_list, [None, *day_list[:-1]], [*day_list[1:], None])),
        "as_of timestamp_ntz, prev_cut timestamp_ntz, next_cut timestamp_ntz")
    # One row per cut day.
    cuts = snapshots.select("as_of", key, *attrs).join(F.broadcast(calendar), "as_of")
    w = Window.partitionBy(key).orderBy("as_of")
    seq = cuts.select("*", F.lag("as_of").over(w).alias("_p"), F.lead("as_of").over(w).alias("_n"),
                      *[F.lag(a).over(w).alias(f"_p_{a}") for a in attrs])
    differs = reduce(lambda acc, a: acc | ~F.col(a).eqNullSafe(F.col(f"_p_{a}")), attrs, F.lit(False))
    follows = F.col("_p").eqNullSafe(F.col("prev_cut")) & F.col("prev_cut").isNotNull()
    leaves = F.col("next_cut").isNotNull() & ~F.col("_n").eqNullSafe(F.col("next_cut"))

    def change(kind: str, at: str) -> Column:
        return F.struct(F.lit(kind).alias("change_kind"), F.col(at).alias("as_of"))

    events = F.array(F.when(~follows, change(NEW, "as_of")).when(differs, change(CHANGED, "as_of")),
                     F.when(leaves, change(DELETED, "next_cut")))
    return seq.select(F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e"), key, *attrs).select(
        "e.as_of", "e.change_kind", key, *attrs)


def build_history(spark: SparkSession, snapshots: DataFrame, days: Iterable[dt.date | dt.datetime],
                  hist: DataFrame | None = None, cut_lineage: bool = True) -> DataFrame:
    """Fold the daily cuts (``as_of`` column) into the history, day by day.

    Each day's result is written into the shared folder
    (``spark.checkpoint.dir``) and read back, so the plan does not grow with
    the days.
    """
    h = hist if hist is not None else empty_history(spark)
    for d in days:
        cut = snapshots.where(F.col("as_of") == ts_literal(d)).drop("as_of")
        h = scd2_apply(h, cut, d)
        if cut_lineage:
            h = materialize(h, "history-fold")
    return h
