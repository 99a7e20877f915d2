"""Point-in-time join of transactions to the terminal dimension.

Each version covers ``[effective_from, effective_to + 1 s)`` (versions are
closed at the next version's start minus one second, so the half-open range
leaves no hole for fractional times).  The first version of a terminal also
reaches back without bound, so every transaction of a known terminal matches
exactly one version; tombstones match too (they carry the last known city).

Two ways, one result:

* ``join``: equi-join on the terminal id plus a range residual.  The dimension
  is a stored table of known bytes, so Spark broadcasts it below its threshold.
  The fan-out before the residual is the number of versions per terminal.
* ``sweep``: versions and transactions in one stream, range partitioned and
  sorted by (terminal, time); each transaction takes the last version before it.
  No join and no fan-out; a terminal with most transactions or with thousands of
  versions covers many partitions, and the version that holds at a partition's
  start is handed on from the ones before it.

Left open, the terminal with most versions decides: up to MAX_VERSIONS of them
the join, else the sweep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.functions import seconds, ts_literal
from cardsentry.operators.sequence import longest_group
from cardsentry.schemas import TERMINAL_ATTRS, TERMINAL_KEY
from cardsentry.session import materialize

_FAR_PAST = "0001-01-01 00:00:00"

# Versions of one terminal that a transaction may be compared with.
MAX_VERSIONS = 32

VERSION_COLUMNS = (*TERMINAL_ATTRS, "deleted_flg", "effective_from", "effective_to")


def version_ranges(hist: DataFrame) -> DataFrame:
    """History with the lookup range ``[_lo, _hi)`` of every version."""
    first = F.min("effective_from").over(Window.partitionBy(TERMINAL_KEY))
    return hist.select(
        TERMINAL_KEY,
        *VERSION_COLUMNS,
        F.when(F.col("effective_from") == first, ts_literal(_FAR_PAST))
        .otherwise(F.col("effective_from")).alias("_lo"),
        (F.col("effective_to") + seconds(1)).alias("_hi"),
    )


def join_terminal_asof(
    tx: DataFrame,
    hist: DataFrame,
    how: str = "left",
    ts_col: str = "transaction_date",
    terminal_col: str = "terminal",
    mode: str = "point_in_time",
    method: str | None = None,
) -> DataFrame:
    """Transactions with the terminal version valid at their time.

    ``how='left'`` keeps transactions of unknown terminals with null version
    columns and ``known = false``; ``how='inner'`` drops them.
    ``mode='all_versions'`` joins every version of the terminal regardless of
    time, as the original statements literally do (it repeats rows after a
    change; kept only for comparison).  ``method`` is ``join``, ``sweep`` or
    left open.
    """
    if mode == "point_in_time":
        if method is None:
            method = "join" if longest_group(hist, [TERMINAL_KEY]) <= MAX_VERSIONS else "sweep"
        if method == "sweep":
            out = _sweep(tx, hist, ts_col, terminal_col)
            return out if how == "left" else out.where("known")
        v = version_ranges(hist)
    elif mode == "all_versions":
        v = hist.select(TERMINAL_KEY, *VERSION_COLUMNS)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    v = v.withColumnRenamed(TERMINAL_KEY, "_tid")
    cond = F.col(terminal_col) == F.col("_tid")
    if mode == "point_in_time":
        cond = cond & (F.col(ts_col) >= F.col("_lo")) & (F.col(ts_col) < F.col("_hi"))
    out = tx.join(v, cond, how)
    out = out.withColumn("known", F.col("_tid").isNotNull())
    return out.drop("_tid", "_lo", "_hi")


def _sweep(tx: DataFrame, hist: DataFrame, ts_col: str, terminal_col: str) -> DataFrame:
    """Every transaction with the last version of its terminal before it, if
    that still holds at its time."""
    spark = tx.sparkSession
    version = F.struct(*VERSION_COLUMNS, (F.col("effective_to") + seconds(1)).alias("_hi"))
    versions = hist.select(F.col(TERMINAL_KEY).alias("_tid"), F.col("effective_from").alias("_at"), version.alias("v"))
    # The first version of a terminal reaches back.
    first = versions.groupBy("_tid").agg(F.min(F.struct("_at", "v")).alias("f")).select("_tid", ts_literal(_FAR_PAST).alias("_at"), "f.v")
    own = versions.schema["v"].dataType
    no_tx = F.lit(None).cast(tx.schema).alias("tx")
    events = tx.select(
        F.col(terminal_col).alias("_tid"), F.col(ts_col).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(own).alias("v"), F.struct(*tx.columns).alias("tx"),
    ).unionByName(versions.unionByName(first).select("_tid", "_at", F.lit(0).alias("_kind"), "v", no_tx))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["_tid", "_at", "_kind"]
    placed = materialize(events.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()).sortWithinPartitions(*order), "asof-rows")
    # Per partition its last terminal and that terminal's last version there: one row each.
    tails = {r._part: r for r in placed.groupBy("_part").agg(
        F.max("_tid").alias("_tid"), F.max(F.when(F.col("v").isNotNull(), F.struct("_tid", "_at", "v"))).alias("last")).collect()}
    handed, held = [], None
    for part in sorted(tails):
        if held is not None:
            handed.append((part, *held))
        last = tails[part].last
        if last is not None and last._tid == tails[part]._tid:
            held = last._tid, last._at, last.v
        elif held is not None and held[0] != tails[part]._tid:
            held = None
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_tid", T.StringType()), T.StructField("_at", T.TimestampNTZType()), T.StructField("v", own)])
    context = spark.createDataFrame(handed, schema).select("_tid", "_at", F.lit(0).alias("_kind"), "v", no_tx, "_part")
    w = Window.partitionBy("_part", "_tid").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = placed.unionByName(context).withColumn("_v", F.last("v", ignorenulls=True).over(w)).where("tx is not null")
    holds = F.col("_v").isNotNull() & (F.col("_at") < F.col("_v._hi"))
    return seen.select("tx.*", *[F.when(holds, F.col(f"_v.{c}")).alias(c) for c in VERSION_COLUMNS], F.coalesce(holds, F.lit(False)).alias("known"))
