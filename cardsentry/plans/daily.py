"""The daily cycle: take in a day's drops, update the dimension, run the mart.

Warehouse layout under one root folder (in the cluster's shared storage)::

    <table>/run=R/load_date=D/      what run R wrote for load D
    <table>/run=R/all/              several loads merged, with a load_date column
    load_log/                       numbered commits (see :mod:`cardsentry.plans.log`)

Every delivery writes into folders of its own run and never touches another
run's.  The log names, per load, the folder of each of its tables; readers go
through it.  A delivery appends one commit, last and exclusively: it is
published whole or not at all, a crash at any step leaves the state before it,
and of two deliveries at once the second is made again on the state of the
first, so none is lost.  No result depends on how a session overwrites
partitions.

A transaction belongs to the latest load whose day has begun at its time (to
the first load if it is older).  A second file of a day, or late rows in a
later file, are added to the load they belong to as another part, and the
reports of that load and of the one after it (which reads its last hour as
context) are made anew.  A corrected terminal cut makes the dimension anew from
its day on, and the reports of the loads whose dimension it changes.  A cut or
list that equals the stored one changes nothing.

Content that did not change is named again, not copied: masters by the digest of
their tables, the blacklist and the owners of a day without new ones, and the
dimension's buckets that a cut does not touch.  ``compact`` merges the parts of
many loads, ``vacuum`` removes the folders that no reader can need any more.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.functions import ts_literal
from cardsentry.operators.enrich import card_owners
from cardsentry.operators.rules import LOOKBACK_SECS, fraud_mart
from cardsentry.operators.scd2 import current, empty_history
from cardsentry.plans import dimension
from cardsentry.plans.dimension import Bucket
from cardsentry.plans.log import Log, State
from cardsentry.schemas import REPORT as REPORT_SCHEMA, TERMINAL_KEY
from cardsentry.session import delete_path, hadoop_path, scratch_path, scratch_scope
from cardsentry.sources.masters import Masters, read_masters, write_masters

FACT_TX = "fact_transactions"
FACT_BLACKLIST = "fact_passport_blacklist"
STG_TERMINALS = "stg_terminals"
STG_MASTERS = "stg_masters"
OWNERS = "card_owners"
DIM = "dim_terminals_hist"
REPORT = "rep_fraud"
QUARANTINE = "quarantine"
LOAD_LOG = "load_log"

TX_COLUMNS = ("trans_id", "transaction_date", "card_num", "amount", "oper_type", "oper_result", "terminal")
FACTS_DDL = ("trans_id string, transaction_date timestamp_ntz, card_num string, "
             "amount double, oper_type string, oper_result string, terminal string")
# Folder name of merged loads; hash buckets of a new dimension; tries to publish; merged folders kept apart.
MERGED = "all"
DIM_BUCKETS = 8
ATTEMPTS = 20
MERGED_FOLDERS = 8


@dataclass(frozen=True)
class Load:
    """One published load: the folder of each of its tables, below the table."""

    load_date: str
    report_dt: dt.datetime | None = None
    source: str | None = None
    facts: tuple[str, ...] = ()
    blacklist: str | None = None
    blacklist_digest: str | None = None
    terminals: str | None = None
    cut_digest: str | None = None
    masters: str | None = None
    masters_digest: str | None = None
    owners: str | None = None
    dim: tuple[Bucket, ...] | None = None
    closed: tuple[str, ...] = ()
    report: str | None = None

    @property
    def day(self) -> dt.date:
        return dt.date.fromisoformat(self.load_date)

    def row(self) -> dict:
        return asdict(self) | {"report_dt": self.report_dt and self.report_dt.isoformat(),
                               "dim": None if self.dim is None else [list(b) for b in self.dim]}

    @classmethod
    def of_row(cls, row: dict) -> "Load":
        return cls(**row | {
            "report_dt": row["report_dt"] and dt.datetime.fromisoformat(row["report_dt"]), "facts": tuple(row["facts"]),
            "closed": tuple(row["closed"]), "dim": None if row["dim"] is None else tuple(Bucket(*b) for b in row["dim"])})

    def folders(self) -> dict[str, list[str]]:
        """Every folder that the load names, by table."""
        return {FACT_TX: list(self.facts), FACT_BLACKLIST: [self.blacklist], STG_TERMINALS: [self.terminals],
                STG_MASTERS: [self.masters], OWNERS: [self.owners], REPORT: [self.report],
                DIM: [*(b.ref for b in self.dim or ()), *self.closed]}


@dataclass(frozen=True)
class Store:
    """Folder layout of one warehouse."""

    root: str
    dim_buckets: int = DIM_BUCKETS

    @classmethod
    def fresh(cls, spark: SparkSession, name: str = "warehouse", dim_buckets: int = DIM_BUCKETS) -> "Store":
        return cls(scratch_path(spark, name), dim_buckets)

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def path(self, name: str, ref: str) -> str:
        return f"{self.table(name)}/{ref}"

    def log(self, spark: SparkSession) -> Log:
        return Log(spark, self.table(LOAD_LOG))


def _ref(run: str, day: dt.date) -> str:
    return f"run={run}/load_date={day.isoformat()}"


def _loads_of(state: State) -> dict[dt.date, Load]:
    return {load.day: load for load in (Load.of_row(state.loads[d]) for d in sorted(state.loads))}


def loads(spark: SparkSession, store: Store) -> dict[dt.date, Load]:
    """The published state: every load, by day."""
    return _loads_of(store.log(spark).read())


def _publish(spark: SparkSession, store: Store, after: State, changed: Iterable[Load], source: str | None) -> bool:
    return store.log(spark).commit(after, [x.row() for x in changed], source)


def published_days(spark: SparkSession, store: Store) -> list[dt.date]:
    return list(loads(spark, store))


def published_sources(spark: SparkSession, store: Store) -> set[str]:
    """Tags of every delivery ever published."""
    return store.log(spark).read().sources


# --- reading published tables --------------------------------------------------

def part_paths(store: Store, name: str, parts: Iterable[tuple[Load, str]]) -> tuple[list[str], dict[str, list[str]]]:
    """Folders of one load each, and merged folders with the days to take from them."""
    single, merged = [], {}
    for load, ref in parts:
        if ref.endswith(f"/{MERGED}"):
            merged.setdefault(store.path(name, ref), []).append(load.load_date)
        else:
            single.append(store.path(name, ref))
    return single, merged


def _read_parts(spark: SparkSession, store: Store, name: str, parts: Iterable[tuple[Load, str]], columns: Iterable[str], empty, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    single, merged = part_paths(store, name, parts)
    found = [reader.parquet(*single)] if single else []
    for path, days in merged.items():
        whole = spark.read.parquet(path)
        found.append(whole.where(F.col("load_date").isin(days)))
    if not found:
        return spark.createDataFrame([], empty)
    out = found[0].select(*columns)
    for df in found[1:]:
        out = out.unionByName(df.select(*columns))
    return out


def facts(spark: SparkSession, store: Store, some: Iterable[Load], schema: T.StructType | None = None) -> DataFrame:
    """Transactions of the given loads, all parts."""
    return _read_parts(spark, store, FACT_TX, [(x, ref) for x in some for ref in x.facts], TX_COLUMNS, schema or FACTS_DDL)


def history(spark: SparkSession, store: Store, some: Mapping[dt.date, Load], day: dt.date,
            since: dt.datetime | None = None) -> DataFrame:
    """The dimension as of load ``day``: its open rows and the rows closed by
    every load up to it.

    ``since`` leaves out rows closed by loads before that time: a transaction
    from then on cannot match them."""
    upto = [x for d, x in some.items() if d <= day and x.dim is not None]
    if not upto:
        return empty_history(spark)
    closers = [x for x in upto if since is None or dt.datetime.combine(x.day, dt.time()) >= since or x.day == day]
    return dimension.read_history(spark, store.table(DIM), upto[-1].dim, [c for x in closers for c in x.closed])


def current_terminals(spark: SparkSession, store: Store) -> DataFrame:
    """The live terminals after the newest load."""
    some = loads(spark, store)
    if not some:
        return current(empty_history(spark), dt.datetime.max.replace(year=2900))
    day = max(some)
    return current(history(spark, store, some, day), dt.datetime.combine(day, dt.time()))


def masters_of(spark: SparkSession, store: Store, load: Load) -> Masters:
    root = store.path(STG_MASTERS, load.masters)
    return read_masters(spark, f"{root}/cards", f"{root}/accounts", f"{root}/clients")


def report(spark: SparkSession, store: Store) -> DataFrame:
    """The accumulated report of every published load."""
    parts = [(x, x.report) for x in loads(spark, store).values() if x.report]
    return _read_parts(spark, store, REPORT, parts, REPORT_SCHEMA.names, REPORT_SCHEMA, REPORT_SCHEMA)


def table_rows(spark: SparkSession, store: Store, name: str) -> DataFrame | None:
    """The published rows of a table over all loads (None: nothing yet)."""
    refs = {ref for x in loads(spark, store).values() for ref in x.folders()[name] if ref}
    if not refs:
        return None
    return spark.read.option("recursiveFileLookup", True).parquet(*[store.path(name, r) for r in sorted(refs)])


def show_table(spark: SparkSession, store: Store, name: str, n: int = 20, order_by: tuple[str, ...] = ()) -> None:
    """Print the first ``n`` published rows of a table (never fetched whole)."""
    df = table_rows(spark, store, name)
    if df is None:
        print(f"{name}: no rows")
        return
    (df.orderBy(*order_by) if order_by else df).show(n, truncate=False)


# --- taking in a delivery ----------------------------------------------------

def _owner_load(ts: Column, days: list[dt.date]) -> Column:
    """Day (as text) of the load a transaction belongs to."""
    days = sorted(days)
    begun = [F.when(ts >= ts_literal(d), F.lit(d.isoformat())) for d in reversed(days)]
    return F.coalesce(*begun, F.lit(days[0].isoformat()))


def require_unique(df: DataFrame, key: str, what: str) -> None:
    """Fail on a null or repeated key (a few examples in the message)."""
    bad = df.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).limit(5).collect()
    if bad:
        raise ValueError(f"{what}: null or repeated {key}: {[r[0] for r in bad]}")


def deliver(
    spark: SparkSession,
    store: Store,
    days: Iterable[dt.date],
    transactions: DataFrame | None = None,
    terminals: Mapping[dt.date, DataFrame] | None = None,
    blacklist: Mapping[dt.date, DataFrame] | None = None,
    masters: Masters | None = None,
    report_dt: dt.datetime | Callable[[dt.date], dt.datetime] | None = None,
    source: str | None = None,
    lookback: bool = True,
    replace_facts: bool = False,
) -> list[dt.date]:
    """Take in a delivery for ``days`` and publish it as one step; returns the
    days whose report was made anew.

    ``transactions`` are the rows of all days together, each goes to the load
    it belongs to.  A day without its own cut, blacklist or masters takes
    those of the load before it.  ``replace_facts`` drops the rows that
    ``days`` held before (a corrected re-run); otherwise rows are added.
    ``report_dt`` defaults to the time of the run; a function gives it per
    load.  ``lookback=False`` runs the window rules over each load's rows alone.
    A ``source`` tag that is published already is not taken in again.
    """
    days = sorted(set(days))
    report_dt = report_dt or dt.datetime.now().replace(microsecond=0)
    for _ in range(ATTEMPTS):
        base = store.log(spark).read()
        if source and source in base.sources:
            return []
        with scratch_scope(spark):
            changed, redo = _prepare(spark, store, _loads_of(base), days, transactions, dict(terminals or {}), dict(blacklist or {}),
                                     masters, report_dt, source, lookback, replace_facts)
        if _publish(spark, store, base, changed, source):
            return redo
    raise RuntimeError(f"not published: {ATTEMPTS} times another delivery came first")


def _prepare(spark: SparkSession, store: Store, state: dict[dt.date, Load], days: list[dt.date], transactions: DataFrame | None,
             terminals: dict[dt.date, DataFrame], blacklist: dict[dt.date, DataFrame], masters: Masters | None, report_dt,
             source: str | None, lookback: bool, replace_facts: bool) -> tuple[list[Load], list[dt.date]]:
    """Write everything that a delivery changes on top of ``state`` into a new
    run; the loads to publish and the days whose report is new."""
    run = uuid.uuid4().hex[:12]
    before_all = dict(state)
    for d in days:
        state.setdefault(d, Load(d.isoformat()))
    state = dict(sorted(state.items()))
    redo = set(days)

    # 1. the drops, each in this run's folder
    if replace_facts:
        state |= {d: replace(state[d], facts=()) for d in days}
    if transactions is not None:
        rows = transactions.select(*TX_COLUMNS).withColumn("load_date", _owner_load(F.col("transaction_date"), list(state)))
        root = store.path(FACT_TX, f"run={run}")
        (rows.sortWithinPartitions("load_date", "transaction_date")
         .write.partitionBy("load_date").parquet(root))
        fs, p = hadoop_path(spark, root)
        for name in sorted(s.getPath().getName() for s in fs.listStatus(p)):  # one folder per load
            if name.startswith("load_date="):
                d = dt.date.fromisoformat(name.split("=")[1])
                state[d] = replace(state[d], facts=(*state[d].facts, f"run={run}/{name}"))
                redo.add(d)
    cuts: dict[dt.date, dict[int, str]] = {}
    for d, cut in terminals.items():
        require_unique(cut, TERMINAL_KEY, f"terminal cut of {d}")
        digests = dimension.bucket_digests(cut, store.dim_buckets)
        if state[d].cut_digest != dimension.cut_digest(digests):
            cuts[d] = digests
            cut.write.parquet(store.path(STG_TERMINALS, _ref(run, d)))
            state[d] = replace(state[d], terminals=_ref(run, d), cut_digest=dimension.cut_digest(digests))
    for d, entries in blacklist.items():
        found = dimension.content_digest(entries)
        if state[d].blacklist_digest != found:
            entries.write.parquet(store.path(FACT_BLACKLIST, _ref(run, d)))
            state[d] = replace(state[d], blacklist=_ref(run, d), blacklist_digest=found)
    if masters is not None:
        ref, found = _masters_by_content(spark, store, state, masters, run)
        state |= {d: replace(state[d], masters=ref, masters_digest=found) for d in days}

    # 2. what must be made anew: context of the next load, a changed dimension
    order = list(state)
    redo |= {order[i + 1] for i, d in enumerate(order[:-1]) if d in redo}
    redo_dim = min(cuts, default=None)
    dim_changed = False
    before: Load | None = None
    for d in order:
        load = state[d]
        # 3. the dimension
        if load.dim is None or (redo_dim is not None and d >= redo_dim):
            dim, closed = _apply_cut(spark, store, load, before, run, cuts.get(d))
            dim_changed = dim_changed or (load.dim is not None and (dim, closed) != (load.dim, load.closed))
            load = replace(load, dim=dim, closed=closed)
        if dim_changed:
            redo.add(d)
        if d in redo:
            load = replace(load, report_dt=report_dt(d) if callable(report_dt) else report_dt, source=source, report=_ref(run, d))
            load = _inherit(load, before)
            load = _with_owners(spark, store, load, (before, before_all.get(d)), run)
            state[d] = load
            _make_report(spark, store, state, load, lookback)
        state[d] = before = load
    return [state[d] for d in order if state[d] != before_all.get(d)], sorted(redo)


def _masters_by_content(spark: SparkSession, store: Store, state: Mapping[dt.date, Load], masters: Masters, run: str) -> tuple[str, str]:
    """Folder and digest of the masters: an older one if it holds equal tables."""
    found = "+".join(dimension.content_digests(*masters))
    for load in state.values():
        if load.masters and load.masters_digest == found:
            return load.masters, found
    write_masters(masters, store.path(STG_MASTERS, f"run={run}"))
    return f"run={run}", found


def _apply_cut(spark: SparkSession, store: Store, load: Load, before: Load | None, run: str,
               digests: dict[int, str] | None = None) -> tuple[tuple[Bucket, ...], tuple[str, ...]]:
    """The load's dimension: its cut applied to the open rows before it (no
    cut: the open rows as they are)."""
    opened = (before.dim if before else None) or ()
    if not load.terminals:
        return opened, ()
    cut = spark.read.parquet(store.path(STG_TERMINALS, load.terminals))
    return dimension.apply_cut(spark, store.table(DIM), _ref(run, load.day), opened, cut, dt.datetime.combine(load.day, dt.time()),
                               store.dim_buckets, digests)


def _inherit(load: Load, before: Load | None) -> Load:
    """Masters and blacklist of the load before, by name, where it has none."""
    if load.masters is None:
        if before is None:
            raise ValueError(f"{load.day}: the first load needs masters")
        load = replace(load, masters=before.masters, masters_digest=before.masters_digest)
    if load.blacklist is None and before is not None:
        load = replace(load, blacklist=before.blacklist, blacklist_digest=before.blacklist_digest)
    return load


def _with_owners(spark: SparkSession, store: Store, load: Load, known: Iterable[Load | None], run: str) -> Load:
    """The owner table of the load's masters and blacklist: that of a ``known``
    load (the one before, or this one as published) if both are the same."""
    for other in known:
        if other is not None and other.owners and (other.masters, other.blacklist_digest) == (load.masters, load.blacklist_digest):
            return replace(load, owners=other.owners)
    listed = (spark.createDataFrame([], "date timestamp_ntz, passport string") if load.blacklist is None
              else spark.read.parquet(store.path(FACT_BLACKLIST, load.blacklist)))
    ref = _ref(run, load.day)
    card_owners(*masters_of(spark, store, load), listed).write.parquet(store.path(OWNERS, ref))
    return replace(load, owners=ref)


def _make_report(spark: SparkSession, store: Store, state: Mapping[dt.date, Load], load: Load, lookback: bool) -> None:
    day = load.day
    start = dt.datetime.combine(day, dt.time()) - dt.timedelta(seconds=LOOKBACK_SECS)
    owners = spark.read.parquet(store.path(OWNERS, load.owners))

    rows = facts(spark, store, [load]).withColumn("_ctx", F.lit(False))
    earlier = [x for d, x in state.items() if d < day]
    if earlier and lookback:
        # Only the loads whose time reaches into the hour before this one.
        near = [x for x, nxt in zip(earlier, [*earlier[1:], None], strict=True)
                if nxt is None or dt.datetime.combine(nxt.day, dt.time()) > start]
        ctx = facts(spark, store, near).where(F.col("transaction_date") >= ts_literal(start)).withColumn("_ctx", F.lit(True))
        rows = rows.unionByName(ctx)
    # The first load may hold rows of any age, the others none before their day.
    hist = history(spark, store, state, day, since=start if earlier else None)
    fraud_mart(rows, owners, hist, load.report_dt, context="_ctx").write.parquet(store.path(REPORT, load.report))


def run_day(spark: SparkSession, store: Store, day: dt.date, transactions: DataFrame, blacklist: DataFrame,
            terminals: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
            report_dt: dt.datetime | Callable[[dt.date], dt.datetime] | None = None, lookback: bool = True,
            source: str | None = None) -> list[dt.date]:
    """Load (or load again, corrected) one day with all its drops."""
    return deliver(spark, store, [day], transactions, {day: terminals}, {day: blacklist}, Masters(cards, accounts, clients),
                   report_dt, source, lookback, replace_facts=True)


# --- upkeep --------------------------------------------------------------------

def _merge(spark: SparkSession, store: Store, name: str, parts: list[tuple[Load, str]], columns: Iterable[str]) -> dict[str, str]:
    """Write the given parts into one folder, by load; the new folder of each load."""
    run = uuid.uuid4().hex[:12]
    single, merged = part_paths(store, name, parts)
    columns = [*columns, "load_date"]
    found = []
    if single:
        found.append(spark.read.option("basePath", store.table(name)).parquet(*single).withColumn("load_date", F.col("load_date").cast("string")).select(*columns))
    found += [spark.read.parquet(path).where(F.col("load_date").isin(days)).select(*columns) for path, days in merged.items()]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    # Sorted by load, so the files' statistics lead a reader of one load to its
    # rows; a load has many ranges, dealt by the rows' time and hash.
    order = ["load_date", *[f.name for f in out.schema if isinstance(f.dataType, T.TimestampNTZType)][:1]]
    ref = f"run={run}/{MERGED}"
    out.repartitionByRange(*order, F.xxhash64(*columns)).sortWithinPartitions(*order).write.parquet(store.path(name, ref))
    return {load.load_date: ref for load, _ in parts}


def compact(spark: SparkSession, store: Store, least: int = 2) -> int:
    """Merge the folders of single loads and parts of the facts and of the
    report into one folder each if there are at least ``least``; returns how
    many folders were merged.  Merged folders stay as they are until there are
    more than MERGED_FOLDERS of them."""
    for _ in range(ATTEMPTS):
        base = store.log(spark).read()
        state = _loads_of(base)
        changed, n = dict(state), 0
        for name, columns in ((FACT_TX, TX_COLUMNS), (REPORT, REPORT_SCHEMA.names)):
            parts = [(x, ref) for x in state.values() for ref in x.folders()[name] if ref]
            whole = {ref for _, ref in parts if ref.endswith(f"/{MERGED}")}
            loose = [(x, ref) for x, ref in parts if ref not in whole]
            if len(loose) < least:
                continue
            # A load with a merged part and loose ones is read from both.
            todo = parts if len(whole) >= MERGED_FOLDERS else loose
            moved = _merge(spark, store, name, todo, columns)
            gone = {ref for _, ref in todo}
            n += len(gone)
            for day, ref in moved.items():
                d = dt.date.fromisoformat(day)
                if name == FACT_TX:
                    changed[d] = replace(changed[d], facts=(*[r for r in changed[d].facts if r not in gone], ref))
                else:
                    changed[d] = replace(changed[d], report=ref)
        rows = [changed[d] for d in changed if changed[d] != state[d]]
        if not rows or _publish(spark, store, base, rows, None):
            return n
    raise RuntimeError(f"not compacted: {ATTEMPTS} times a delivery came first")


def vacuum(spark: SparkSession, store: Store, retain: dt.timedelta = dt.timedelta(days=7)) -> list[str]:
    """Remove the run folders that no log row of the last ``retain`` names, and
    the log files behind its checkpoint; returns the removed paths.

    A reader that started within ``retain`` keeps every folder it may read;
    folders younger than that stay too, so a delivery under way is safe."""
    log = store.log(spark)
    horizon = dt.datetime.now() - retain
    rows, done = log.since(horizon)
    named = {(table, ref.split("/")[0]) for row in rows for table, refs in Load.of_row(row).folders().items() for ref in refs if ref}
    removed = []
    for table in (FACT_TX, FACT_BLACKLIST, STG_TERMINALS, STG_MASTERS, OWNERS, DIM, REPORT):
        fs, p = hadoop_path(spark, store.table(table))
        for status in fs.listStatus(p) if fs.exists(p) else []:
            name = status.getPath().getName()
            if (table, name) not in named and status.getModificationTime() <= horizon.timestamp() * 1000:
                delete_path(spark, store.path(table, name))
                removed.append(store.path(table, name))
    log.drop(done)
    return removed
