"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each over the whole fixture tables.  Their DuckDB twins are in
:mod:`cardsentry.plans.oracle` under the same names."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.functions import ts_literal
from cardsentry.operators import rules
from cardsentry.operators.asof import join_terminal_asof
from cardsentry.operators.enrich import enrich, owners_of
from cardsentry.operators.scd2 import CHANGED, DELETED, NEW, changes_from_cuts, current, history_from_cuts
from cardsentry.plans import daily, dimension
from cardsentry.plans.testviews import EMPTY_DAY, Warehouse, hot_card, hot_terminal, moving_terminal, set_e, set_l
from cardsentry.schemas import TERMINAL_ATTRS, TERMINAL_KEY
from cardsentry.session import materialize, scratch_path
from cardsentry.sources import delimited
from cardsentry.sources.masters import Masters
from cardsentry.streaming import daily_stream

Query = Callable[[SparkSession, str], DataFrame]


def _chain(w: Warehouse, with_blacklist: bool = False) -> DataFrame:
    return enrich(w.transactions, w.cards, w.accounts, w.clients,
                  blacklist=w.blacklist if with_blacklist else None)


def _owners(w: Warehouse, with_blacklist: bool = False) -> DataFrame:
    return owners_of(w.cards, w.accounts, w.clients, w.blacklist if with_blacklist else None)


def _history(spark: SparkSession, w: Warehouse) -> DataFrame:
    """The dimension of the fixture, built once and stored in the shared folder."""
    return materialize(history_from_cuts(w.snapshots, days=w.snapshot_days), "terminals-history")


def _mart(spark: SparkSession, w: Warehouse, longest: int = rules.LONGEST_IN_TASK) -> DataFrame:
    return rules.fraud_mart(w.transactions, _owners(w, with_blacklist=True), _history(spark, w), w.report_dt, longest=longest)


def enriched_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chain(set_e(spark, sf_dir)).select(
        "trans_id", "transaction_date", "card_num", "amount", "oper_result", "terminal",
        "account", "client_id", "passport_num", "fio", "phone",
    )


def fraud_expired_passport(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = set_e(spark, sf_dir)
    return rules.expired_passport(_chain(w), w.report_dt)


def fraud_blocked_passport(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = set_e(spark, sf_dir)
    return rules.blocked_passport(_chain(w, with_blacklist=True), None, w.report_dt)


def fraud_invalid_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = set_e(spark, sf_dir)
    return rules.invalid_agreement(_chain(w), w.report_dt)


def fraud_city_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = set_e(spark, sf_dir)
    return rules.city_hop(w.transactions, _owners(w), _history(spark, w), w.report_dt)


def fraud_amount_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = set_e(spark, sf_dir)
    return rules.amount_probe(w.transactions, _owners(w), _history(spark, w), w.report_dt)


def fraud_city_hop_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule 3 with the original's literal join to every terminal version."""
    w = set_e(spark, sf_dir)
    return rules.city_hop(w.transactions, _owners(w), _history(spark, w), w.report_dt, dim_mode="all_versions")


def fraud_amount_probe_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule 4 with the original's literal join to every terminal version."""
    w = set_e(spark, sf_dir)
    return rules.amount_probe(w.transactions, _owners(w), _history(spark, w), w.report_dt, dim_mode="all_versions")


def fraud_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, set_e(spark, sf_dir))


def fraud_mart_hot_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rules with nine tenths of all rows on one card in one hour, its
    sequence cut into ranges at every size of the table."""
    return _mart(spark, hot_card(spark, sf_dir), longest=0)


def terminals_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full history; ``effective_to`` is shown as text because the open
    end (year 2999) is beyond what pandas timestamps can hold."""
    return _open_end_as_text(_history(spark, set_e(spark, sf_dir)))


def _open_end_as_text(hist: DataFrame) -> DataFrame:
    return hist.withColumn("effective_to", F.date_format("effective_to", "yyyy-MM-dd HH:mm:ss"))


def terminals_history_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history by applying one cut after the other to the stored
    dimension, touched buckets only."""
    w = set_e(spark, sf_dir)
    table = scratch_path(spark, "dimension")
    buckets, closed = (), []
    for d in w.snapshot_days:
        cut = w.snapshots.where(F.col("as_of") == ts_literal(d)).drop("as_of")
        buckets, more = dimension.apply_cut(spark, table, f"load_date={d}", buckets, cut, _midnight(d), daily.DIM_BUCKETS)
        closed += more
    return _open_end_as_text(dimension.read_history(spark, table, buckets, closed))


def terminals_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live dimension at every load day (must equal that day's cut)."""
    w = set_e(spark, sf_dir)
    hist = _history(spark, w)
    return reduce(DataFrame.unionByName, [
        current(hist, d).select(ts_literal(d).alias("as_of"), TERMINAL_KEY, *TERMINAL_ATTRS)
        for d in w.snapshot_days
    ])


def _daily_diffs(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """New / deleted / changed terminals of every load day against the cut before."""
    w = set_e(spark, sf_dir)
    changes = changes_from_cuts(w.snapshots, w.snapshot_days)
    return changes.where(F.col("change_kind") == kind).select("as_of", TERMINAL_KEY, *TERMINAL_ATTRS)


def terminals_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_diffs(spark, sf_dir, NEW)


def terminals_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_diffs(spark, sf_dir, DELETED)


def terminals_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_diffs(spark, sf_dir, CHANGED)


def _asof(transactions: DataFrame, hist: DataFrame) -> DataFrame:
    return join_terminal_asof(transactions, hist, how="left").select(
        "trans_id", "transaction_date", "terminal", "terminal_city",
        F.coalesce(F.col("deleted_flg") == 1, F.lit(False)).alias("tombstone"),
        "effective_from", "known",
    )


def transactions_asof_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = set_e(spark, sf_dir)
    return _asof(w.transactions, _history(spark, w))


def transactions_asof_hot_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine tenths of all transactions at one terminal with a version per
    customer."""
    w = hot_terminal(spark, sf_dir)
    return _asof(w.transactions, materialize(moving_terminal(spark, sf_dir), "terminals-history"))


def _load_slices(w: Warehouse):
    """One load per cut day: the transactions from that day up to the next
    cut (the first load also takes anything earlier, the last anything later)."""
    ts = F.col("transaction_date")
    days = w.snapshot_days
    for i, d in enumerate(days):
        cond = F.lit(True)
        if i > 0:
            cond = cond & (ts >= ts_literal(d))
        if i + 1 < len(days):
            cond = cond & (ts < ts_literal(days[i + 1]))
        cut = w.snapshots.where(F.col("as_of") == ts_literal(d)).drop("as_of")
        yield d, w.transactions.where(cond), cut


def _midnight(day: dt.date) -> dt.datetime:
    return dt.datetime.combine(day, dt.time())


def run_cycle(spark: SparkSession, w: Warehouse, store: daily.Store | None = None, lookback: bool = True) -> daily.Store:
    """Run the daily cycle over every load of the fixture, reports dated by load day."""
    store = store or daily.Store.fresh(spark, "cycle")
    for d, tx, cut in _load_slices(w):
        daily.run_day(spark, store, d, tx, w.blacklist, cut, w.cards, w.accounts, w.clients, _midnight, lookback)
    return store


def report_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accumulated report after running every daily load in order."""
    return daily.report(spark, run_cycle(spark, set_e(spark, sf_dir)))


def report_day_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with window rules over each load's own rows alone."""
    return daily.report(spark, run_cycle(spark, set_e(spark, sf_dir), lookback=False))


def _cycle_in_two(spark: SparkSession, w: Warehouse, held: Column, late: bool) -> DataFrame:
    """Loads without the ``held`` rows; these come as a second file of each
    day, or (``late``) all together with the last load."""
    store = daily.Store.fresh(spark, "cycle")
    slices = list(_load_slices(w))
    for i, (d, tx, cut) in enumerate(slices):
        rows = tx.where(~held)
        if late and i + 1 == len(slices):
            rows = rows.unionByName(w.transactions.where(held))
        daily.deliver(spark, store, [d], rows, {d: cut}, {d: w.blacklist}, Masters(w.cards, w.accounts, w.clients), _midnight)
    if not late:
        for d, tx, _ in slices:
            daily.deliver(spark, store, [d], tx.where(held), report_dt=_midnight)
    return daily.report(spark, store)


def report_two_files_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day's transactions in two files, the second after all first ones."""
    return _cycle_in_two(spark, set_e(spark, sf_dir), F.col("trans_id").cast("long") % 2 == 1, late=False)


def report_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of all transactions arrives with the last load."""
    return _cycle_in_two(spark, set_e(spark, sf_dir), F.col("trans_id").cast("long") % 5 == 0, late=True)


def report_empty_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cycle from files of the landing folder: one day's transaction file
    holds a header alone, the last day has no cut, and a day's list is missing."""
    w = set_e(spark, sf_dir)
    landing = scratch_path(spark, "landing")
    days = w.snapshot_days
    tx = reduce(DataFrame.unionByName, [t.withColumn("load_date", F.lit(d)) for d, t, _ in _load_slices(w)])
    delimited.write_transactions(tx, f"{landing}/transactions")
    nothing = delimited.transaction_text(tx.where("false")).drop("_day")
    (nothing.coalesce(1).write.option("header", True).option("sep", ";")
     .csv(f"{landing}/transactions/file=transactions_{EMPTY_DAY:%d%m%Y}.txt"))
    cuts = w.snapshots.where(F.col("as_of") < ts_literal(days[-1]))
    delimited.write_drop(cuts.select(TERMINAL_KEY, *TERMINAL_ATTRS, F.col("as_of").alias("_day")), f"{landing}/terminals", "terminals", F.col("_day"))
    listed = w.blacklist.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "passport", ts_literal(days[0]).alias("_day"))
    delimited.write_drop(listed, f"{landing}/blacklist", "passport_blacklist", F.col("_day"))
    store = daily.Store.fresh(spark, "cycle")
    files = [f for kind in ("transactions", "terminals", "blacklist") for f in daily_stream.listed(spark, f"{landing}/{kind}")]
    daily_stream.process_files(spark, files, landing, store, Masters(w.cards, w.accounts, w.clients), "batch-0", report_dt=_midnight)
    return daily.report(spark, store)


def report_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cycle with the facts and reports of its first loads merged before
    the last one comes, and what nothing names any more removed."""
    w = set_e(spark, sf_dir)
    store = daily.Store.fresh(spark, "cycle")
    *first, last = _load_slices(w)
    masters = Masters(w.cards, w.accounts, w.clients)
    for d, tx, cut in first:
        daily.deliver(spark, store, [d], tx, {d: cut}, {d: w.blacklist}, masters, _midnight)
    daily.compact(spark, store)
    daily.vacuum(spark, store, dt.timedelta(0))
    d, tx, cut = last
    daily.deliver(spark, store, [d], tx, {d: cut}, None, None, _midnight)
    return daily.report(spark, store)


def masters_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every load's stored masters, as the owner of each card."""
    w = set_e(spark, sf_dir)
    store = run_cycle(spark, w)
    parts = []
    for d, load in daily.loads(spark, store).items():
        m = daily.masters_of(spark, store, load)
        owners = m.cards.join(m.accounts, "account").join(m.clients, F.col("client") == F.col("client_id"))
        parts.append(owners.select(F.lit(d.isoformat()).alias("load_day"), "card_num", "account", "client_id", "passport_num", "phone"))
    return reduce(DataFrame.unionByName, parts)


def ingest_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of the daily transaction files: Spark writes one ``;`` file
    set per calendar day (half the amounts with a decimal comma), the reader
    types them back with the load day taken from the file name."""
    w = set_e(spark, sf_dir)
    landing = scratch_path(spark, "landing-tx")
    tx = w.transactions.withColumn("load_date", F.to_date("transaction_date"))
    delimited.write_transactions(tx, landing, comma_decimal=F.xxhash64("trans_id") % 2 == 0)
    parsed = delimited.read_transactions(spark, landing)
    return parsed.good.select(
        "trans_id", "transaction_date", "card_num", F.col("amount").cast("double").alias("amount"),
        "oper_type", "oper_result", "terminal",
        F.date_format("load_date", "yyyy-MM-dd").alias("load_day"),
    )


def _as_of(day: Column) -> Column:
    return day.cast("timestamp_ntz").alias("as_of")


def ingest_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of the terminal cuts, columns in another order than asked for."""
    w = set_e(spark, sf_dir)
    landing = scratch_path(spark, "landing-terminals")
    cut = w.snapshots.select(*reversed(TERMINAL_ATTRS), TERMINAL_KEY, F.col("as_of").alias("_day"))
    delimited.write_drop(cut, landing, "terminals", F.col("_day"))
    return delimited.read_terminals(spark, landing).good.select(_as_of(F.col("load_date")), TERMINAL_KEY, *TERMINAL_ATTRS)


def ingest_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of the cumulative blacklists (dates as ``dd.mm.yyyy``): on
    each cut day, every entry dated up to that day."""
    w = set_e(spark, sf_dir)
    landing = scratch_path(spark, "landing-blacklist")
    days = F.array(*[ts_literal(d) for d in w.snapshot_days])
    listed = w.blacklist.withColumn("_day", F.explode(F.filter(days, lambda d: d >= F.col("date"))))
    delimited.write_drop(listed.select("passport", F.date_format("date", "dd.MM.yyyy").alias("date"), "_day"),
                         landing, "passport_blacklist", F.col("_day"))
    return delimited.read_blacklist(spark, landing).good.select(_as_of(F.col("load_date")), "date", "passport")


def ingest_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of terminal cuts whose fields hold separators, doubled quotes
    and blanks; each day's file has its own order of columns."""
    w = set_e(spark, sf_dir)
    landing = scratch_path(spark, "landing-quoted")
    cut = w.snapshots.withColumns({
        "terminal_address": F.concat(F.col("terminal_address"), F.lit('; "'), F.col("terminal_city"), F.lit('" east; 2')),
        "terminal_city": F.concat(F.lit('"'), F.col("terminal_city"), F.lit('" ; ')),
        "terminal_type": F.when(F.col("terminal_city") == "N1", F.lit(";")).otherwise(F.col("terminal_type"))})
    columns = [TERMINAL_KEY, *TERMINAL_ATTRS]
    for i, d in enumerate(w.snapshot_days):
        ordered = cut.where(F.col("as_of") == ts_literal(d)).select(*columns[i:], *columns[:i], F.col("as_of").alias("_day"))
        delimited.write_drop(ordered, landing, "terminals", F.col("_day"))
    return delimited.read_terminals(spark, landing).good.select(_as_of(F.col("load_date")), TERMINAL_KEY, *TERMINAL_ATTRS)


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What does not parse in any of the three drops, with the text it had:
    amounts, times, dates and keys spoilt by a rule on their ids."""
    w = set_e(spark, sf_dir)
    landing = scratch_path(spark, "landing-bad")
    k = F.col("transaction_id").cast("long")
    text = delimited.transaction_text(w.transactions.withColumn("load_date", F.to_date("transaction_date")))
    text = text.withColumns({
        "amount": F.when(k % 10 == 3, F.lit("abc")).otherwise(F.col("amount")),
        "transaction_date": F.when(k % 10 == 7, F.lit("not a time")).otherwise(F.col("transaction_date")),
        "card_num": F.when(k % 10 == 9, F.lit("")).otherwise(F.col("card_num"))})
    delimited.write_drop(text, f"{landing}/tx", "transactions", F.col("_day"))
    n = F.substring(TERMINAL_KEY, 2, 20).cast("long")
    cut = w.snapshots.withColumn(TERMINAL_KEY, F.when(n % 9 == 0, F.lit(None)).otherwise(F.col(TERMINAL_KEY)))
    delimited.write_drop(cut.select(TERMINAL_KEY, *TERMINAL_ATTRS, F.col("as_of").alias("_day")), f"{landing}/cut", "terminals", F.col("_day"))
    p = F.substring("passport", 2, 20).cast("long")
    listed = w.blacklist.select(F.when(p % 2 == 0, F.lit("32.13.2024")).otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
                                "passport", ts_literal(w.snapshot_days[0]).alias("_day"))
    delimited.write_drop(listed, f"{landing}/list", "passport_blacklist", F.col("_day"))
    drops = {"transactions": delimited.read_transactions(spark, f"{landing}/tx"),
             "terminals": delimited.read_terminals(spark, f"{landing}/cut"),
             "blacklist": delimited.read_blacklist(spark, f"{landing}/list")}
    fields = {"transactions": 0, "terminals": 2, "blacklist": 1}
    return reduce(DataFrame.unionByName, [
        parsed.quarantine.select(
            F.lit(name).alias("drop_name"), F.date_format("load_date", "yyyy-MM-dd").alias("load_day"),
            F.element_at(F.split("row_text", ";"), fields[name] + 1).alias("field"))
        for name, parsed in drops.items()
    ])


def volume_expired_passport(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = set_l(spark, sf_dir)
    return rules.expired_passport(_chain(w), w.report_dt)


def volume_blocked_passport(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = set_l(spark, sf_dir)
    return rules.blocked_passport(_chain(w, with_blacklist=True), None, w.report_dt)


def volume_invalid_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = set_l(spark, sf_dir)
    return rules.invalid_agreement(_chain(w), w.report_dt)


def volume_fraud_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five rules in one pass over the lineitem-sized set."""
    return _mart(spark, set_l(spark, sf_dir))


def spark_queries() -> dict[str, Query]:
    return {
        "enriched_transactions": enriched_transactions,
        "fraud_expired_passport": fraud_expired_passport,
        "fraud_blocked_passport": fraud_blocked_passport,
        "fraud_invalid_agreement": fraud_invalid_agreement,
        "fraud_city_hop": fraud_city_hop,
        "fraud_amount_probe": fraud_amount_probe,
        "fraud_city_hop_all_versions": fraud_city_hop_all_versions,
        "fraud_amount_probe_all_versions": fraud_amount_probe_all_versions,
        "fraud_mart": fraud_mart,
        "fraud_mart_hot_card": fraud_mart_hot_card,
        "terminals_history": terminals_history,
        "terminals_history_daily": terminals_history_daily,
        "terminals_current": terminals_current,
        "terminals_new": terminals_new,
        "terminals_deleted": terminals_deleted,
        "terminals_changed": terminals_changed,
        "transactions_asof_terminal": transactions_asof_terminal,
        "transactions_asof_hot_terminal": transactions_asof_hot_terminal,
        "report_accumulate": report_accumulate,
        "report_day_only": report_day_only,
        "report_two_files_one_day": report_two_files_one_day,
        "report_late_rows": report_late_rows,
        "report_empty_day": report_empty_day,
        "report_compacted": report_compacted,
        "masters_loaded": masters_loaded,
        "ingest_delimited": ingest_delimited,
        "ingest_terminals": ingest_terminals,
        "ingest_blacklist": ingest_blacklist,
        "ingest_quoted": ingest_quoted,
        "ingest_quarantine": ingest_quarantine,
        "volume_expired_passport": volume_expired_passport,
        "volume_blocked_passport": volume_blocked_passport,
        "volume_invalid_agreement": volume_invalid_agreement,
        "volume_fraud_mart": volume_fraud_mart,
    }
