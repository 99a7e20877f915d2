"""Map the generated test tables onto the warehouse model.

Two fixture sets, both derived by Spark from the parquet tables so that the
work grows with the scale factor:

* **set E** (``events``-driven): every rule, the terminal dimension and the
  report run on one transaction set.  ``customer`` gives clients, accounts
  (two per client) and cards; ``events`` gives transactions (four consecutive
  events per card, every fourth one a success); ``supplier`` gives three full
  terminal snapshots, ten days apart, with deletions, moves and returns.
* **set L** (``lineitem``-driven, volume): ``customer`` → clients, ``orders``
  → accounts (two cards each), ``lineitem`` → transactions, ``supplier`` → one
  terminal cut.  Ship dates have day resolution, so a card's transactions of
  one day are zero apart (city hops between suppliers of different nations);
  every transaction succeeds, so amount probing never fires.

The DuckDB twin of every view lives in :mod:`cardsentry.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.functions import ts_literal

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping (shared with the SQL oracle).
E_START = dt.date(2024, 1, 1)
# Snapshot days of set E and, per day: (drop key if s_suppkey % m == r),
# (move the terminal to the next nation if s_suppkey % k == 0, 0 = no move).
E_SNAPSHOT_DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 11), dt.date(2024, 1, 21))
E_SNAPSHOT_RULES = ((10, 0, 0), (10, 1, 7), (13, 0, 14))
E_REPORT_DT = dt.datetime(2024, 2, 1, 0, 0, 0)
HOT_START = dt.datetime(2024, 1, 15, 10, 0, 0)
# A day whose transaction file holds no row; seconds between two versions of the hot terminal.
EMPTY_DAY = dt.date(2024, 1, 5)
VERSION_SECONDS = 1700
L_PASSPORT_BASE = dt.date(1997, 1, 1)
L_BLACKLIST_BASE = dt.date(1998, 6, 1)
L_REPORT_DT = dt.datetime(2002, 1, 1, 0, 0, 0)
# Set L has one terminal cut (every supplier, city = nation), before all ship dates.
L_CUT_DAY = dt.date(1995, 1, 1)
# ---------------------------------------------------------------------------


class Warehouse(NamedTuple):
    """Inputs of one fraud run."""

    transactions: DataFrame
    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame
    blacklist: DataFrame
    snapshots: DataFrame | None  # as_of + terminal columns, one full cut per as_of
    snapshot_days: tuple[dt.date, ...]
    report_dt: dt.datetime


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _plus_days(base: dt.date, days: Column) -> Column:
    return F.date_add(F.lit(base), days.cast("int"))


def _clients(customer: DataFrame, passport_base: dt.date, passport_mod: int) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        _s("C", k).alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .otherwise(_s("N", F.col("c_nationkey"))).alias("patronymic"),
        F.lit(None).cast("date").alias("date_of_birth"),
        _s("P", k).alias("passport_num"),
        F.when(k % 5 == 0, F.lit(None).cast("date"))
        .otherwise(_plus_days(passport_base, k % passport_mod)).alias("passport_valid_to"),
        _s("+7 ", k).alias("phone"),
        F.lit(None).cast("date").alias("create_dt"),
        F.lit(None).cast("date").alias("update_dt"),
    )


def _blacklist(customer: DataFrame, base: dt.date, mod: int) -> DataFrame:
    k = F.col("c_custkey")
    return customer.where(k % 11 == 0).select(
        (ts_literal(base) + F.make_dt_interval(days=(k % mod).cast("int"))).alias("date"),
        _s("P", k).alias("passport"),
    )


def set_e(spark: SparkSession, sf_dir: str) -> Warehouse:
    customer = _read(spark, sf_dir, "customer")
    events = _read(spark, sf_dir, "events")
    supplier = _read(spark, sf_dir, "supplier")

    # Two scalars of the mapping, as scalar subqueries inside the plan.
    n_cards = events.agg(F.max("user_id") + 1).scalar()
    n_terminals = supplier.agg(F.count(F.lit(1)) + 1).scalar()

    k = F.col("c_custkey")
    clients = _clients(customer, E_START, 45)
    accounts = customer.select(k, F.explode(F.array(F.lit(0), F.lit(1))).alias("slot")).select(
        F.concat(_s("A", k), F.lit("-"), F.col("slot").cast("string")).alias("account"),
        _plus_days(E_START, (k * 7 + F.col("slot") * 11) % 60).alias("valid_to"),
        _s("C", k).alias("client"),
        F.lit(None).cast("date").alias("create_dt"),
        F.lit(None).cast("date").alias("update_dt"),
    )
    cards = customer.select(
        _s("K", k).alias("card_num"),
        F.concat(_s("A", k), F.lit("-"), (k % 2).cast("string")).alias("account"),
        F.lit(None).cast("date").alias("create_dt"),
        F.lit(None).cast("date").alias("update_dt"),
    )
    e = F.col("event_id")
    transactions = events.select(
        e.cast("string").alias("trans_id"),
        F.col("ts").alias("transaction_date"),
        _s("K", F.expr("event_id div 4") % n_cards).alias("card_num"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("oper_type"),
        F.when(e % 4 == 3, F.lit("SUCCESS")).otherwise(F.lit("REJECT")).alias("oper_result"),
        _s("T", e % n_terminals).alias("terminal"),
    )
    blacklist = _blacklist(customer, E_START, 25)

    # Three full cuts from one scan of supplier: one output row per kept
    # (supplier, day) pair.
    s = F.col("s_suppkey")
    days = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(m).alias("m"), F.lit(r).alias("r"), F.lit(mv).alias("mv"))
        for i, (m, r, mv) in enumerate(E_SNAPSHOT_RULES)
    ])
    as_of = F.element_at(F.array(*[ts_literal(d) for d in E_SNAPSHOT_DAYS]), F.col("d.i") + 1)
    moved = (F.col("d.mv") > 0) & (s % F.greatest(F.col("d.mv"), F.lit(1)) == 0)
    snapshots = (
        supplier.select("s_suppkey", "s_name", "s_nationkey", F.explode(days).alias("d"))
        .where(s % F.col("d.m") != F.col("d.r"))
        .select(
            as_of.alias("as_of"),
            _s("T", s).alias("terminal_id"),
            F.lit("POS").alias("terminal_type"),
            _s("N", F.when(moved, (F.col("s_nationkey") + 1) % 25).otherwise(F.col("s_nationkey")))
            .alias("terminal_city"),
            F.col("s_name").alias("terminal_address"),
        )
    )
    return Warehouse(transactions, cards, accounts, clients, blacklist, snapshots,
                     E_SNAPSHOT_DAYS, E_REPORT_DT)


def hot_card(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Set E with nine tenths of the transactions on one card within an hour."""
    w = set_e(spark, sf_dir)
    e = F.col("trans_id").cast("long")
    hot = e % 10 != 0
    ms = F.make_dt_interval(secs=((e * 7919) % 3_600_000 / 1000).cast("decimal(18,6)"))
    return w._replace(transactions=w.transactions.withColumns({
        "card_num": F.when(hot, F.lit("K1")).otherwise(F.col("card_num")),
        "transaction_date": F.when(hot, ts_literal(HOT_START) + ms).otherwise(F.col("transaction_date")),
    }))


def hot_terminal(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Set E with nine tenths of the transactions at one terminal."""
    w = set_e(spark, sf_dir)
    hot = F.col("trans_id").cast("long") % 10 != 0
    return w._replace(transactions=w.transactions.withColumn("terminal", F.when(hot, F.lit("T1")).otherwise(F.col("terminal"))))


def moving_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of that one terminal with a version per customer, one after
    the other, every fiftieth a tombstone; none is open."""
    k = F.col("c_custkey")
    start = ts_literal(E_START) + F.make_dt_interval(secs=(k * VERSION_SECONDS).cast("decimal(18,6)"))
    return _read(spark, sf_dir, "customer").select(
        F.lit("T1").alias("terminal_id"), F.lit("POS").alias("terminal_type"), _s("N", k % 25).alias("terminal_city"),
        F.col("c_name").alias("terminal_address"), (k % 50 == 0).cast("int").alias("deleted_flg"), start.alias("effective_from"),
        (start + F.make_dt_interval(secs=F.lit(VERSION_SECONDS - 1).cast("decimal(18,6)"))).alias("effective_to"))


def set_l(spark: SparkSession, sf_dir: str) -> Warehouse:
    customer = _read(spark, sf_dir, "customer")
    orders = _read(spark, sf_dir, "orders")
    lineitem = _read(spark, sf_dir, "lineitem")

    clients = _clients(customer, L_PASSPORT_BASE, 1500)
    o = F.col("o_orderkey")
    accounts = orders.select(
        _s("A", o).alias("account"),
        F.date_add(F.to_date("o_orderdate"), 60).alias("valid_to"),
        _s("C", F.col("o_custkey")).alias("client"),
        F.lit(None).cast("date").alias("create_dt"),
        F.lit(None).cast("date").alias("update_dt"),
    )
    cards = orders.select(o, F.explode(F.array(F.lit(0), F.lit(1))).alias("slot")).select(
        _s("K", o * 10 + F.col("slot")).alias("card_num"),
        _s("A", o).alias("account"),
        F.lit(None).cast("date").alias("create_dt"),
        F.lit(None).cast("date").alias("update_dt"),
    )
    lo, ln = F.col("l_orderkey"), F.col("l_linenumber")
    transactions = lineitem.select(
        F.concat(lo.cast("string"), F.lit("-"), ln.cast("string")).alias("trans_id"),
        F.col("l_shipdate").alias("transaction_date"),
        _s("K", lo * 10 + ln % 2).alias("card_num"),
        F.col("l_extendedprice").alias("amount"),
        F.lit("purchase").alias("oper_type"),
        F.lit("SUCCESS").alias("oper_result"),
        _s("T", F.col("l_suppkey")).alias("terminal"),
    )
    blacklist = _blacklist(customer, L_BLACKLIST_BASE, 300)
    snapshots = _read(spark, sf_dir, "supplier").select(
        ts_literal(L_CUT_DAY).alias("as_of"),
        _s("T", F.col("s_suppkey")).alias("terminal_id"),
        F.lit("POS").alias("terminal_type"),
        _s("N", F.col("s_nationkey")).alias("terminal_city"),
        F.col("s_name").alias("terminal_address"),
    )
    return Warehouse(transactions, cards, accounts, clients, blacklist, snapshots,
                     (L_CUT_DAY,), L_REPORT_DT)
