"""Hand-made rule cases with known answers: boundaries (expiry day at
midnight, blacklist time, exactly one hour, exactly twenty minutes), null
patronymic, non-strict amounts, float-error traps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardsentry.operators import rules
from cardsentry.operators.enrich import owners_of
from cardsentry.operators.scd2 import build_history
from cardsentry.schemas import (
    ACCOUNTS,
    BLACKLIST,
    CARDS,
    CLIENTS,
    EVENT_AMOUNT_PROBE,
    EVENT_BLOCKED_PASSPORT,
    EVENT_CITY_HOP,
    EVENT_EXPIRED_PASSPORT,
    EVENT_INVALID_AGREEMENT,
)
from conftest import ts

D = dt.date
FAR = D(2030, 1, 1)
REPORT_DT = ts("2021-03-04 00:00:00")


@pytest.fixture(scope="module")
def case(spark):
    clients = spark.createDataFrame([
        ("C1", "Ivanov", "Ivan", "Ivanovich", None, "P1", D(2021, 3, 2), "+7 1", None, None),
        ("VIP-1", "Petrov", "Petr", "Petrovich", None, "P2", None, "+7 2", None, None),
        ("C3", "Sidorov", "Sidor", None, None, "P3", FAR, "+7 3", None, None),
        ("C4", "A", "B", "C", None, "P4", FAR, "+7 4", None, None),
        ("C5", "A", "B", "C", None, "P5", FAR, "+7 5", None, None),
        ("C6", "A", "B", "C", None, "P6", FAR, "+7 6", None, None),
    ], CLIENTS)
    accounts = spark.createDataFrame([
        ("A1", D(2021, 3, 2), "C1", None, None),
        ("A2", FAR, "VIP-1", None, None),
        ("A3", FAR, "C3", None, None),
        ("A4", FAR, "C4", None, None),
        ("A5", FAR, "C5", None, None),
        ("A6", FAR, "C6", None, None),
    ], ACCOUNTS)
    cards = spark.createDataFrame([(f"K{i}", f"A{i}", None, None) for i in range(1, 7)], CARDS)
    blacklist = spark.createDataFrame([(ts("2021-03-01 00:00:00"), "P2")], BLACKLIST)
    R, S = "REJECT", "SUCCESS"
    rows = [
        (1, "2021-03-01 23:59:59", "K1", 100, S, "T1"),
        (2, "2021-03-02 00:00:00", "K1", 100, S, "T1"),
        (3, "2021-03-02 10:00:00", "K1", 100, S, "T1"),
        (4, "2021-03-01 00:00:00", "K2", 50, S, "T1"),
        (5, "2021-03-01 00:00:01", "K2", 50, S, "T1"),
        (6, "2021-03-01 09:00:00", "K3", 10, S, "T1"),
        (7, "2021-03-01 09:59:59", "K3", 10, S, "T2"),
        (8, "2021-03-01 10:59:59", "K3", 10, S, "T1"),
        (9, "2021-03-01 12:00:00", "K4", 500, R, "T1"),
        (10, "2021-03-01 12:05:00", "K4", 400, R, "T1"),
        (11, "2021-03-01 12:10:00", "K4", 300, R, "T1"),
        (12, "2021-03-01 12:19:59", "K4", 200, S, "T1"),
        (13, "2021-03-01 13:00:00", "K4", 500, R, "T1"),
        (14, "2021-03-01 13:05:00", "K4", 400, R, "T1"),
        (15, "2021-03-01 13:10:00", "K4", 300, R, "T1"),
        (16, "2021-03-01 13:20:00", "K4", 200, S, "T1"),
        (17, "2021-03-01 14:00:00", "K4", 500, R, "T1"),
        (18, "2021-03-01 14:05:00", "K4", 500, R, "T1"),
        (19, "2021-03-01 14:06:00", "K4", 300, R, "T1"),
        (20, "2021-03-01 14:07:00", "K4", 200, S, "T1"),
        (21, "2021-03-01 00:00:00", "K5", 10, S, "T1"),
        (22, "2021-03-01 01:00:00", "K5", 10, S, "T2"),
        (23, "2021-03-01 00:00:35", "K6", 500, R, "T1"),
        (24, "2021-03-01 00:05:00", "K6", 400, R, "T1"),
        (25, "2021-03-01 00:10:00", "K6", 300, R, "T1"),
        (26, "2021-03-01 00:20:35", "K6", 200, S, "T1"),
    ]
    tx = spark.createDataFrame(
        [(str(i), ts(t), c, float(a), "payment", r, term) for i, t, c, a, r, term in rows],
        "trans_id string, transaction_date timestamp_ntz, card_num string, amount double, "
        "oper_type string, oper_result string, terminal string",
    )
    snaps = spark.createDataFrame(
        [(ts("2021-03-01 00:00:00"), "T1", "POS", "Moscow", "a1"),
         (ts("2021-03-01 00:00:00"), "T2", "POS", "Kazan", "a2")],
        "as_of timestamp_ntz, terminal_id string, terminal_type string, terminal_city string, "
        "terminal_address string",
    )
    hist = build_history(spark, snaps, [D(2021, 3, 1)])
    owners = owners_of(cards, accounts, clients)
    return tx.join(owners, "card_num"), tx, owners, blacklist, hist


def _ids(df):
    return sorted((r.event_dt.isoformat(sep=" "), r.passport_num) for r in df.collect())


def test_expired_passport_counts_expiry_midnight(case):
    enriched, *_ = case
    got = _ids(rules.expired_passport(enriched, REPORT_DT))
    assert got == [("2021-03-02 00:00:00", "P1"), ("2021-03-02 10:00:00", "P1")]


def test_invalid_agreement(case):
    enriched, *_ = case
    got = _ids(rules.invalid_agreement(enriched, REPORT_DT))
    assert got == [("2021-03-02 00:00:00", "P1"), ("2021-03-02 10:00:00", "P1")]


def test_blocked_passport_strictly_after(case):
    enriched, _, _, bl, _ = case
    assert _ids(rules.blocked_passport(enriched, bl, REPORT_DT)) == [("2021-03-01 00:00:01", "P2")]


def test_blocked_passport_listed_twice_reports_once(spark, case):
    enriched, _, _, bl, _ = case
    twice = bl.unionByName(bl.withColumn("date", F.col("date") - F.expr("INTERVAL 1 DAY")))
    assert _ids(rules.blocked_passport(enriched, twice, REPORT_DT)) == [
        ("2021-03-01 00:00:00", "P2"), ("2021-03-01 00:00:01", "P2")]


def test_city_hop_exact_hour_not_flagged_and_fio_null(case):
    _, tx, owners, _, hist = case
    rows = rules.city_hop(tx, owners, hist, REPORT_DT).collect()
    assert [(r.event_dt.isoformat(sep=" "), r.passport_num, r.fio) for r in rows] == [
        ("2021-03-01 09:59:59", "P3", None)]


def test_amount_probe_only_strict_inside_20_minutes(case):
    _, tx, owners, _, hist = case
    assert _ids(rules.amount_probe(tx, owners, hist, REPORT_DT)) == [("2021-03-01 12:19:59", "P4")]


def test_fused_mart_equals_rules(case):
    _, tx, owners, bl, hist = case
    got = sorted((r.event_dt.isoformat(sep=" "), r.event_type)
                 for r in rules.fraud_mart(tx, owners, hist, REPORT_DT, blacklist=bl).collect())
    assert got == sorted([
        ("2021-03-02 00:00:00", EVENT_EXPIRED_PASSPORT),
        ("2021-03-02 10:00:00", EVENT_EXPIRED_PASSPORT),
        ("2021-03-02 00:00:00", EVENT_INVALID_AGREEMENT),
        ("2021-03-02 10:00:00", EVENT_INVALID_AGREEMENT),
        ("2021-03-01 00:00:01", EVENT_BLOCKED_PASSPORT),
        ("2021-03-01 09:59:59", EVENT_CITY_HOP),
        ("2021-03-01 12:19:59", EVENT_AMOUNT_PROBE),
    ])


def test_report_dt_is_the_given_literal(case):
    _, tx, owners, bl, hist = case
    dts = {r.report_dt for r in rules.fraud_mart(tx, owners, hist, REPORT_DT, blacklist=bl).collect()}
    assert dts == {REPORT_DT}


def test_equal_times_are_ordered_by_transaction_id(spark):
    """Two transactions of one card at the same time: the order (and so the
    city-hop flag) is fixed by the transaction id, run after run."""
    from cardsentry.operators.sequence import with_lags

    df = spark.createDataFrame(
        [("b", ts("2021-03-01 10:00:00"), "K", "Kazan"),
         ("a", ts("2021-03-01 10:00:00"), "K", "Moscow")],
        "trans_id string, transaction_date timestamp_ntz, card_num string, terminal_city string")
    got = {r.trans_id: r.terminal_city_lag1
           for r in with_lags(df, {"terminal_city": (1,)}).collect()}
    assert got == {"a": None, "b": "Moscow"}
