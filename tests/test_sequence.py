"""The range-partitioned card window equals a plain per-card window (property
test against a loop), however the rows are spread."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardsentry.operators.sequence import with_lags

BASE = dt.datetime(2021, 3, 1, 22, 0, 0)


def brute(rows):
    out = {}
    for card in {r[2] for r in rows}:
        own = sorted((r for r in rows if r[2] == card), key=lambda r: (r[1], r[0]))
        for i, r in enumerate(own):
            out[r[0]] = {k: own[i - k][3] if i >= k else None for k in (1, 3)}
    return out


events = st.lists(
    st.tuples(st.sampled_from(["K1", "K1", "K1", "K2", "K3"]), st.integers(0, 20), st.integers(0, 99)),
    min_size=1, max_size=60,
)


@settings(max_examples=12, deadline=None)
@given(events=events, partitions=st.sampled_from([1, 3, 16]))
def test_lags_match_brute_force(spark, events, partitions):
    rows = [(f"t{i:03d}", BASE + dt.timedelta(seconds=s), card, v) for i, (card, s, v) in enumerate(events)]
    df = spark.createDataFrame(rows, "trans_id string, transaction_date timestamp_ntz, card_num string, v int")
    got = with_lags(df, {"v": (1, 3)}, partitions=partitions).collect()
    assert {r.trans_id: {1: r.v_lag1, 3: r.v_lag3} for r in got} == brute(rows) and len(got) == len(rows)


def test_one_hot_card_is_spread(spark):
    """All rows on one card at one minute: many partitions, none with more
    than its share, and the lags stay right."""
    rows = [(f"t{i:05d}", BASE, "K", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "trans_id string, transaction_date timestamp_ntz, card_num string, v int")
    got = with_lags(df, {"v": (1, 3)}, partitions=8)
    assert sorted((r.v, r.v_lag1, r.v_lag3) for r in got.collect()) == [
        (i, i - 1 if i else None, i - 3 if i >= 3 else None) for i in range(4000)]


def test_empty(spark):
    df = spark.createDataFrame([], "trans_id string, transaction_date timestamp_ntz, card_num string, v int")
    assert with_lags(df, {"v": (1,)}).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_mart_does_not_depend_on_the_partitions(spark, partitions):
    from cardsentry.operators import rules
    from cardsentry.operators.enrich import owners_of
    from cardsentry.operators.scd2 import history_from_cuts
    from cardsentry.plans.testviews import hot_card
    from conftest import SF_SMALL

    w = hot_card(spark, SF_SMALL)
    owners = owners_of(w.cards, w.accounts, w.clients, w.blacklist)
    hist = history_from_cuts(w.snapshots)
    want = sorted(map(tuple, rules.fraud_mart(w.transactions, owners, hist, w.report_dt).collect()), key=repr)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = sorted(map(tuple, rules.fraud_mart(w.transactions, owners, hist, w.report_dt, longest=0).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == want
