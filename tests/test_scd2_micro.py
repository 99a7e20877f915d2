"""Terminal history on three hand-made cuts: change, delete, new, return;
point-in-time lookups; null-safe change detection; invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardsentry.operators.asof import join_terminal_asof
from cardsentry.operators.scd2 import (
    CHANGED,
    build_history,
    current,
    empty_history,
    scd2_apply,
    snapshot_diff,
)
from cardsentry.schemas import OPEN_END
from conftest import ts

DAYS = [dt.date(2021, 3, 1), dt.date(2021, 3, 2), dt.date(2021, 3, 3)]
CUTS = {
    0: [("T1", "Moscow"), ("T2", "Kazan"), ("T3", "Omsk")],
    1: [("T1", "Moscow"), ("T2", "Ufa"), ("T4", "Perm")],
    2: [("T1", "Moscow"), ("T2", "Ufa"), ("T3", "Omsk"), ("T4", "Perm")],
}
SCHEMA = ("as_of timestamp_ntz, terminal_id string, terminal_type string, "
          "terminal_city string, terminal_address string")


@pytest.fixture(scope="module")
def hist(spark):
    rows = [(dt.datetime.combine(DAYS[i], dt.time()), t, "POS", c, f"addr {t}")
            for i, cut in CUTS.items() for t, c in cut]
    snaps = spark.createDataFrame(rows, SCHEMA)
    return build_history(spark, snaps, DAYS)


def test_history_rows(hist):
    got = sorted((r.terminal_id, r.terminal_city, r.deleted_flg, str(r.effective_from),
                  str(r.effective_to)) for r in hist.collect())
    assert got == sorted([
        ("T1", "Moscow", 0, "2021-03-01 00:00:00", OPEN_END),
        ("T2", "Kazan", 0, "2021-03-01 00:00:00", "2021-03-01 23:59:59"),
        ("T2", "Ufa", 0, "2021-03-02 00:00:00", OPEN_END),
        ("T3", "Omsk", 0, "2021-03-01 00:00:00", "2021-03-01 23:59:59"),
        ("T3", "Omsk", 1, "2021-03-02 00:00:00", "2021-03-02 23:59:59"),
        ("T3", "Omsk", 0, "2021-03-03 00:00:00", OPEN_END),
        ("T4", "Perm", 0, "2021-03-02 00:00:00", OPEN_END),
    ])


def test_at_most_one_open_row_per_key(hist):
    open_rows = hist.where(F.col("effective_to") == F.lit(OPEN_END).cast("timestamp_ntz"))
    assert open_rows.groupBy("terminal_id").count().where("count > 1").count() == 0


def test_versions_do_not_overlap(hist):
    rows = sorted((r.terminal_id, r.effective_from, r.effective_to) for r in hist.collect())
    for (k1, _, to1), (k2, from2, _) in zip(rows, rows[1:]):
        if k1 == k2:
            assert to1 + dt.timedelta(seconds=1) == from2


def test_current_equals_each_cut(hist):
    for i, day in enumerate(DAYS):
        got = sorted((r.terminal_id, r.terminal_city) for r in current(hist, day).collect())
        assert got == sorted(CUTS[i])


def test_point_in_time_lookup(spark, hist):
    tx = spark.createDataFrame([
        ("a", ts("2021-03-01 23:59:59.500000"), "T2"),
        ("b", ts("2021-03-01 12:00:00"), "T4"),
        ("c", ts("2021-03-02 12:00:00"), "T3"),
        ("d", ts("2021-03-02 12:00:00"), "T9"),
    ], "trans_id string, transaction_date timestamp_ntz, terminal string")
    got = {r.trans_id: (r.terminal_city, r.deleted_flg, r.known)
           for r in join_terminal_asof(tx, hist, how="left").collect()}
    assert got == {"a": ("Kazan", 0, True), "b": ("Perm", 0, True),
                   "c": ("Omsk", 1, True), "d": (None, None, False)}


def test_all_versions_mode_repeats_rows(spark, hist):
    tx = spark.createDataFrame([("a", ts("2021-03-02 12:00:00"), "T2")],
                               "trans_id string, transaction_date timestamp_ntz, terminal string")
    assert join_terminal_asof(tx, hist, how="inner", mode="all_versions").count() == 2
    assert join_terminal_asof(tx, hist, how="inner").count() == 1


def test_null_attribute_changes(spark):
    day1, day2 = dt.datetime(2021, 3, 1), dt.datetime(2021, 3, 2)
    s1 = spark.createDataFrame([("T1", "POS", "Moscow", None), ("T2", "POS", "Kazan", None)],
                               "terminal_id string, terminal_type string, terminal_city string, "
                               "terminal_address string")
    s2 = spark.createDataFrame([("T1", "POS", "Moscow", "X"), ("T2", "POS", "Kazan", None)],
                               s1.schema)
    h1 = scd2_apply(empty_history(spark), s1, day1)
    diff = snapshot_diff(current(h1, day2), s2)
    assert [r.terminal_id for r in diff.where(F.col("change_kind") == CHANGED).collect()] == ["T1"]
    h2 = scd2_apply(h1, s2, day2)
    assert h2.count() == 3


def test_reapplying_the_same_cut_changes_nothing(spark, hist):
    day = dt.datetime(2021, 3, 4)
    cut = current(hist, dt.date(2021, 3, 3))
    again = scd2_apply(hist, cut, day)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, hist.collect()))


def test_closed_form_equals_the_fold(spark, hist):
    from cardsentry.operators.scd2 import history_from_cuts

    rows = [(dt.datetime.combine(DAYS[i], dt.time()), t, "POS", c, f"addr {t}")
            for i, cut in CUTS.items() for t, c in cut]
    closed = history_from_cuts(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, closed.collect())) == sorted(map(tuple, hist.collect()))


def test_closed_form_equals_the_fold_on_test_tables(spark):
    from conftest import SF_MID
    from cardsentry.operators.scd2 import history_from_cuts
    from cardsentry.plans.testviews import set_e

    w = set_e(spark, SF_MID)
    fold = build_history(spark, w.snapshots, w.snapshot_days)
    closed = history_from_cuts(w.snapshots)
    assert fold.count() == 142
    assert sorted(map(tuple, closed.collect())) == sorted(map(tuple, fold.collect()))
