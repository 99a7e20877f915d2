"""Plan shape of the mart: the properties the design relies on."""

import contextlib
import io
import re

import pytest

from cardsentry.operators import rules
from cardsentry.operators.enrich import owners_of
from cardsentry.operators.scd2 import history_from_cuts
from cardsentry.plans.registry import fraud_mart
from cardsentry.plans.testviews import set_e
from conftest import SF_SMALL


def _formatted_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_mart_plan(spark):
    plan = _formatted_plan(fraud_mart(spark, SF_SMALL))
    # the row rules scan the fact once and read only the columns they use
    schemas = re.findall(r"events\.parquet\]\s*\nReadSchema: (struct<[^\n]*>)", plan)
    assert schemas and all("props" not in s for s in schemas)
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("longest", [0, rules.LONGEST_IN_TASK])
def test_window_carries_only_what_the_rules_compare(spark, longest):
    w = set_e(spark, SF_SMALL)
    plan = _formatted_plan(rules.known_sequence(w.transactions, history_from_cuts(w.snapshots), longest=longest))
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)
    window = [e for e in exchanges if ("_part" in e and "_own" in e if not longest else "card_num" in e and "amount" in e)]
    assert len(window) == 1 or not longest
    assert window and all(not re.search("fio|phone|passport|valid_to|effective", e) for e in window)
    # no probe sits above the fact
    assert "CollectLimit" not in plan


def test_sequences_run_before_any_owner_is_joined(spark):
    """The stored sequence rows hold no owner column."""
    w = set_e(spark, SF_SMALL)
    seq = rules.known_sequence(w.transactions, history_from_cuts(w.snapshots))
    assert not {"fio", "phone", "passport_num"} & set(seq.columns)


def test_shuffle_join_fallback_gives_the_same_rows(spark):
    """Beyond the broadcast threshold every join is a sort-merge join; the rows
    must not change."""
    w = set_e(spark, SF_SMALL)
    want = sorted(map(tuple, fraud_mart(spark, SF_SMALL).collect()), key=repr)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        owners = owners_of(w.cards, w.accounts, w.clients, w.blacklist)
        df = rules.fraud_mart(w.transactions, owners, history_from_cuts(w.snapshots), w.report_dt)
        assert "SortMergeJoin" in _formatted_plan(df)
        got = sorted(map(tuple, df.collect()), key=repr)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == want


def test_mart_reads_the_owners_once(spark):
    """Row rules and hits meet the owners in one join."""
    w = set_e(spark, SF_SMALL)
    owners = owners_of(w.cards, w.accounts, w.clients, w.blacklist)
    hist = history_from_cuts(w.snapshots, days=w.snapshot_days)
    plan = _formatted_plan(rules.fraud_mart(w.transactions, owners, hist, w.report_dt))
    assert len(re.findall(r"\(\d+\) Scan parquet[^\n]*\nOutput \[\d+\]: [^\n]*\n(?:[^\n]+\n)*?Location: [^\n]*card-owners", plan)) == 1
