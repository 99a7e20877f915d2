"""The as-of sweep equals the join, with gaps, ties and hot terminals."""

import datetime as dt
import random

import pytest

from cardsentry.operators import asof
from cardsentry.schemas import TERMINALS_HIST

T0 = dt.datetime(2021, 3, 1)


def _rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module", params=["mixed", "hot"])
def tables(spark, request):
    rng = random.Random(4)
    versions, keys = [], ["T0"] if request.param == "hot" else [f"T{i}" for i in range(30)]
    for k in keys:
        at = T0 + dt.timedelta(hours=rng.randint(0, 50))
        for i in range(600 if request.param == "hot" else rng.randint(1, 5)):
            to = at + dt.timedelta(minutes=rng.randint(1, 60))
            versions.append((k, "POS", f"C{i}", "a", i % 3 == 0, at, to - dt.timedelta(seconds=1)))
            at = to + (dt.timedelta(minutes=7) if rng.random() < 0.2 else dt.timedelta(0))  # some gaps
    rows = [(str(i), rng.choice([*keys, "T99", None]) if rng.random() < 0.5 else keys[0],
             rng.choice([v[5] for v in versions[:50]]) if rng.random() < 0.2 else T0 + dt.timedelta(seconds=rng.randint(0, 3_000_000), microseconds=rng.randint(0, 5)))
            for i in range(2000)]
    hist = spark.createDataFrame([(*v[:4], int(v[4]), *v[5:]) for v in versions], TERMINALS_HIST)
    tx = spark.createDataFrame(rows + rows[:50], "trans_id string, terminal string, transaction_date timestamp_ntz")
    return tx.repartition(4), hist.repartition(3)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_sweep_equals_join(tables, how):
    tx, hist = tables
    joined = asof.join_terminal_asof(tx, hist, how, method="join")
    swept = asof.join_terminal_asof(tx, hist, how, method="sweep")
    assert set(swept.columns) == set(joined.columns)
    assert _rows(swept, joined.columns) == _rows(joined, joined.columns)
    plan = swept._jdf.queryExecution().toString()
    assert "Join" not in plan


def test_the_busiest_terminal_decides(tables, monkeypatch):
    tx, hist = tables
    taken = []
    monkeypatch.setattr(asof, "_sweep", lambda *a: taken.append(1) or tx)
    monkeypatch.setattr(asof, "MAX_VERSIONS", 100)
    asof.join_terminal_asof(tx, hist)
    assert bool(taken) == (hist.count() == 600)


def test_nothing_to_join(tables, spark):
    tx, hist = tables
    assert asof.join_terminal_asof(tx, hist.where("false"), method="sweep").where("known").isEmpty()
    assert asof.join_terminal_asof(tx.where("false"), hist, method="sweep").isEmpty()
