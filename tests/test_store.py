"""The store's upkeep: exclusive commits, touched buckets, content by name,
merged parts, vacuum."""

import datetime as dt
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from cardsentry.plans import daily, dimension
from cardsentry.plans.log import CHECKPOINT_EVERY, Log
from cardsentry.schemas import ACCOUNTS, BLACKLIST, CARDS, CLIENTS, EVENT_INVALID_AGREEMENT, REPORT
from cardsentry.session import scratch_path
from cardsentry.sources.masters import Masters
from conftest import ts

D = [dt.date(2021, 3, 1) + dt.timedelta(i) for i in range(12)]
CUT = "terminal_id string, terminal_type string, terminal_city string, terminal_address string"


def _midnight(d):
    return dt.datetime.combine(d, dt.time())


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def masters(spark):
    return Masters(
        spark.createDataFrame([("K3", "A3", None, None)], CARDS),
        spark.createDataFrame([("A3", dt.date(2021, 3, 1), "C3", None, None)], ACCOUNTS),
        spark.createDataFrame([("C3", "S", "S", "S", None, "P3", None, "+7 3", None, None)], CLIENTS))


def _tx(spark, *rows):
    ddl = daily.FACTS_DDL
    return spark.createDataFrame([(i, ts(t), "K3", 1.0, "p", "SUCCESS", "T1") for i, t in rows], ddl)


def _cut(spark, n, moved=()):
    return spark.createDataFrame([(f"T{i}", "POS", "Perm" if i in moved else "Kazan", "a") for i in range(n)], CUT)


def test_one_number_goes_to_one_writer(spark):
    log = Log(spark, scratch_path(spark, "log"))
    state = log.read()
    got = []
    threads = [threading.Thread(target=lambda k=k: got.append(log.commit(state, [daily.Load(D[k].isoformat()).row()]))) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [False] * 5 + [True] and len(log.read().loads) == 1


def test_many_commits_are_read_from_a_checkpoint(spark, monkeypatch):
    log = Log(spark, scratch_path(spark, "log"))
    for i in range(3 * CHECKPOINT_EVERY + 4):
        assert log.commit(log.read(), [daily.Load(D[i % 12].isoformat(), facts=(f"run={i}/x",)).row()], f"batch-{i}")
    opened = []
    real = Log._read
    monkeypatch.setattr(Log, "_read", lambda self, name: opened.append(name) or real(self, name))
    state = log.read()
    assert len(opened) == 5 and state.seq == 33 and len(state.sources) == 34 and len(state.loads) == 12
    assert state.loads[D[33 % 12].isoformat()]["facts"] == ["run=33/x"]


def test_two_deliveries_at_once_are_both_visible(spark, masters, monkeypatch):
    """Both prepare on the same state; the slower one is made again."""
    store = daily.Store.fresh(spark, "two-writers")
    daily.deliver(spark, store, [D[0]], _tx(spark, ("a", "2021-03-01 10:00:00")), {D[0]: _cut(spark, 3)}, None, masters, _midnight)
    real, first = daily._publish, threading.Event()

    def waits(*args):
        if not first.is_set():  # the other delivery comes in between
            first.set()
            daily.deliver(spark, store, [D[0]], _tx(spark, ("b", "2021-03-01 11:00:00")), report_dt=_midnight, source="other")
        return real(*args)

    with monkeypatch.context() as m:
        m.setattr(daily, "_publish", waits)
        assert daily.deliver(spark, store, [D[0]], _tx(spark, ("c", "2021-03-01 12:00:00")), report_dt=_midnight, source="slow") == [D[0]]
    assert sorted(r.trans_id for r in daily.facts(spark, store, daily.loads(spark, store).values()).collect()) == ["a", "b", "c"]
    assert daily.report(spark, store).count() == 3
    assert daily.published_sources(spark, store) == {"other", "slow"}
    assert daily.deliver(spark, store, [D[0]], _tx(spark, ("d", "2021-03-01 12:00:00")), source="slow") == []


def test_a_cut_rewrites_the_buckets_it_touches(spark):
    table = scratch_path(spark, "buckets")
    first, closed = dimension.apply_cut(spark, table, "load_date=1", (), _cut(spark, 400), _midnight(D[0]), 16)
    assert closed == () and len({b.ref for b in first}) == 16
    same, closed = dimension.apply_cut(spark, table, "load_date=2", first, _cut(spark, 400).orderBy(F.rand(1)), _midnight(D[1]), 16)
    assert (same, closed) == (first, ())
    moved, closed = dimension.apply_cut(spark, table, "load_date=3", first, _cut(spark, 400, {7}), _midnight(D[2]), 16)
    assert [a != b for a, b in zip(moved, first, strict=True)].count(True) == 1 and closed == ("load_date=3/part=closed",)
    hist = dimension.read_history(spark, table, moved, list(closed))
    assert hist.count() == 401 and hist.where("terminal_id = 'T7'").count() == 2
    gone, more = dimension.apply_cut(spark, table, "load_date=4", moved, _cut(spark, 399, {7}), _midnight(D[3]), 16)
    back, last = dimension.apply_cut(spark, table, "load_date=5", gone, _cut(spark, 400, {7}), _midnight(D[4]), 16)
    assert [a != b for a, b in zip(back, moved, strict=True)].count(True) == 1
    flags = dimension.read_history(spark, table, back, [*closed, *more, *last]).where("terminal_id = 'T399'").orderBy("effective_from")
    assert [r.deleted_flg for r in flags.collect()] == [0, 1, 0]


def test_equal_masters_and_lists_are_stored_once(spark, masters):
    store = daily.Store.fresh(spark, "by-name")
    listed = spark.createDataFrame([(ts("2021-02-01 00:00:00"), "P3")], BLACKLIST)
    for i in range(4):
        daily.deliver(spark, store, [D[i]], _tx(spark, (str(i), f"2021-03-0{i + 1} 10:00:00")), {D[i]: _cut(spark, 3)}, {D[i]: listed},
                      Masters(*[t.repartition(2) for t in masters]), _midnight)
    loads = daily.loads(spark, store).values()
    assert len({x.masters for x in loads}) == 1 and len({x.owners for x in loads}) == 1 and len({x.dim for x in loads}) == 1
    assert len(os.listdir(_local(store.table(daily.STG_MASTERS)))) == 1
    new = masters._replace(clients=masters.clients.replace({"+7 3": "+7 9"}))
    daily.deliver(spark, store, [D[4]], None, None, None, new, _midnight)
    assert len({x.masters for x in daily.loads(spark, store).values()}) == 2
    assert daily.masters_of(spark, store, daily.loads(spark, store)[D[4]]).clients.first().phone == "+7 9"


def _runs(store):
    return {t: len(os.listdir(_local(store.table(t)))) for t in (daily.FACT_TX, daily.REPORT, daily.OWNERS, daily.DIM, daily.STG_TERMINALS)}


def test_vacuum_leaves_one_copy_and_running_readers(spark, masters):
    store = daily.Store.fresh(spark, "vacuum")
    listed = spark.createDataFrame([], BLACKLIST)
    for k in range(4):
        daily.run_day(spark, store, D[0], _tx(spark, (f"r{k}", "2021-03-01 10:00:00")), listed, _cut(spark, 3 + k), *masters, _midnight)
    reader = daily.report(spark, store)
    want = _rows(daily.report(spark, store))
    between = dt.datetime.now()
    time.sleep(1.1)
    daily.run_day(spark, store, D[0], _tx(spark, ("last", "2021-03-01 11:00:00")), listed, _cut(spark, 9), *masters, _midnight)
    daily.vacuum(spark, store, dt.datetime.now() - between)
    assert _rows(reader) == want and _runs(store)[daily.REPORT] == 2
    time.sleep(1.1)
    daily.vacuum(spark, store, dt.timedelta(0))
    assert _runs(store) == {daily.FACT_TX: 1, daily.REPORT: 1, daily.OWNERS: 1, daily.DIM: 1, daily.STG_TERMINALS: 1}
    assert [r.event_dt.hour for r in daily.report(spark, store).collect()] == [11]
    assert len(_rows(daily.current_terminals(spark, store))) == 9


def test_a_thousand_small_loads_are_read_from_few_paths(spark):
    store = daily.Store.fresh(spark, "thousand")
    days = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(1000)]
    hour = F.make_dt_interval(hours=F.lit(10))
    when = (F.date_add(F.lit(days[0]), F.col("id").cast("int")).cast("timestamp_ntz") + hour)
    rows = spark.range(1000).select(when.alias("event_dt"), F.lit("P").alias("passport_num"), F.lit("f").alias("fio"), F.lit("1").alias("phone"),
                                    F.lit("e").alias("event_type"), when.alias("report_dt"))
    assert rows.schema.names == REPORT.names
    rows.withColumn("load_date", F.to_date("event_dt")).repartition(4).write.partitionBy("load_date").parquet(store.path(daily.REPORT, "run=x"))
    log = store.log(spark)
    for low in range(0, 1000, 100):
        assert log.commit(log.read(), [daily.Load(d.isoformat(), report=f"run=x/load_date={d}").row() for d in days[low:low + 100]])
    want = _rows(rows)
    assert daily.compact(spark, store, least=2) == 1000
    refs = {x.report for x in daily.loads(spark, store).values()}
    assert len(refs) == 1 and _rows(daily.report(spark, store)) == want
    assert len(log._names()) <= 13
    assert daily.compact(spark, store, least=2) == 0


def test_facts_of_merged_and_later_parts(spark, masters):
    store = daily.Store.fresh(spark, "merged")
    daily.deliver(spark, store, [D[0], D[1]], _tx(spark, ("a", "2021-03-01 10:00:00"), ("b", "2021-03-02 10:00:00")), {D[0]: _cut(spark, 3)}, None, masters, _midnight)
    daily.deliver(spark, store, [D[0]], _tx(spark, ("c", "2021-03-01 11:00:00")), report_dt=_midnight)
    want = _rows(daily.report(spark, store))
    assert daily.compact(spark, store) > 0
    assert _rows(daily.report(spark, store)) == want
    daily.deliver(spark, store, [D[0]], _tx(spark, ("d", "2021-03-01 12:00:00")), report_dt=_midnight)
    loads = daily.loads(spark, store)
    assert sorted(r.trans_id for r in daily.facts(spark, store, [loads[D[0]]]).collect()) == ["a", "c", "d"]
    assert sorted(r.trans_id for r in daily.facts(spark, store, loads.values()).collect()) == ["a", "b", "c", "d"]
    assert daily.report(spark, store).count() == 4


def test_a_second_file_of_the_first_day_keeps_its_owners(spark, masters):
    store = daily.Store.fresh(spark, "owners")
    listed = spark.createDataFrame([(ts("2021-03-01 09:00:00"), "P3")], BLACKLIST)
    daily.deliver(spark, store, [D[0]], _tx(spark, ("a", "2021-03-01 10:00:00")), {D[0]: _cut(spark, 3)}, {D[0]: listed}, masters, _midnight)
    first = daily.loads(spark, store)[D[0]]
    daily.deliver(spark, store, [D[0]], _tx(spark, ("b", "2021-03-01 11:00:00")), report_dt=_midnight)
    second = daily.loads(spark, store)[D[0]]
    assert second.owners == first.owners and second.report != first.report and len(second.facts) == 2
    # another list makes them anew
    none = spark.createDataFrame([], BLACKLIST)
    daily.deliver(spark, store, [D[0]], None, None, {D[0]: none}, report_dt=_midnight)
    assert daily.loads(spark, store)[D[0]].owners != first.owners
    assert {r.event_type for r in daily.report(spark, store).collect()} == {EVENT_INVALID_AGREEMENT}


def test_digests_are_plain_sums_and_tell_nulls_and_names(spark):
    ddl = "a string, b string"
    tables = [spark.createDataFrame(rows, d) for rows, d in (
        ([("x", None), ("y", "z")], ddl), ([("y", "z"), ("x", None)], ddl), ([(None, "x"), ("y", "z")], ddl), ([("x", None), ("y", "z")], "a string, c string"),
        ([("x", None), ("x", None), ("y", "z")], ddl), ([], ddl), ([("x", ""), ("y", "z")], ddl))]
    found = dimension.content_digests(*tables)
    assert found[0] == found[1] == dimension.content_digest(tables[0]) and len(set(found)) == len(tables) - 1
    plan = tables[0].agg(dimension.digest(["a", "b"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan and "decimal" not in plan.lower()


def test_load_of_a_transaction_by_its_time(spark):
    rows = [("2021-02-01 00:00:00",), ("2021-03-01 00:00:00",), ("2021-03-02 23:59:59.999",), ("2021-03-03 00:00:00",), ("2022-01-01 00:00:00",)]
    df = spark.createDataFrame([(ts(t),) for t, in rows] + [(None,)], "t timestamp_ntz")
    got = [r[0] for r in df.select(daily._owner_load(F.col("t"), [D[2], D[0]])).collect()]
    assert got == ["2021-03-01", "2021-03-01", "2021-03-01", "2021-03-03", "2021-03-03", "2021-03-01"]


def test_compaction_deals_one_load_to_many_tasks(spark, masters):
    """A load's rows are merged by more than one task, each row once."""
    store = daily.Store.fresh(spark, "spread")
    none = spark.createDataFrame([], BLACKLIST)
    rows = [[(f"{k}-{i}", f"2021-03-01 10:{i // 60 + 20 * k:02d}:{i % 60:02d}") for i in range(400)] for k in range(2)]
    daily.deliver(spark, store, [D[0]], _tx(spark, *rows[0]), {D[0]: _cut(spark, 3)}, {D[0]: none}, masters, _midnight)
    daily.deliver(spark, store, [D[0]], _tx(spark, *rows[1]), report_dt=_midnight)
    before = _rows(daily.facts(spark, store, daily.loads(spark, store).values()))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        assert daily.compact(spark, store) == 2
    finally:
        spark.conf.set(coalesce, "true")
    load = daily.loads(spark, store)[D[0]]
    assert _rows(daily.facts(spark, store, [load])) == before and len(before) == 800
    files = [f for f in os.listdir(_local(store.path(daily.FACT_TX, load.facts[0]))) if f.endswith(".parquet")]
    assert len(files) > 3
