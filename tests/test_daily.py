"""Daily cycle: deliveries add up to one load of all rows, are published whole
or not at all, and never depend on the session's overwrite mode."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardsentry.plans import daily
from cardsentry.schemas import ACCOUNTS, BLACKLIST, CARDS, CLIENTS, EVENT_BLOCKED_PASSPORT, EVENT_CITY_HOP
from cardsentry.sources.masters import Masters
from conftest import ts

D1, D2, D3 = (dt.date(2021, 3, i) for i in (1, 2, 3))
TX = ("trans_id string, transaction_date timestamp_ntz, card_num string, amount double, "
      "oper_type string, oper_result string, terminal string")
CUT = "terminal_id string, terminal_type string, terminal_city string, terminal_address string"


def _midnight(d):
    return dt.datetime.combine(d, dt.time())


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def masters(spark):
    return Masters(
        spark.createDataFrame([("K3", "A3", None, None)], CARDS),
        spark.createDataFrame([("A3", dt.date(2030, 1, 1), "C3", None, None)], ACCOUNTS),
        spark.createDataFrame([("C3", "S", "S", "S", None, "P3", None, "+7 3", None, None)], CLIENTS))


@pytest.fixture
def cut(spark):
    return spark.createDataFrame([("T1", "POS", "Moscow", "a"), ("T2", "POS", "Kazan", "b")], CUT)


@pytest.fixture
def none_listed(spark):
    return spark.createDataFrame([], BLACKLIST)


def _tx(spark, *rows):
    return spark.createDataFrame([(i, ts(t), "K3", 1.0, "p", "SUCCESS", term) for i, t, term in rows], TX)


A = ("a", "2021-03-01 10:00:00", "T1")
B = ("b", "2021-03-01 10:20:00", "T2")
C = ("c", "2021-03-02 00:10:00", "T1")
LATE = ("z", "2021-03-01 23:50:00", "T2")


def _load(spark, store, masters, cut, listed, day, *rows, **kw):
    return daily.deliver(spark, store, [day], _tx(spark, *rows), {day: cut}, {day: listed}, masters, report_dt=_midnight, **kw)


def _hops(spark, store):
    rep = daily.report(spark, store).where(F.col("event_type") == EVENT_CITY_HOP)
    return sorted(r.event_dt.isoformat(sep=" ") for r in rep.collect())


@pytest.mark.parametrize("lookback, expected", [(True, ["2021-03-02 00:10:00"]), (False, [])])
def test_city_hop_across_midnight(spark, masters, cut, none_listed, lookback, expected):
    store = daily.Store.fresh(spark, "midnight")
    _load(spark, store, masters, cut, none_listed, D1, LATE, lookback=lookback)
    _load(spark, store, masters, cut, none_listed, D2, C, lookback=lookback)
    assert _hops(spark, store) == expected


def test_second_file_of_a_day_adds_rows(spark, masters, cut, none_listed):
    store = daily.Store.fresh(spark, "two-files")
    _load(spark, store, masters, cut, none_listed, D1, A)
    assert daily.deliver(spark, store, [D1], _tx(spark, B), report_dt=_midnight) == [D1]
    assert daily.facts(spark, store, daily.loads(spark, store).values()).count() == 2
    assert _hops(spark, store) == ["2021-03-01 10:20:00"]


def test_late_rows_equal_rows_on_time(spark, masters, cut, none_listed):
    """A row for day 1 that comes with day 3 changes day 1 and the first hour of day 2."""
    late, on_time = daily.Store.fresh(spark, "late"), daily.Store.fresh(spark, "on-time")
    _load(spark, late, masters, cut, none_listed, D1, A)
    _load(spark, late, masters, cut, none_listed, D2, C)
    assert _load(spark, late, masters, cut, none_listed, D3, B, LATE) == [D1, D2, D3]
    _load(spark, on_time, masters, cut, none_listed, D1, A, B, LATE)
    _load(spark, on_time, masters, cut, none_listed, D2, C)
    _load(spark, on_time, masters, cut, none_listed, D3)
    assert _rows(daily.report(spark, late)) == _rows(daily.report(spark, on_time))
    assert _hops(spark, late) == ["2021-03-01 10:20:00", "2021-03-02 00:10:00"]


def test_late_rows_see_the_city_of_their_time(spark, masters, cut, none_listed):
    """A terminal that moved later stays where it was for the rows before."""
    moved = cut.replace({"Kazan": "Moscow"})
    store = daily.Store.fresh(spark, "moved")
    _load(spark, store, masters, cut, none_listed, D1)
    _load(spark, store, masters, moved, none_listed, D2)
    _load(spark, store, masters, moved, none_listed, D3, A, B, ("d", "2021-03-03 10:00:00", "T1"), ("e", "2021-03-03 10:20:00", "T2"))
    assert _hops(spark, store) == ["2021-03-01 10:20:00"]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_corrected_run_equals_a_fresh_one(spark, masters, cut, none_listed, mode):
    """A first run that closes a row, then a corrected cut that closes none."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    fresh, again = daily.Store.fresh(spark, "fresh"), daily.Store.fresh(spark, "again")
    for store in (fresh, again):
        _load(spark, store, masters, cut, none_listed, D1, A)
    _load(spark, again, masters, cut.where("terminal_id = 'T1'"), none_listed, D2, C, LATE)
    daily.run_day(spark, again, D2, _tx(spark, C), none_listed, cut, *masters, _midnight)
    daily.run_day(spark, fresh, D2, _tx(spark, C), none_listed, cut, *masters, _midnight)
    # The late row was added to day 1 and stays there.
    daily.deliver(spark, fresh, [D1], _tx(spark, LATE), report_dt=_midnight)
    for read in (lambda s: daily.report(spark, s), lambda s: daily.history(spark, s, daily.loads(spark, s), D2),
                 lambda s: daily.facts(spark, s, daily.loads(spark, s).values())):
        assert _rows(read(again)) == _rows(read(fresh))
    assert daily.history(spark, again, daily.loads(spark, again), D2).count() == 2


@pytest.mark.parametrize("step", ["require_unique", "_apply_cut", "_inherit", "_make_report", "_publish"])
def test_a_crash_leaves_the_state_before(spark, masters, cut, none_listed, monkeypatch, step):
    store = daily.Store.fresh(spark, "crash")
    _load(spark, store, masters, cut, none_listed, D1, A)
    before, state = _rows(daily.report(spark, store)), daily.loads(spark, store)

    def dies(*args, **kw):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(daily, step, dies)
        with pytest.raises(RuntimeError):
            _load(spark, store, masters, cut.where("terminal_id = 'T2'"), none_listed, D1, B)
    assert daily.loads(spark, store) == state and _rows(daily.report(spark, store)) == before
    assert daily.facts(spark, store, state.values()).count() == 1
    _load(spark, store, masters, cut, none_listed, D1, B)
    assert _hops(spark, store) == ["2021-03-01 10:20:00"]


def test_a_key_listed_twice_fails_the_load(spark, masters, cut, none_listed):
    store = daily.Store.fresh(spark, "twice")
    with pytest.raises(ValueError, match="T1"):
        _load(spark, store, masters, cut.unionByName(cut.limit(1)), none_listed, D1, A)
    assert daily.loads(spark, store) == {}


def test_a_day_takes_the_drops_it_lacks_from_the_day_before(spark, masters, cut):
    listed = spark.createDataFrame([(ts("2021-02-01 00:00:00"), "P3")], BLACKLIST)
    store = daily.Store.fresh(spark, "lacking")
    _load(spark, store, masters, cut, listed, D1, A)
    daily.deliver(spark, store, [D2], _tx(spark, C))
    events = [(r.event_type, r.event_dt.day, r.phone) for r in daily.report(spark, store).collect()]
    assert sorted(events) == [(EVENT_BLOCKED_PASSPORT, 1, "+7 3"), (EVENT_BLOCKED_PASSPORT, 2, "+7 3")]
    # The report's time is that of the run unless it is given.
    newest = daily.loads(spark, store)[D2].report_dt
    assert abs(newest - dt.datetime.now()) < dt.timedelta(hours=1)


def test_masters_of_the_day_are_used_again(spark, masters, cut, none_listed):
    store = daily.Store.fresh(spark, "masters")
    _load(spark, store, masters, cut, none_listed, D1, A)
    moved = masters._replace(clients=masters.clients.replace({"+7 3": "+7 9"}))
    _load(spark, store, moved, cut, none_listed, D2, C, B)
    assert {(r.event_dt.day, r.phone) for r in daily.report(spark, store).collect()} == {(1, "+7 3")}


def test_listing_and_show(spark, masters, cut, none_listed, capsys):
    from cardsentry.plans.catalog import list_columns

    store = daily.Store.fresh(spark, "listing")
    assert list_columns(spark, store) == []
    _load(spark, store, masters, cut, none_listed, D1, A, B)
    found = {(t, c) for t, _, c, _ in list_columns(spark, store)}
    assert {("fact_transactions", "amount"), ("dim_terminals_hist", "effective_to"), ("rep_fraud", "event_type")} <= found
    daily.show_table(spark, store, daily.REPORT)
    assert EVENT_CITY_HOP in capsys.readouterr().out
    assert sorted(r.terminal_id for r in daily.current_terminals(spark, store).collect()) == ["T1", "T2"]


def test_dropping_scratch(spark):
    from cardsentry.session import drop_scratch, materialize, shared_dir

    class Private:
        """A session whose shared folder is its own."""

        _jvm, _jsc = spark._jvm, spark._jsc
        sparkContext = spark.sparkContext

        class conf:
            get = staticmethod(lambda key, default=None: f"{shared_dir(spark)}/private")

    path = f"{shared_dir(Private)}/cardsentry/x"
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    drop_scratch(Private)
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
    assert materialize(spark.range(2), "after").count() == 2
