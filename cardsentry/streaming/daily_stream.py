"""The daily cycle as an incremental job over a landing folder.

Landing layout, all delimited text with a header::

    <landing>/transactions/   transactions_ddmmyyyy.txt        (one or more per day)
    <landing>/terminals/      terminals_ddmmyyyy.txt           (full cut)
    <landing>/blacklist/      passport_blacklist_ddmmyyyy.txt  (cumulative)

A Structured Streaming source watches the *files* of all three folders with
``Trigger.AvailableNow``: each run takes every file not yet seen (the checkpoint
remembers them), then stops.  Only names and lengths pass through the stream, so
a day is known by its file even if the file holds a header and no row; one
without a byte, which the source passes over, is taken with the next batch.  ``foreachBatch`` takes the days of the transaction files, with the cut
and the blacklist of each day if there are any, and, for days already loaded,
cuts and lists that came later; the rows are typed into a staging folder and the
whole batch is handed to :func:`cardsentry.plans.daily.deliver`, which publishes
it in one step.  Each drop is optional: a day without a cut or a list keeps those
of the day before.  A cut or list whose day has no transaction file yet waits in
the landing folder.

No row is consumed without a trace: what does not parse, stands in a file
without a date in its name or in one without the right header is in the
quarantine table; such a file never fails a batch, and a cut without a single
good row counts as missing, since taking it would delete every terminal.

After publication the files that the batch took are moved into ``archive_dir``,
all three kinds.  A batch replayed after a crash is done again whole if it was
not published; if it was, only the files not yet moved are moved.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.plans import daily
from cardsentry.schemas import TERMINAL_ATTRS, TERMINAL_KEY
from cardsentry.session import hadoop_path, materialize, scratch_scope
from cardsentry.sources import delimited
from cardsentry.sources.masters import Masters

TRANSACTIONS, TERMINALS, BLACKLIST = "transactions", "terminals", "blacklist"
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
ReportTime = dt.datetime | Callable[[dt.date], dt.datetime] | None


def _day(path: str) -> dt.date | None:
    """Day of a file, or of the folder it is a part of."""
    token = re.search(delimited.DATE_TOKEN, path)
    try:
        return dt.datetime.strptime(token.group(1), "%d%m%Y").date() if token else None
    except ValueError:
        return None


def _below(path: str, landing: str) -> str | None:
    """Path of a file relative to the landing folder (None: not in it)."""
    plain = [re.sub(r"^\w+:/*", "/", p).rstrip("/") for p in (path, landing)]
    return plain[0][len(plain[1]) + 1:] if plain[0].startswith(plain[1] + "/") else None


def listed(spark: SparkSession, folder: str, empty: bool = False) -> list[str]:
    """Files of a landing folder, those of its folders too (``empty``: only
    files without a byte); none if it is missing."""
    fs, p = hadoop_path(spark, folder)
    if not fs.exists(p):
        return []
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        status = it.next()
        found = status.getPath()
        if (not empty or status.getLen() == 0) and not found.getName().startswith(("_", ".")):
            out.append(found.toString())
    return sorted(out)


def _quarantine(store: daily.Store, drop: str, tag: str, rows: DataFrame) -> None:
    rows.write.mode("overwrite").parquet(f"{store.table(daily.QUARANTINE)}/{drop}/batch={tag}")


def _typed(spark: SparkSession, files: list[str], names: Iterable[str], typing, sep: str, drop: str, store: daily.Store, tag: str) -> DataFrame:
    """Good rows of some files, typed once; the others go to quarantine."""
    lines = delimited.read_lines(spark, files)
    typed = materialize(typing(delimited.bind_columns(lines, tuple(names), sep, strict=False)), drop)
    parsed = delimited.split_typed(typed)
    _quarantine(store, drop, tag, parsed.quarantine)
    return parsed.good


def _by_day(good: DataFrame, days: Iterable[dt.date]) -> dict[dt.date, DataFrame]:
    """Rows of every day that has any."""
    there = {r[0] for r in good.select("load_date").distinct().collect()}
    return {d: good.where(F.col("load_date") == F.lit(d)).drop("load_date", "source_file") for d in days if d in there}


def process_files(spark: SparkSession, files: Iterable[str], landing: str, store: daily.Store, masters: Masters | None,
                  tag: str, sep: str = ";", report_dt: ReportTime = None, archive_dir: str | None = None) -> list[dt.date]:
    """Take in the given new files of the landing folder; returns the days
    whose report was made anew."""
    published = daily.loads(spark, store)
    # The stream shows no file without a byte: such a day waits for the next batch.
    arrived = sorted({*files, *(f for f in listed(spark, f"{landing}/{TRANSACTIONS}", empty=True) if _day(f) and _day(f) not in published)})
    kinds = {kind: [f for f in arrived if f"/{kind}/" in f] for kind in (TRANSACTIONS, TERMINALS, BLACKLIST)}
    days = {_day(f) for f in kinds[TRANSACTIONS]} - {None}
    later = {_day(f) for kind in (TERMINALS, BLACKLIST) for f in kinds[kind]} & set(published)
    taken = {TRANSACTIONS: kinds[TRANSACTIONS]}
    for kind in (TERMINALS, BLACKLIST):  # waiting since an earlier batch, or new
        taken[kind] = [f for f in listed(spark, f"{landing}/{kind}") if _day(f) in days | later]
    redone: list[dt.date] = []
    if tag not in daily.published_sources(spark, store):
        with scratch_scope(spark):
            rows = cuts = lists = None
            if taken[TRANSACTIONS]:
                rows = _typed(spark, taken[TRANSACTIONS], delimited.TX_NAMES, delimited.type_transactions, sep, TRANSACTIONS, store, tag)
                rows = rows.drop("source_file", "load_date")
            if taken[TERMINALS]:
                cuts = _by_day(_typed(spark, taken[TERMINALS], (TERMINAL_KEY, *TERMINAL_ATTRS), delimited.type_terminals, sep, TERMINALS, store, tag), days | later)
            if taken[BLACKLIST]:
                lists = _by_day(_typed(spark, taken[BLACKLIST], ("date", "passport"), delimited.type_blacklist, sep, BLACKLIST, store, tag), days | later)
            if days | later:
                redone = daily.deliver(spark, store, days | later, rows, cuts, lists, masters, report_dt, tag)
    if archive_dir:
        _archive(spark, [f for some in taken.values() for f in some], landing, archive_dir, tag)
    return redone


def process_batch(spark: SparkSession, batch: DataFrame, landing: str, store: daily.Store,
                  masters: Masters | None, tag: str, sep: str = ";", report_dt: ReportTime = None) -> list[dt.date]:
    """The same for raw transaction lines (``value``, ``source_file``): takes in
    the files that they stand in."""
    files = [r[0] for r in batch.select("source_file").distinct().collect()]  # one row per file
    return process_files(spark, files, landing, store, masters, tag, sep, report_dt)


def _archive(spark: SparkSession, files: list[str], landing: str, archive_dir: str, tag: str) -> None:
    """Move files to the same place below the archive; those already moved are
    skipped, and a name taken before gets the tag."""
    for f in files:
        fs, source = hadoop_path(spark, f)
        where = _below(f, landing)
        if where is None or not fs.exists(source):
            continue
        _, target = hadoop_path(spark, f"{archive_dir}/{where}")
        if fs.exists(target):
            _, target = hadoop_path(spark, f"{archive_dir}/{tag}/{where}")
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"{f} was not moved to {target.toString()}")


def run_available(spark: SparkSession, landing: str, store: daily.Store, masters: Masters | None,
                  archive_dir: str | None = None, checkpoint: str | None = None,
                  sep: str = ";", report_dt: ReportTime = None, compact_at: int = 64,
                  retain: dt.timedelta | None = dt.timedelta(days=7)) -> list[dt.date]:
    """Take in every file that arrived since the last run; returns the load
    days whose report was made anew (in order).  Afterwards the parts of loads
    are merged where ``compact_at`` of them have gathered, and folders that
    nothing has named for ``retain`` are removed (None: none are)."""
    source = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", True)
              .load(f"{landing}/{{{TRANSACTIONS},{TERMINALS},{BLACKLIST}}}").select("path", "length"))
    done: list[dt.date] = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        files = [r.path for r in batch.select("path").collect()]  # one row per file
        done.extend(process_files(spark, files, landing, store, masters, f"batch-{batch_id}", sep, report_dt, archive_dir))

    query = (
        source.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint or f"{store.root}/_checkpoints/landing")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    daily.compact(spark, store, compact_at)
    if retain is not None:
        daily.vacuum(spark, store, retain)
    return done
