"""URL rules by a sort-merge range join (operator 9).

A host is written backwards, one ``/`` after each label (``com/example/www/``;
a host has no ``/``), so a rule's host and all its subdomains are the keys with
one prefix: an interval.  URLs are dealt into key ranges by sampled bounds; a
rule goes to every range that its interval meets; each range is sorted and
swept once, with a stack of the rule hosts whose intervals are open.  Intervals
of prefixes nest or are apart, so closing is popping.  Along the stack a rule
fits if the URL's path starts with its path; the longest rule wins.

Bounds include the path and a hash of the id, so one host, or one URL, may
spread over many ranges.  The sample sets the bounds only and never changes a
verdict.

Defined cases: a null URL or one without ``://`` has empty host and path; of
rules equally long the one with the longer host wins, then ``block`` before
``allow``; a rule without host, path or action is left out; repeated rows are
judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows sampled for the bounds, whatever the input; bounds for that many ranges per task.
SAMPLE_ROWS = 20_000
RANGES_PER_TASK = 4

Bound = tuple[str, str, int]


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels backwards, each closed by a ``/``."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/"))


def _bounds(keyed: DataFrame, ranges: int) -> list[Bound]:
    rows = keyed.count()
    if not rows:
        return []
    picked = keyed.sample(min(1.0, SAMPLE_ROWS / rows), seed=7).select("key", "path", "salt").collect()
    picked = sorted((r.key, r.path, r.salt) for r in picked)
    return sorted({picked[i * len(picked) // ranges] for i in range(1, ranges)}) if picked else []


_URL = pa.schema([("range", pa.int32()), ("key", pa.string()), ("kind", pa.int32()), ("path", pa.string()),
                  ("id", pa.int64()), ("host", pa.string()), ("action", pa.string())])
_URL_DDL = "range int, key string, kind int, path string, id long, host string, action string"


def _deal_urls(bounds: list[Bound]):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = zip(b.column("key").to_pylist(), b.column("path").to_pylist(), b.column("salt").to_pylist(), strict=True)
            ranges = pa.array([bisect_right(bounds, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ranges, b.column("key"), pa.array([1] * b.num_rows, pa.int32()), b.column("path"), b.column("id"),
                 b.column("host"), pa.nulls(b.num_rows, pa.string())], schema=_URL)

    return deal


def _deal_rules(bounds: list[Bound]):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                # Keys with this prefix end before the prefix with its last "/" raised to "0".
                first = bisect_right(bounds, (row["key"], "", -(1 << 63)))
                last = bisect_right(bounds, (row["key"][:-1] + "0", "", -(1 << 63)))
                n = last - first + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(first, last + 1), pa.int32()), pa.array([row["key"]] * n), pa.array([0] * n, pa.int32()),
                     pa.array([row["path"]] * n), pa.nulls(n, pa.int64()), pa.array([row["host"]] * n),
                     pa.array([row["action"]] * n)], schema=_URL)

    return deal


class _Sweep:
    """Stack of open rule hosts: key, host, and its paths with their actions."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str, dict[str, str]]] = []

    def close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, host: str, path: str, action: str) -> None:
        self.close(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, host, {}))
        paths = self.stack[-1][2]
        paths[path] = max(paths.get(path, action), action)  # "block" sorts after "allow"

    def judge(self, key: str, path: str) -> tuple[str, str] | None:
        self.close(key)
        best = None
        for _, host, paths in self.stack:
            # Prefixes of the URL's path, so the cost is the path's length however many rules the host has.
            fits = [p for p in paths if path.startswith(p)] if len(paths) <= len(path) else [
                path[:i] for i in range(len(path) + 1) if path[:i] in paths]
            for p in fits:
                found = (len(host) + len(p), len(host), host + p, paths[p])
                best = found if best is None or found[:2] > best[:2] else best
        return best and best[2:]


def _sweep(default: str):
    out = pa.schema([("id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, at = _Sweep(), None
        for b in batches:
            rows = []
            columns = (b.column(n).to_pylist() for n in _URL.names)
            for rng, key, kind, path, ident, host, action in zip(*columns, strict=True):
                if rng != at:
                    state, at = _Sweep(), rng
                if kind == 0:
                    state.open(key, host, path, action)
                else:
                    rule, verdict = state.judge(key, path) or (None, default)
                    rows.append((ident, host, path, rule, verdict))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(out)], schema=out)

    return sweep


def judge_urls(pages: DataFrame, rules: DataFrame, *, key: str = "page_id", url: str = "url",
               default: str = "allow") -> DataFrame:
    """host, path, rule and verdict of every row.  ``rules`` has host, path
    and action (allow or block); it is sorted and swept like the URLs and may
    be large."""
    u = F.col(url).cast("string")
    keyed = pages.select(F.col(key).cast("long").alias("id"), url_host(u).alias("host"), url_path(u).alias("path"))
    keyed = keyed.select("id", "host", "path", host_key(F.col("host")).alias("key"), F.xxhash64("id").alias("salt"))
    ruled = rules.where("host is not null and path is not null and action is not null").select(
        host_key(F.col("host")).alias("key"), "host", "path", "action")
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(keyed, tasks * RANGES_PER_TASK)
    dealt = keyed.mapInArrow(_deal_urls(bounds), _URL_DDL).unionByName(ruled.mapInArrow(_deal_rules(bounds), _URL_DDL))
    return (
        dealt.repartition(tasks, "range")
        .sortWithinPartitions("range", "key", "kind", "path")
        .mapInArrow(_sweep(default), "id long, host string, path string, rule string, verdict string")
        .withColumnRenamed("id", key)
    )
