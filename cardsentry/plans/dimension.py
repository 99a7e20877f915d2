"""The terminal dimension as stored: open rows in hash buckets of the key.

    dim_terminals_hist/<folder of a load>/part=open/bucket=B/     open rows
    dim_terminals_hist/<folder of a load>/part=closed/bucket=B/   rows it closed

A load names the folder of each bucket's open rows and a digest of the live
ones.  A cut is digested by the same buckets in one pass with map-side
combination, and only buckets whose digest differs are read, joined with their
part of the cut and written; every other bucket stays where an earlier load put
it.  So a day costs one pass over the cut plus the touched buckets, and nothing
of the old side is exchanged for what did not change.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.functions import ts_literal
from cardsentry.operators.scd2 import empty_history, scd2_apply
from cardsentry.schemas import OPEN_END, TERMINAL_ATTRS, TERMINAL_KEY, TERMINALS_HIST
from cardsentry.session import hadoop_path

NAMES = [f.name for f in TERMINALS_HIST.fields]
NOTHING = "0"


class Bucket(NamedTuple):
    """Open rows of one hash bucket: their folder (empty: none) and the digest
    of the live ones."""

    number: int
    ref: str
    digest: str


def digest(columns: list[str]) -> Column:
    """Aggregate that tells contents apart whatever their order: number of rows,
    sums over both halves of one 64-bit hash and the parity of another.  A null
    is told from any value by a flag of its own."""
    row = [F.lit(",".join(columns)), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))]]
    h = F.xxhash64(*row)
    sums = [F.coalesce(F.try_sum(half), F.lit(0)).cast("string") for half in (F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return F.concat_ws("/", F.count(F.lit(1)).cast("string"), *sums,
                       F.coalesce(F.bit_xor(F.xxhash64(F.lit("second"), *row)), F.lit(0)).cast("string"))


def content_digests(*tables: DataFrame) -> list[str]:
    """Digest of each table, all in one job: one row a table."""
    each = [df.agg(F.lit(i).alias("i"), digest(df.columns).alias("d")) for i, df in enumerate(tables)]
    return [r.d for r in sorted(reduce(DataFrame.unionByName, each).collect())]


def content_digest(df: DataFrame) -> str:
    return content_digests(df)[0]


def bucket_of(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(TERMINAL_KEY)), F.lit(n_buckets)).cast("int")


def bucket_digests(cut: DataFrame, n_buckets: int) -> dict[int, str]:
    """Digest of every bucket of a cut: one row per bucket."""
    by = cut.groupBy(bucket_of(n_buckets).alias("b")).agg(digest([TERMINAL_KEY, *TERMINAL_ATTRS]).alias("d"))
    return {r.b: r.d for r in by.collect()}


def cut_digest(digests: dict[int, str]) -> str:
    return ";".join(f"{b}:{d}" for b, d in sorted(digests.items()))


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    if not paths:
        return empty_history(spark)
    # Folders of several loads: their names are no partition columns.
    return spark.read.schema(TERMINALS_HIST).option("recursiveFileLookup", True).parquet(*paths)


def apply_cut(spark: SparkSession, table: str, ref: str, before: tuple[Bucket, ...], cut: DataFrame, as_of: dt.datetime,
              n_buckets: int, digests: dict[int, str] | None = None) -> tuple[tuple[Bucket, ...], tuple[str, ...]]:
    """The buckets after a full cut, and the folder of the rows it closed (one
    or none).  New rows go to ``table/ref``."""
    wanted = bucket_digests(cut, n_buckets) if digests is None else digests
    if before and len(before) != n_buckets:
        raise ValueError(f"the dimension has {len(before)} buckets, not {n_buckets}")
    had = {b.number: b for b in before or [Bucket(b, "", NOTHING) for b in range(n_buckets)]}
    touched = [b for b in range(n_buckets) if wanted.get(b, NOTHING) != had[b].digest]
    if not touched:
        return tuple(had.values()), ()
    opened = read_rows(spark, [f"{table}/{had[b].ref}" for b in touched if had[b].ref])
    part = cut.where(bucket_of(n_buckets).isin(touched))
    is_open = F.col("effective_to") == ts_literal(OPEN_END)
    rows = scd2_apply(opened, part, as_of).withColumns({
        "part": F.when(is_open, "open").otherwise("closed"), "bucket": bucket_of(n_buckets)})
    rows.repartition("bucket").sortWithinPartitions("part", "bucket").write.partitionBy("part", "bucket").parquet(f"{table}/{ref}")
    written = {int(n.split("=")[1]) for n in _folders(spark, f"{table}/{ref}/part=open") if n.startswith("bucket=")}
    after = tuple(Bucket(b, f"{ref}/part=open/bucket={b}" if b in written else "", wanted.get(b, NOTHING)) if b in touched else had[b]
                  for b in range(n_buckets))
    return after, (f"{ref}/part=closed",) if _folders(spark, f"{table}/{ref}/part=closed") else ()


def read_history(spark: SparkSession, table: str, buckets: tuple[Bucket, ...], closed: list[str]) -> DataFrame:
    """Open rows of all buckets and the closed rows of the given folders."""
    return read_rows(spark, [f"{table}/{b.ref}" for b in buckets if b.ref]).unionByName(
        read_rows(spark, [f"{table}/{c}" for c in closed]))
