"""Best-fit-decreasing packing of documents into fixed windows (operator 5).

Documents longer than a window are first cut into full windows; the remainders
are packed by best-fit decreasing.  Best fit looks at lengths only, so the
packing is planned on the histogram of piece lengths, at most ``window`` rows
whatever the corpus: lengths in decreasing order, and a segment tree over
remaining capacity that answers the tightest open window.  Pieces of one
length go into a run of equal windows at once; this is exactly what placing
them one by one does, since a window that has just taken a piece and still has
room for another is the tightest.  The plan maps ranks within a length to
windows, and each piece finds its window by its rank: one counted exchange,
no sequential pass over the data, one packing for the whole corpus.

Defined cases: a null or empty text is the end id alone; a text of any length is
encoded whole and cut into full windows; repeated rows are pieces of their own;
pieces of equal length may change places, and the windows' fill stays the same;
a null doc_id is kept; an empty table gives no pieces; only key and text are
read, so other columns' names do not matter.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import materialize, spread_partitions
from cardsentry.llm.wordids import text_encoder

BUCKET_ROWS = 200_000


class CapacityTree:
    """Segment tree over capacities 0..window: which have open windows."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.any = [False] * (2 * self.size)

    def set(self, capacity: int, present: bool) -> None:
        i = capacity + self.size
        self.any[i] = present
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, length: int) -> int | None:
        """Smallest capacity >= ``length`` that has an open window."""
        i = length + self.size
        if self.any[i]:
            return i - self.size
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def plan_best_fit(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, rank_from, rank_to, first_window, per_window, offset):
    the pieces of ``length`` with ranks [rank_from, rank_to) fill windows
    first_window, first_window + 1, ..., per_window in each, from ``offset``."""
    tree = CapacityTree(window)
    open_runs: dict[int, deque[tuple[int, int]]] = {}
    plan: list[tuple[int, int, int, int, int, int]] = []
    opened = 0

    def put(capacity: int, low: int, high: int, front: bool = False) -> None:
        if low < high and capacity:
            runs = open_runs.setdefault(capacity, deque())
            (runs.appendleft if front else runs.append)((low, high))
            tree.set(capacity, True)

    for length in sorted(histogram, reverse=True):
        done, count = 0, histogram[length]
        while done < count:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity = window
                low, high = opened, opened + -(-(count - done) // (window // length))
                opened = high
            else:
                low, high = open_runs[capacity].popleft()
                if not open_runs[capacity]:
                    tree.set(capacity, False)
            per = capacity // length
            full = min(high - low, (count - done) // per)
            if full:
                plan.append((length, done, done + full * per, low, per, window - capacity))
                put(capacity - per * length, low, low + full)
                done += full * per
                low += full
            if low < high and done < count:
                rest = count - done
                plan.append((length, done, count, low, rest, window - capacity))
                put(capacity - rest * length, low, low + 1)
                done, low = count, low + 1
            put(capacity, low, high, front=True)
    return plan


def _cutter(tokenizer_path: str, end_id: int, window: int, keep_ids: bool, schema: pa.Schema):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer_path)
        tail = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                raw = encoder.encode(text.as_py() or "") + tail
                n = len(raw) // 4
                for start in range(0, n, window):
                    piece = raw[4 * start:4 * (start + window)]
                    rows.append((key.as_py(), start, len(piece) // 4, zlib.crc32(piece), n, *[piece] * keep_ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return cut


def cut_pieces(docs: DataFrame, tokenizer_path: str, *, window: int, end_id: int, key: str = "doc_id",
               text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens
    and, if asked for, their ids as little-endian uint32 bytes."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = pa.schema([(n, pa.int64()) for n in names] + [("ids", pa.binary())] * keep_ids)
    ddl = ", ".join(f"{n} long" for n in names) + ", ids binary" * keep_ids
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(_cutter(tokenizer_path, end_id, window, keep_ids, schema), ddl)


def place(pieces: DataFrame, window: int) -> DataFrame:
    """Add sequence_id and offset to stored pieces (any columns beside
    doc_id, start, length and ids_crc32 are carried along)."""
    n = spread_partitions(pieces, pieces.count(), BUCKET_ROWS)
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(n)))
    counts = materialize(dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n")), "packing-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        dealt.withColumn("_own", F.row_number().over(own) - 1)
        .join(base, ["length", "_bucket"])
        .withColumn("_rank", F.col("_base") + F.col("_own"))
    )
    plan = pieces.sparkSession.createDataFrame(
        plan_best_fit(histogram, window),
        "_length long, _from long, _to long, _first long, _per long, _offset long")
    # The plan's size depends on the window length only, not on the corpus.
    at = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    placed = ranked.join(F.broadcast(plan), at)
    nth = F.col("_rank") - F.col("_from")
    return placed.select(
        *pieces.columns,
        (F.col("_first") + F.floor(nth / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_per") * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer_path: str, *, window: int = 4096, end_id: int = 2, key: str = "doc_id",
         text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pack every document; one row per piece with its sequence and offset."""
    pieces = materialize(
        cut_pieces(docs, tokenizer_path, window=window, end_id=end_id, key=key, text=text, keep_ids=keep_ids),
        "packing-pieces")
    return place(pieces, window)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with their ids: one row
    per sequence, its ids as little-endian uint32 bytes and its length.  A
    sequence holds at most ``window`` ids, which bounds each group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_ids"),
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
    )
