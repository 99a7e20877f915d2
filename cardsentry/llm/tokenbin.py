"""Token-id shards with a minimal perfect hash index (operator 10).

``write_shards`` sorts the documents by key over range partitions; each task
encodes its texts as a stream and writes two files:

``*.ids``   raw ids, little-endian, uint16 when the vocabulary allows, else uint32
``*.idx``   header; per record its key and id count, in file order; the minimal
            perfect hash over the distinct keys; per slot a 32-bit key
            fingerprint, the first record of the key and its number of records

``MphIndex`` is a cascade of bit arrays: a key alone at its bit of a level is
placed there, the others go on to the next level; a key's slot is the rank of
its bit, so n keys fill slots 0..n-1.  ``Shard.find`` answers a key with one
rank, one fingerprint compare and the record's offset.

Only files named by the manifest count, so a task that ran twice or died
leaves nothing readable behind.  Files go through ``pyarrow.fs``, so the
folder may be any store pyarrow reaches.

Defined cases: a null or empty text is the end id alone; a repeated key keeps
all its records, found as one run; rows with a null key come first, are
written and read back, and are not in the index; records of one key follow each
other in any order; a text of any length is one record; an empty table gives an
empty manifest; only key and text are read, so other columns' names do not
matter.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import spread_partitions
from cardsentry.llm.wordids import text_encoder

MAGIC = b"CSIDX001"
SHARD_ROWS = 500_000
READ_BYTES = 8 << 20

_MANIFEST = pa.schema([
    ("shard", pa.int64()), ("file", pa.string()), ("first_key", pa.int64()), ("last_key", pa.int64()),
    ("n_records", pa.int64()), ("n_ids", pa.int64()),
])
_MANIFEST_DDL = "shard long, file string, first_key long, last_key long, n_records long, n_ids long"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[len("file:"):]
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finalizer over ``keys`` with a seed per level."""
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1_000_003) >> np.uint64(32)).astype(np.uint32)


class MphIndex:
    """Minimal perfect hash over distinct 64-bit keys."""

    GAMMA = 2.0

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.starts = np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.uint64) if sizes else np.zeros(0, np.uint64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def build(cls, keys: np.ndarray) -> "MphIndex":
        left, sizes, bits = keys.astype(np.uint64), [], []
        while len(left):
            size = -(-max(64, int(len(left) * cls.GAMMA)) // 64) * 64
            at = _mix(left, len(sizes)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            bits.append(alone)
            sizes.append(size)
            left = left[~alone[at.astype(np.int64)]]
            if len(sizes) > 200:
                raise ValueError("keys are not distinct")
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        return cls(sizes, np.packbits(flat, bitorder="little").view("<u8"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for a key certainly not in the set."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            at = self.starts[level] + _mix(keys[todo], level) % np.uint64(size)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            own = self.words[word]
            hit = (own >> bit) & np.uint64(1) == 1
            below = own & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = self.before[word[hit]] + np.bitwise_count(below[hit])
            todo = todo[~hit]
        return out


def index_bytes(keys: np.ndarray, n_null: int, counts: np.ndarray, width: int) -> bytes:
    """The ``.idx`` file: ``keys`` in file order without the null ones,
    ``counts`` of all records."""
    distinct, first, repeats = np.unique(keys, return_index=True, return_counts=True)
    mph = MphIndex.build(distinct.view(np.uint64))
    slot = mph.slots(distinct.view(np.uint64))
    prints = np.empty(len(distinct), "<u4")
    record = np.empty(len(distinct), "<u4")
    times = np.empty(len(distinct), "<u4")
    prints[slot], record[slot], times[slot] = fingerprint(distinct.view(np.uint64)), first + n_null, repeats
    head = struct.pack("<8sIIIIQ", MAGIC, width, n_null, len(mph.sizes), len(distinct), len(counts))
    return b"".join([
        head, np.asarray(mph.sizes, "<u8").tobytes(), mph.words.astype("<u8").tobytes(), prints.tobytes(),
        record.tobytes(), times.tobytes(), keys.astype("<i8").tobytes(), counts.astype("<u4").tobytes(),
    ])


class Shard:
    """One shard opened for reading."""

    def __init__(self, folder: str, name: str):
        self.store, root = open_folder(folder)
        self.payload = f"{root}/{name}.ids"
        with self.store.open_input_file(f"{root}/{name}.idx") as f:
            raw = f.read()
        magic, self.width, self.n_null, levels, distinct, records = struct.unpack_from("<8sIIIIQ", raw)
        if magic != MAGIC:
            raise ValueError(f"{name}.idx is not an index of this format")
        at = struct.calcsize("<8sIIIIQ")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        sizes = [int(x) for x in take("<u8", levels)]
        self.mph = MphIndex(sizes, take("<u8", sum(sizes) // 64))
        self.prints, self.record, self.times = take("<u4", distinct), take("<u4", distinct), take("<u4", distinct)
        self.keys, self.counts = take("<i8", records - self.n_null), take("<u4", records)
        self.offsets = np.concatenate([[0], np.cumsum(self.counts, dtype=np.int64)])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; 0 records where
        the fingerprint says that the key is not there."""
        keys = np.asarray(keys, np.int64).view(np.uint64)
        slot = self.mph.slots(keys)
        there = slot >= 0
        there[there] = self.prints[slot[there]] == fingerprint(keys[there])
        first, times = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[there], times[there] = self.record[slot[there]], self.times[slot[there]]
        return first, times

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of every record of ``key``."""
        first, times = self.find(np.array([key]))
        return list(self.ids(range(int(first[0]), int(first[0] + times[0]))))

    def ids(self, records) -> Iterator[np.ndarray]:
        """Ids of ascending records, read in blocks of about READ_BYTES."""
        low, block = 0, b""
        with self.store.open_input_file(self.payload) as f:
            end = self.offsets[-1] * self.width
            for r in records:
                a, b = int(self.offsets[r]) * self.width, int(self.offsets[r + 1]) * self.width
                if b > low + len(block) or a < low:
                    low, block = a, f.read_at(int(min(end, max(b, a + READ_BYTES)) - a), a)
                yield np.frombuffer(block, f"<u{self.width}", (b - a) // self.width, a - low)


def _shard_writer(folder: str, tokenizer_path: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer_path)
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex[:12]}"
        store, root = open_folder(folder)
        keys, counts, n_null, out = [], [], 0, None
        tail = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or store.open_output_stream(f"{root}/{name}.ids")
            n_null += batch.column(0).null_count
            keys.append(batch.column(0).drop_null().to_numpy(zero_copy_only=False))
            for text in batch.column(1):
                raw = encoder.encode(text.as_py() or "") + tail
                counts.append(len(raw) // 4)
                out.write(raw if width == 4 else np.frombuffer(raw, "<u4").astype("<u2").tobytes())
        if out is None:
            return
        out.close()
        flat, n = np.concatenate(keys).astype(np.int64), np.array(counts, np.int64)
        with store.open_output_stream(f"{root}/{name}.idx") as f:
            f.write(index_bytes(flat, n_null, n, width))
        low, high = (int(flat[0]), int(flat[-1])) if len(flat) else (None, None)
        yield pa.RecordBatch.from_pylist(
            [dict(shard=shard, file=name, first_key=low, last_key=high, n_records=len(n), n_ids=int(n.sum()))],
            schema=_MANIFEST,
        )

    return write


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, *, key: str = "doc_id", text: str = "text",
                 end_id: int = 0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Write the shards and the manifest into ``folder`` (shared, fresh) and
    return the manifest, one row per shard.

    The range keys are the document key and a hash of the text, so rows that
    share a key spread over shards."""
    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    n = spread_partitions(docs, docs.count(), shard_rows)
    (
        rows.withColumn("h", F.xxhash64("t"))
        .repartitionByRange(n, "k", "h")
        .sortWithinPartitions("k", "h")
        .select("k", "t")
        .mapInArrow(_shard_writer(folder, tokenizer_path, end_id), _MANIFEST_DDL)
        .write.parquet(f"{folder}/manifest")
    )
    return docs.sparkSession.read.schema(_MANIFEST_DDL).parquet(f"{folder}/manifest")


def _record_reader(folder: str):
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, base in zip(frame["file"], frame["start"], strict=True):
                shard = Shard(folder, name)
                nulls = np.arange(shard.n_null)
                distinct = shard.keys[np.r_[True, shard.keys[1:] != shard.keys[:-1]]] if len(shard.keys) else shard.keys
                for lo in range(0, max(1, len(distinct)), 4096):
                    first, times = shard.find(distinct[lo:lo + 4096])
                    records = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
                    keys = pd.array(np.repeat(distinct[lo:lo + 4096], times), dtype="Int64")
                    if lo == 0 and shard.n_null:
                        records = np.concatenate([nulls, records])
                        keys = pd.array([pd.NA] * shard.n_null + list(keys), dtype="Int64")
                    if len(records):
                        yield pd.DataFrame({
                            "doc_id": keys,
                            "start": base + shard.offsets[records],
                            "n_tokens": shard.counts[records].astype(np.int64),
                            "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in shard.ids(records)],
                        })

    return read


def read_records(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record, read back from the shard files: each distinct key
    goes through the index, each payload is read and summed.

    The driver sees the manifest only: one small row per shard."""
    shards = sorted(manifest.collect(), key=lambda r: r.shard)
    starts = accumulate((r.n_ids for r in shards), initial=0)
    rows = [(r.file, s) for r, s in zip(shards, starts, strict=False)]
    if not rows:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    named = spark.sparkContext.parallelize(rows, len(rows))
    return spark.createDataFrame(named, "file string, start long").mapInPandas(
        _record_reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(folder: str, shards: list, key: int) -> list[np.ndarray]:
    """Ids of every record of one key; ``shards`` are the manifest's rows."""
    near = [r for r in shards if r.first_key is not None and r.first_key <= key <= r.last_key]
    return [ids for r in near for ids in Shard(folder, r.file).get(key)]


def describe(shards: list) -> str:
    """Totals of a manifest as JSON."""
    return json.dumps({"shards": len(shards), "records": sum(r.n_records for r in shards), "ids": sum(r.n_ids for r in shards)})
