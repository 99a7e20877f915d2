"""SimHash near-duplicates over a byte-position inverted index (operator 6).

Fingerprints at most ``max_bits`` apart differ in at most that many of their
eight bytes, so they share at least ``8 - max_bits`` bytes position by position
(the guaranteed minimum).  Lists of one positional byte would hold 1/256 of the
corpus each, so the index keeps lists of several positional bytes joined: the
eight positions are cut into ``max_bits + 2`` groups, at least two of which a
linked pair shares whole, and a fingerprint is listed under every pair of
groups.  Within a list the shared positional bytes are tallied per pair, pairs
that reach the minimum are kept and verified by the bits in which they differ.

A list longer than ``LIST_ROWS`` is not paired up.  Its members go, exactly,
under every set of ``8 - max_bits`` positions that holds the list's own:
sharing such a set is reaching the minimum.  Members of one such list differ
in ``max_bits`` bytes only, so it has at most 65,536 of them, and each looks up
its neighbours by flipping at most ``max_bits`` of those bits.

Lists give star links to their own smallest linked member; components come
from alternating large-star and small-star rounds, each round written to the
shared folder.  Equal fingerprints are folded into one row first, so copies
cost one partial aggregate.

Defined cases: a text without words (null, empty) has fingerprint zero and
links like any other; repeated rows share a component; a null doc_id is never
the smallest unless all are null; a bit set in exactly half the hashes is 0; a
text of any length is hashed whole, with eight bytes a shingle in memory; an
empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import ascii_words, materialize, unsigned_hex

LIST_ROWS = 64
SEED = 42


def simhash(text: str | None, ngram: int) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = [w.lower() for w in ascii_words(text)]
    if not words:
        return 0
    if len(words) < ngram:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(ngram)), strict=False))
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[lo:lo + 65_536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def _hasher(ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = [simhash(t.as_py(), ngram) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.int64())], names=[b.schema.names[0], "fp"])

    return run


def fingerprints(docs: DataFrame, ngram: int = 3, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp (signed 64-bit) of every document."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(_hasher(ngram), "doc_id long, fp long")


def _mask(positions: tuple[int, ...]) -> int:
    """Signed mask of the byte positions (0 is the lowest byte)."""
    m = sum(0xFF << 8 * p for p in positions)
    return m - (1 << 64) if m >> 63 else m


def _group_pairs(max_bits: int) -> list[tuple[int, ...]]:
    """Position sets of the first index: every pair of position groups."""
    groups = [tuple(int(p) for p in g) for g in np.array_split(np.arange(8), max_bits + 2)]
    return [a + b for a, b in combinations(groups, 2)]


def _listed(rows: DataFrame, sets: list[tuple[int, ...]], fp: Column) -> DataFrame:
    lists = F.array(*[F.struct(F.lit(i).alias("set"), fp.bitwiseAND(F.lit(_mask(s))).alias("bytes")) for i, s in enumerate(sets)])
    return rows.select("fp", F.explode(lists).alias("l")).select("fp", "l.set", "l.bytes")


def _stars(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest linked member of every value that has links (by index pairs)."""
    root = np.arange(len(values))
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if np.array_equal(before, root):
            break
    moved = np.flatnonzero(root != np.arange(len(values)))
    return values[moved], values[root[moved]]


def _edges(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
    b = np.concatenate([y for _, y in found]) if found else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _count_filter(max_bits: int):
    """Short lists: tally shared positional bytes, keep, verify."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for members in batch.column(0):
                v = np.unique(np.array(members.as_py(), np.int64))
                a, b = np.triu_indices(len(v), 1)
                differ = v[a] ^ v[b]
                shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
                near = shared >= 8 - max_bits
                near[near] = np.bitwise_count(differ[near].view(np.uint64)) <= max_bits
                found.append(_stars(v, a[near], b[near]))
            yield _edges(found)

    return run


def _neighbours(max_bits: int, sets: list[tuple[int, ...]]):
    """Lists that share the minimum: look up every value with up to max_bits of the free bits flipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for which, members in zip(batch.column(0), batch.column(1), strict=True):
                v = np.unique(np.array(members.as_py(), np.int64).view(np.uint64))
                free = [8 * p + i for p in range(8) if p not in sets[which.as_py()] for i in range(8)]
                pairs = []
                for n in range(1, max_bits + 1):
                    for bits in combinations(free, n):
                        other = v ^ np.uint64(sum(1 << x for x in bits))
                        at = np.minimum(np.searchsorted(v, other), len(v) - 1)
                        hit = np.flatnonzero((v[at] == other) & (v < other))
                        if len(hit):
                            pairs.append((hit, at[hit]))
                if pairs:
                    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
                    found.append(_stars(v.view(np.int64), a, b))
            yield _edges(found)

    return run


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges a, b between distinct fingerprints (column fp) whose components
    are those of all pairs at most ``max_bits`` apart."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2: the long lists rely on two free bytes at most")
    if max_bits == 0:
        return prints.sparkSession.createDataFrame([], "a long, b long")
    sets = _group_pairs(max_bits)
    wide = list(combinations(range(8), 8 - max_bits))
    listed = _listed(prints, sets, F.col("fp"))
    sizes = materialize(listed.groupBy("set", "bytes").agg(F.count("*").alias("n")).where("n > 1"), "simhash-lists")
    members = materialize(listed.join(sizes, ["set", "bytes"]), "simhash-members")
    short = (
        members.where(F.col("n") <= LIST_ROWS).groupBy("set", "bytes").agg(F.collect_list("fp").alias("m"))
        .select("m").mapInArrow(_count_filter(max_bits), "a long, b long")
    )
    # The wide sets that hold the list's own positions.
    within = F.array(*[F.array(*[F.lit(i) for i, w in enumerate(wide) if set(s) <= set(w)]) for s in sets])
    masks = F.array(*[F.lit(_mask(w)) for w in wide])
    long = (
        members.where(F.col("n") > LIST_ROWS)
        .select("fp", F.explode(F.element_at(within, F.col("set") + 1)).alias("wide"))
        .distinct()
        .groupBy("wide", F.col("fp").bitwiseAND(F.element_at(masks, F.col("wide") + 1)).alias("bytes"))
        .agg(F.collect_list("fp").alias("m"))
        .where(F.size("m") > 1)
        .select("wide", "m").mapInArrow(_neighbours(max_bits, wide), "a long, b long")
    )
    return short.unionByName(long).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of ``edges`` (a, b) that is not a root itself,
    root the smallest node of its component: alternating stars until nothing
    changes."""
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current, before = materialize(ordered, "stars"), None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        # Large star: every larger neighbour links to the smallest one around its centre.
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "stars-low")
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "stars-large")
        # Small star: a node and its smaller neighbours link to the smallest of them.
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "stars-low")
        small = (
            large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct()
        )
        current = materialize(small, "stars")


def _rooted(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``nodes`` (one row per fingerprint, column fp) with the smallest
    fingerprint of the component as root."""
    roots = components(links(nodes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return materialize(rooted, "simhash-rooted")


def near_duplicates(docs: DataFrame, *, ngram: int = 3, max_bits: int = 2, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = materialize(fingerprints(docs, ngram, key=key, text=text), "simhash-prints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    rooted = _rooted(nodes, max_bits)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(rooted.join(smallest, "root").select("fp", "component_id"), "simhash-components")
    return prints.join(named, "fp").select("doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, *, ngram: int = 3, max_bits: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every component, all columns as they are: the one of
    smallest id (one without an id only if all are), of several rows under that
    id the one of smallest hash.  Components are those of the texts: rows that
    share an id stay each in its own."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("d"), F.monotonically_increasing_id().alias("r"))
    rows = materialize(rows, "simhash-rows")
    prints = rows.select("r", F.col(f"d.`{text}`").cast("string").alias("t")).mapInArrow(_hasher(ngram), "r long, fp long")
    k = F.col(f"d.`{key}`")
    ranked = rows.select("r", F.struct(k.isNull(), k, F.xxhash64(F.col("d").cast("string")), "r").alias("rank"))
    prints = materialize(prints.join(ranked, "r").select("fp", "rank"), "simhash-prints")
    # The first row of a fingerprint, then of a component: one row a node, however many copies.
    nodes = materialize(prints.groupBy("fp").agg(F.min("rank").alias("first")), "simhash-nodes")
    kept = _rooted(nodes, max_bits).groupBy("root").agg(F.min("first").alias("first")).select("first.r")
    return rows.join(kept, "r", "left_semi").select("d.*")
