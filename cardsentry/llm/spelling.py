"""Spelling variants by search schemes over a bidirectional FM-index (operator 12).

The vocabulary is the distinct words of the corpus with their counts.  Two words
are near at an edit distance of exactly one.  Cut in two, a word and a near one
share either half untouched, so two searches find all: the first half exactly
from the opening delimiter, then on to the right with one error, and the second
half exactly from the closing delimiter, then on to the left with one error.
The first needs the index that extends to the right, the second the one that
extends to the left; together they are the bidirectional index of the delimited
vocabulary.  Neither search turns round, so their intervals need not be kept in
step.  The left one is the right one over reversed words, so one code does both.

Intervals are suffix-rank intervals: the prefixes of all words, compared from
their last character back to the opening delimiter, lie sorted, and a column
holds the character that follows each.  Extending an interval by a character is
two rank queries, done for a block of words at a time.  An error is placed where
word and variant first differ, so a variant is found once by each search, and
one found by both counts for the first.

The vocabulary is dealt in ranges of the sorted words, so a half lies in few
neighbouring ranges however common it is; each task indexes one range and
streams the queries that reach it.  Ranges with many queries are held by several
tasks.

Defined cases: a null or empty text has no words; a null id counts as the empty
string in the fault rule; repeated rows count as often as they occur; ties in
count go to the smaller word in code-point order; a run of letters of any length
is one word; an empty table gives no rows; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import materialize

MIN_CHARS, MIN_COUNT, RATIO, FAULT_MODULUS = 5, 3, 2, 97
# Distinct words that a worker counts before it hands them on, words of one index, queries of one task, characters of a block of queries.
HELD_WORDS = 200_000
SHARD_WORDS = 20_000
TASK_QUERIES = 100_000
BLOCK_CHARS = 2_000_000

# Letters of a word, A-Z folded, in Latin-1; everything else is a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def damaged_words(key: str, text: str) -> Counter:
    """Counts of the maximal letter runs of one text, in Latin-1, some of them
    with the fault that their hash with ``key`` says."""
    counts = Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())
    start = zlib.crc32(f"{key}:".encode())
    for run, n in list(counts.items()):
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % FAULT_MODULUS == 0:
            at = h % len(run)
            del counts[run]
            counts["fault", run[:at] + run[at + 1:]] += n
    return counts


def _counter(min_chars: int):
    def batch_of(held: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in held.items() if len(w) >= min_chars]
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w, _ in kept], pa.string()),
                                           pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for key, text in zip(b.column(0), b.column(1), strict=True):
                for word, n in damaged_words(key.as_py() or "", text.as_py() or "").items():
                    held[word[1] if isinstance(word, tuple) else word] += n
                if len(held) >= HELD_WORDS:
                    yield batch_of(held)
                    held.clear()
        yield batch_of(held)

    return run


def vocabulary(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
               min_count: int = MIN_COUNT) -> DataFrame:
    """``word``, ``n``: the distinct words of all texts, after the faults."""
    rows = docs.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t"))
    counts = rows.mapInArrow(_counter(min_chars), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class PrefixIndex:
    """FM-index over the opening delimiter and the prefixes of distinct words:
    intervals extend to the right."""

    def __init__(self, words: list[str]):
        self.words = words
        self.own = {w: i for i, w in enumerate(words)}
        lengths = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        self.alphabet = np.unique(text)
        symbols = np.searchsorted(self.alphabet, text) + 1
        # One place per word and prefix length; the last one is the whole word.
        word = np.repeat(np.arange(len(words)), lengths + 1)
        first = np.cumsum(lengths + 1) - lengths - 1
        depth = np.arange(len(word)) - first[word]
        follows, came = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        inner = depth < lengths[word]
        follows[inner] = symbols
        came[1:][inner[:-1]] = symbols
        # Ranks of the prefixes read backwards, by doubling.
        rank, step, longest = came, 1, int(lengths.max(initial=0))
        while step <= longest:
            back = np.zeros(len(rank), np.int64)
            far = np.nonzero(depth >= step)[0]
            back[far] = rank[far - step]
            rank = np.unique(rank * (int(rank.max(initial=0)) + 1 + len(rank)) + back, return_inverse=True)[1].astype(np.int64)
            step *= 2
        rows = np.argsort(rank, kind="stable")
        self.size, self.n_symbols = len(rows), len(self.alphabet) + 1
        self.word_at, self.next = word[rows], follows[rows]
        # Row numbers grouped by the symbol that follows: a rank query is one search.
        self.keys = np.sort(self.next * self.size + np.arange(self.size))

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = symbol * self.size
        return np.searchsorted(self.keys, base + lo), np.searchsorted(self.keys, base + hi)

    def others(self, lo: np.ndarray, hi: np.ndarray, but: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(interval, its extension) by every symbol that follows there but one:
        read off the rows of a short interval, tried one by one in a long one."""
        size = hi - lo
        short = np.nonzero(size < self.n_symbols)[0]
        rows = np.repeat(lo[short] - (np.cumsum(size[short]) - size[short]), size[short]) + np.arange(size[short].sum())
        pairs = np.unique(np.repeat(short, size[short]) * self.n_symbols + self.next[rows])
        long = np.nonzero(size >= self.n_symbols)[0]
        every = (long[:, None] * self.n_symbols + np.arange(self.n_symbols)).ravel()
        at, symbol = np.divmod(np.concatenate([pairs, every]), self.n_symbols)
        take = (symbol > 0) & (symbol != but[at])
        at, symbol = at[take], symbol[take]
        a, b = self.extend(symbol, lo[at], hi[at])
        some = a < b
        return at[some], symbol[some], a[some], b[some]

    def near(self, queries: list[str], halves: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) that agree on the query's first ``half``
        characters and differ by one edit behind them."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        by_shape: dict[tuple[int, int], list[int]] = {}
        for i, (q, m) in enumerate(zip(queries, halves, strict=True)):
            by_shape.setdefault((len(q), m), []).append(i)
        for (length, half), ids in by_shape.items():
            block = max(1, BLOCK_CHARS // max(1, length))
            for low in range(0, len(ids), block):
                some = ids[low:low + block]
                q, w = self._near_block([queries[i] for i in some], length, half)
                found.append((np.array(some, np.int64)[q], w))
        return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (np.zeros(0, np.int64),) * 2

    def _near_block(self, queries: list[str], length: int, half: int) -> tuple[np.ndarray, np.ndarray]:
        chars = np.frombuffer("".join(queries).encode("utf-32-le"), "<u4").reshape(len(queries), length)
        at = np.minimum(np.searchsorted(self.alphabet, chars), len(self.alphabet) - 1)
        symbols = np.where(self.alphabet[at] == chars, at + 1, self.n_symbols)
        own = np.array([self.own.get(q, -1) for q in queries], np.int64)
        # No error yet: query, interval.
        q = np.arange(len(queries))
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(self.words), np.int64)
        for j in range(half):
            lo, hi = self.extend(symbols[q, j], lo, hi)
            q, lo, hi = (x[lo < hi] for x in (q, lo, hi))
        # One error: query, interval, at the same position of the query.
        eq, elo, ehi = (np.zeros(0, np.int64) for _ in range(3))
        deleted = [(eq, elo, ehi)]
        for j in range(half, length + 1):
            # Left alone in its interval the query has no variant any more.
            busy = (hi - lo > 1) | (self.word_at[np.minimum(lo, self.size - 1)] != own[q])
            q, lo, hi = q[busy], lo[busy], hi[busy]
            eq, elo, ehi = (np.concatenate(x) for x in zip((eq, elo, ehi), *deleted, strict=True))
            if not len(q) and not len(eq):
                return eq, eq
            here = symbols[q, j] if j < length else np.zeros(len(q), np.int64)
            k, _, a, b = self.others(lo, hi, here)
            added = q[k], a, b
            if j == length:
                eq, elo, ehi = (np.concatenate(x) for x in zip((eq, elo, ehi), added, strict=True))
                break
            # A character more in the variant: still before this one.
            eq, elo, ehi = (np.concatenate(x) for x in zip((eq, elo, ehi), added, strict=True))
            elo, ehi = self.extend(symbols[eq, j], elo, ehi)
            live = elo < ehi
            eq, elo, ehi = eq[live], elo[live], ehi[live]
            # Another character, or none if the next one differs: behind this one.
            gone = here != symbols[q, j + 1] if j + 1 < length else np.ones(len(q), bool)
            deleted = [added, (q[gone], lo[gone], hi[gone])]
            lo, hi = self.extend(here, lo, hi)
            live = lo < hi
            q, lo, hi = q[live], lo[live], hi[live]
        # Whole words only: the closing delimiter follows.
        row = np.searchsorted(self.keys, elo)
        at = self.keys[np.minimum(row, self.size - 1)]
        whole = (row < len(self.words)) & (at < ehi)
        return eq[whole], self.word_at[at[whole]]


def _half(length: int, backward: bool) -> int:
    return length - length // 2 if backward else length // 2


def _router(groups: list[tuple[bool, str, str]]):
    """Rows (backward, w, n) to one row per group whose words may begin with
    the row's half: ``groups`` are (backward, least word, greatest word)."""
    sides = {s: [i for i, g in enumerate(groups) if g[0] == s] for s in (False, True)}
    least = {s: [groups[i][1] for i in ids] for s, ids in sides.items()}
    greatest = {s: [groups[i][2] for i in ids] for s, ids in sides.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, to = [], []
            for i, (side, word) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                piece = word[:_half(len(word), side)]
                a = bisect_left(greatest[side], piece)
                z = bisect_right(least[side], piece + "\U0010ffff")
                to += sides[side][a:z]
                rows += [i] * (z - a)
            taken = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), *taken.columns], names=["g", *b.schema.names])

    return run


def _answers(index: PrefixIndex, counts: np.ndarray, order: np.ndarray, backward: bool, queries: list[str]) -> pa.RecordBatch:
    q, w = index.near(queries, [_half(len(x), backward) for x in queries])
    if backward:  # found by the other search too: the first half is the variant's as well
        keep = np.array([not (len(queries[i]) != len(index.words[v]) and index.words[v].endswith(queries[i][_half(len(queries[i]), True):]))
                         for i, v in zip(q, w, strict=True)], bool)
        q, w = q[keep], w[keep]
    best = np.lexsort((order[w], -counts[w], q))
    q, w = q[best], w[best]
    who, first, many = np.unique(q, return_index=True, return_counts=True)
    turn = (lambda s: s[::-1]) if backward else (lambda s: s)
    return pa.RecordBatch.from_arrays(
        [pa.array([turn(queries[i]) for i in who], pa.string()), pa.array(many, pa.int64()), pa.array(counts[w[first]], pa.int64()),
         pa.array([turn(index.words[v]) for v in w[first]], pa.string())], names=["word", "n_near", "best_n", "best"])


def _searcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one task (task, kind, backward, w, n), sorted by task and kind:
    the words of an index, then the queries to it."""
    task, words, index = None, [], None
    counts = order = np.zeros(0, np.int64)
    for b in batches:
        queries: list[str] = []
        backward = False
        for t, kind, side, w, n in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if t != task:
                if queries:
                    yield _answers(index, counts, order, backward, queries)
                task, words, index, queries = t, [], None, []
            if kind == 0:
                words.append((w, n))
                continue
            if index is None:
                words.sort()
                index, counts = PrefixIndex([x for x, _ in words]), np.array([c for _, c in words], np.int64)
                order = np.empty(len(words), np.int64)
                order[sorted(range(len(words)), key=lambda i: words[i][0][::-1] if side else words[i][0])] = np.arange(len(words))
            backward = side
            queries.append(w)
        if queries:
            yield _answers(index, counts, order, backward, queries)


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS, task_queries: int = TASK_QUERIES) -> DataFrame:
    """For every word with a near one: how many, and the most frequent (of
    equal counts the smallest), with its count.  ``words`` are distinct."""
    spark = words.sparkSession
    sides = F.array(F.struct(F.lit(False).alias("backward"), F.col("word").alias("w")),
                    F.struct(F.lit(True).alias("backward"), F.reverse("word").alias("w")))
    sided = words.select(F.explode(sides).alias("s"), "n").select("s.backward", "s.w", "n")
    ranges = max(1, -(-2 * words.count() // shard_words))
    placed = materialize(sided.repartitionByRange(ranges, "backward", "w").withColumn("part", F.spark_partition_id()), "spelling-ranges")
    # One row per range.
    found = placed.groupBy("backward", "part").agg(F.min("w").alias("a"), F.max("w").alias("z")).orderBy("backward", "a").collect()
    ids = spark.createDataFrame([(i, r.backward, r.part) for i, r in enumerate(found)], "g int, backward boolean, part int")
    ddl = "g int, backward boolean, w string, n long"
    asked = materialize(placed.select("backward", "w", "n").mapInArrow(_router([(r.backward, r.a, r.z) for r in found]), ddl), "spelling-queries")
    # One row per range: its tasks are numbered from `base`, as many as its queries need.
    load = {r.g: r.n for r in asked.groupBy("g").agg(F.count("*").alias("n")).collect()}
    bases, n_tasks = [], 0
    for g in range(len(found)):
        many = max(1, -(-load.get(g, 0) // task_queries))
        bases.append((g, n_tasks, many))
        n_tasks += many
    tasks = spark.createDataFrame(bases, "g int, base int, many int")
    indexed = placed.join(ids, ["backward", "part"]).join(tasks, "g").select(
        F.explode(F.sequence("base", F.col("base") + F.col("many") - 1)).alias("task"), F.lit(0).alias("kind"), "backward", "w", "n")
    queries = asked.join(tasks, "g").select(
        (F.col("base") + F.pmod(F.xxhash64("w"), F.col("many")).cast("int")).alias("task"), F.lit(1).alias("kind"), "backward", "w", "n")
    dealt = indexed.unionByName(queries).repartitionById(max(1, n_tasks), "task").sortWithinPartitions("task", "kind")
    part = dealt.mapInArrow(_searcher, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    return part.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the last word on the way along ``form``, by doubling
    the way; as each step at least doubles the count, a few rounds do."""
    way = materialize(forms.select("word", F.col("form").alias("root")), "spelling-way")
    while True:
        on = way.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        longer = way.join(on, F.col("root") == F.col("_w"), "left")
        way = materialize(longer.select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "spelling-way")
        if way.where("moved").isEmpty():
            return way.select("word", "root")
        way = way.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, shard_words: int = SHARD_WORDS, task_queries: int = TASK_QUERIES) -> DataFrame:
    """Every word with its form (the near word of largest count, if that is at
    least ``ratio`` times its own), its root, and how many near words it has."""
    words = materialize(words.select("word", "n"), "spelling-words")
    near = near_words(words, shard_words, task_queries)
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = roots(formed.where("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
