"""Benchmark decontamination by pigeonhole edit matching (operator 3).

Texts and test items are compared in lower case with white space runs as one
space.  An item may occur with up to ``error_rate`` of its length in edits, k.
Cut into k + 1 pieces, at least one piece of a true occurrence is untouched, so
an Aho-Corasick automaton over all pieces finds a place in every occurrence.
The same pigeonhole over neighbouring pieces, two by two, leaves one pair with
at most one edit; a hit whose pair has more is dropped at once, without loss.
What remains is verified by Myers' bit-parallel distance of the whole item
against the text around the hit.

Items go to the tasks in blocks of bounded bytes, one pass over the documents
per block, so any number of items works in bounded memory.

Defined cases: a null or empty text has no finding; an item shorter than
``min_chars`` after normalisation is found only without an edit and between
borders of words (in scripts without spaces, anywhere); a null or blank item is
nowhere; an item without an id is reported with a null one; items with equal
text are reported each; a repeated row is reported as often as it occurs; of
equally good places the first is reported; texts of any length are searched
whole; empty tables give no rows; other columns are ignored or kept as they
are, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.1
# Shorter items are searched as they are, at borders of words.
MIN_CHARS = 30
BLOCK_BYTES = 16 << 20
# Scripts from here on (kana, CJK, Hangul) are written without spaces or with few.
UNSPACED = "\u2e80"


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Span in ``text`` of the words that the span of its normalised form touches."""
    starts, spans, at = [], [], 0
    for word in text.split():
        starts.append(at)
        at += len(word.lower()) + 1
    spans = [m.span() for m in re.finditer(r"\S+", text)] if len(starts) else []
    if len(spans) != len(starts):  # white space that the two notions see differently
        spans, pos = [], 0
        for word in text.split():
            pos = text.index(word, pos)
            spans.append((pos, pos + len(word)))
            pos += len(word)
    first = bisect_right(starts, start) - 1
    last = bisect_right(starts, end - 1) - 1
    return spans[first][0], spans[last][1]


def myers(pattern: str, text: str) -> list[int]:
    """Least edit distance of ``pattern`` to a substring of ``text`` that ends
    at each character, by bit vectors as wide as the pattern."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    out = []
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | ~(xh | plus) & full
        mh = plus & xh
        if ph & top:
            score += 1
        if mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        plus = mh | ~(xv | ph) & full
        minus = ph & xv
        out.append(score)
    return out


def within_one(a: str, b: str) -> bool:
    """Whether the edit distance is at most one."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _inner(text: str, at: int) -> bool:
    """Whether a place stands inside a word written with spaces around it."""
    if not 0 < at < len(text):
        return False
    a, b = text[at - 1], text[at]
    return a.isalnum() and b.isalnum() and max(a, b) < UNSPACED


class Matcher:
    """Automaton over the pieces of some items."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float, min_chars: int = MIN_CHARS):
        self.items, self.budget, self.min_chars = items, [], min_chars
        # Piece -> (item, its start, start and end of its pair)
        places: dict[str, list[tuple[int, int, int, int]]] = {}
        for n, (_, text) in enumerate(items):
            k = int(error_rate * len(text)) if len(text) >= min_chars else 0
            self.budget.append(k)
            cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
            for i in range(k + 1):
                low = i - i % 2
                pair = cuts[low], cuts[min(low + 2, k + 1)]
                places.setdefault(text[cuts[i]:cuts[i + 1]], []).append((n, cuts[i], *pair))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def _pair_holds(self, item: str, text: str, at: int, start: int, length: int, low: int, high: int) -> bool:
        """Whether the hit piece's neighbour is there too with at most one edit."""
        if start == low:  # the neighbour follows
            other = item[start + length:high]
            b = at + length
            return not other or any(within_one(other, text[b:b + len(other) + d]) for d in (0, -1, 1))
        other = item[low:start]
        return any(within_one(other, text[max(0, at - len(other) - d):at]) for d in (0, -1, 1))

    def find(self, text: str) -> dict[int, tuple[int, int, int]]:
        """item number -> (distance, start, end) of its best occurrence."""
        best: dict[int, tuple[int, int, int]] = {}
        done: dict[int, tuple[int, int]] = {}
        for last, (length, where) in self.automaton.iter(text):
            at = last - length + 1
            for n, start, low, high in where:
                item, k = self.items[n][1], self.budget[n]
                begin = at - start
                if len(item) < self.min_chars:  # one piece, found whole
                    if not (_inner(text, begin) or _inner(text, begin + len(item))):
                        best[n] = min(best.get(n, (0, begin, begin + len(item))), (0, begin, begin + len(item)))
                    continue
                seen = done.get(n)
                # An alignment already looked at lies within the verified text.
                if seen and seen[0] <= begin <= seen[1]:
                    continue
                if not self._pair_holds(item, text, at, start, length, low, high):
                    continue
                a, b = max(0, begin - k), begin + len(item) + k
                done[n] = (begin, begin)
                window = text[a:b]
                scores = myers(item, window)
                distance = min(scores, default=k + 1)
                if distance > k:
                    continue
                done[n] = (begin - k, begin + k)
                end = scores.index(distance) + 1
                back = myers(item[::-1], window[:end][::-1])
                found = (distance, a + end - 1 - back.index(min(back)), a + end)
                best[n] = min(best.get(n, found), found)
        return best


_OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()),
                  ("start", pa.int32()), ("end", pa.int32())])
_DDL = "doc_id long, item_id long, distance int, start int, end int"


def _search(items: list[tuple[int | None, str]], error_rate: float, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, error_rate, min_chars)
        for b in batches:
            rows = []
            for key, value in zip(b.column(0), b.column(1), strict=True):
                text = value.as_py() or ""
                for n, (distance, start, end) in matcher.find(normalise(text)).items():
                    rows.append((key.as_py(), items[n][0], distance, *original_span(text, start, end)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_OUT)], schema=_OUT)

    return run


def _keep_clean(items: list[tuple[int | None, str]], error_rate: float, text: str, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, error_rate, min_chars)
        for b in batches:
            clean = [not matcher.find(normalise(t.as_py())) for t in b.column(b.schema.get_field_index(text))]
            yield b.filter(pa.array(clean, pa.bool_()))

    return run


def item_blocks(benchmark: DataFrame, *, item: str = "item_id", text: str = "text",
                block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, str]]]:
    """The items, normalised, in blocks of about ``block_bytes``."""
    rows = benchmark.select(F.col(item).cast("long").alias("i"), F.col(text).cast("string").alias("t")).where("t is not null")
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes)
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == block).collect()
        items = sorted(((r.i, normalise(r.t)) for r in part), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        items = [x for x in items if x[1]]
        if items:
            yield items


def contaminated(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text",
                 error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and test item found in it: the least distance and
    the span in the document of its best occurrence."""
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    out = docs.sparkSession.createDataFrame([], _DDL)
    for items in item_blocks(benchmark, block_bytes=block_bytes):
        out = out.unionByName(rows.mapInArrow(_search(items, error_rate, min_chars), _DDL))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", error_rate: float = ERROR_RATE,
                         min_chars: int = MIN_CHARS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no test item occurs, all columns as they are."""
    for items in item_blocks(benchmark, block_bytes=block_bytes):
        docs = docs.mapInArrow(_keep_clean(items, error_rate, text, min_chars), docs.schema)
    return docs
