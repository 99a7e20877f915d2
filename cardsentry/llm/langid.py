"""Language identification by segmentation-marginalised unigrams (operator 8).

The pieces are those of a fixed public vocabulary that consist of letters.  A
language is a distribution over pieces; the probability of a word is the sum
over all its segmentations into pieces, computed by a forward pass over the
word's lattice, and a text's score the product over its words.  The
distributions are fitted by expectation maximisation: forward and backward
passes give every piece's expected count over all segmentations.

The fit reads a bounded sample of labelled rows, ``TRAIN_ROWS`` a language,
chosen by a hash of the id; what reaches the driver is one number per piece and
language.  Prediction covers whole texts of all rows.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every row if no labelled row exists; repeated rows get equal answers; of
equally likely languages the first by name wins; long texts are scored in blocks
and long words in log space; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import materialize

UNDETERMINED = "und"
TRAIN_ROWS = 1000
EM_STEPS = 3
SMOOTHING = 0.05
# Words kept per worker, longest word for the vectorised pass, characters scored and words in one lattice at a time.
CACHE_WORDS = 300_000
SHORT = 24
BLOCK_CHARS = 1_000_000
LATTICE_WORDS = 5_000

SPACE = "▁"


class _Spaced(dict):
    """Translation of code points: letters (Unicode category L) stay, the rest are spaces."""

    def __missing__(self, c: int) -> int:
        self[c] = c if chr(c).isalpha() else 32
        return self[c]


_SPACED = _Spaced()


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return (text or "").lower().translate(_SPACED).split()


@lru_cache(maxsize=2)
def pieces(path: str) -> tuple[dict[str, int], int]:
    """Letter pieces of the vocabulary with their numbers, and the longest
    piece.  Number ``len(pieces)`` stands for a character of no piece."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[str, int] = {}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
            piece = sp.id_to_piece(i)
            body = piece.removeprefix(SPACE)
            if piece == SPACE or (body and body == body.lower() and body.isalpha()):
                found.setdefault(piece, len(found))
    return found, max(map(len, found))


def _code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")


def _hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every stretch of ``length`` code points along the rows."""
    out = codes[:, :codes.shape[1] - length + 1].astype(np.uint64)
    for k in range(1, length):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[:, k:codes.shape[1] - length + 1 + k]
    return out


@lru_cache(maxsize=2)
def _by_length(path: str) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length of pieces: their hashes in order, numbers and code points."""
    known, longest = pieces(path)
    out = []
    for length in range(1, longest + 1):
        some = [p for p in known if len(p) == length]
        codes = _code_points(some).reshape(-1, length)
        hashes = _hashes(codes, length)[:, 0] if some else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        out.append((hashes[order], np.array([known[p] for p in some], np.int64)[order], codes[order]))
    return out


class Lattice:
    """All segmentations of some words: edges word, from, to, piece.  All
    stretches of one length are looked up together, by hash and then exactly."""

    def __init__(self, words: list[str], path: str):
        unknown = len(pieces(path)[0])
        self.n = len(words)
        self.lengths = np.array([len(w) + 1 for w in words], np.int64)
        width = int(self.lengths.max(initial=0))
        codes = np.zeros((self.n, width), np.uint32)
        codes[np.arange(width) < self.lengths[:, None]] = _code_points([SPACE + w for w in words])
        parts = []
        for length, (hashes, numbers, exact) in enumerate(_by_length(path), 1):
            if length > width:
                break
            inside = np.arange(width - length + 1) + length <= self.lengths[:, None]
            w, i = np.nonzero(inside)
            h = _hashes(codes, length)[w, i]
            at = np.minimum(np.searchsorted(hashes, h), max(0, len(hashes) - 1))
            hit = hashes[at] == h if len(hashes) else np.zeros(len(h), bool)
            there = np.nonzero(hit)[0]
            same = (codes[w[there][:, None], i[there][:, None] + np.arange(length)] == exact[at[there]]).all(axis=1)
            hit[there[~same]] = False
            if length == 1:  # a character of no piece
                piece = np.where(hit, numbers[at] if len(numbers) else unknown, unknown)
            else:
                w, i, piece = w[hit], i[hit], numbers[at[hit]]
            parts.append(np.column_stack([w, i, i + length, piece]))
        e = np.concatenate(parts) if parts else np.zeros((0, 4), np.int64)
        self.e = e[np.lexsort((e[:, 1], e[:, 2]))]

    @staticmethod
    def _groups(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Borders of runs of equal pairs; in a run each word stands once."""
        new = np.nonzero((np.diff(first) != 0) | (np.diff(second) != 0))[0] + 1
        return np.concatenate([[0], new, [len(first)]]) if len(first) else np.zeros(1, np.int64)

    def forward(self, prob: np.ndarray) -> np.ndarray:
        """alpha[word, position, column] for piece probabilities prob[piece, column]."""
        top = int(self.lengths.max(initial=0))
        alpha = np.zeros((self.n, top + 1, prob.shape[1]))
        alpha[:, 0] = 1
        borders = self._groups(self.e[:, 2], self.e[:, 1])
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            w, p = self.e[a:b, 0], self.e[a:b, 3]
            i, j = self.e[a, 1], self.e[a, 2]
            alpha[w, j] += alpha[w, i] * prob[p]
        return alpha

    def expected(self, prob: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected count of every piece over all segmentations, words weighted."""
        alpha = self.forward(prob)[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[np.arange(self.n), self.lengths] = 1
        e = self.e[np.lexsort((self.e[:, 2], -self.e[:, 1]))]
        borders = self._groups(e[:, 1], e[:, 2])
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            w, p = e[a:b, 0], e[a:b, 3]
            i, j = e[a, 1], e[a, 2]
            beta[w, i] += beta[w, j] * prob[p, 0]
        w, i, j, p = self.e.T
        total = alpha[np.arange(self.n), self.lengths]
        share = alpha[w, i] * prob[p, 0] * beta[w, j] / total[w] * weight[w]
        return np.bincount(p, share, minlength=len(prob))


def long_word_score(word: str, log_prob: np.ndarray, path: str) -> np.ndarray:
    """Log-probability of one word of any length, in log space."""
    known, longest = pieces(path)
    s = SPACE + word
    ring = [np.zeros(log_prob.shape[1])]
    for j in range(1, len(s) + 1):
        terms = []
        for i in range(max(0, j - longest), j):
            p = known.get(s[i:j], len(known) if i == j - 1 else None)
            if p is not None:
                terms.append(ring[i - j] + log_prob[p])
        ring.append(np.logaddexp.reduce(terms, axis=0))
        if len(ring) > longest + 1:
            ring.pop(0)
    return ring[-1]


class Scorer:
    """Log-probabilities per word and language, kept for words already seen."""

    def __init__(self, log_prob: np.ndarray, path: str):
        self.log_prob, self.prob, self.path = log_prob, np.exp(log_prob), path
        self.index: dict[str, int] = {}
        self.table = np.zeros((CACHE_WORDS, log_prob.shape[1]), np.float64)

    def _new(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.prob.shape[1]))
        # Words of like length share a lattice.
        short = sorted((k for k, w in enumerate(words) if len(w) <= SHORT), key=lambda k: len(words[k]))
        for lo in range(0, len(short), LATTICE_WORDS):
            part = short[lo:lo + LATTICE_WORDS]
            lattice = Lattice([words[k] for k in part], self.path)
            out[part] = np.log(lattice.forward(self.prob)[np.arange(len(part)), lattice.lengths])
        for k, w in enumerate(words):
            if len(w) > SHORT:
                out[k] = long_word_score(w, self.log_prob, self.path)
        return out

    def texts(self, texts: list[list[str]]) -> np.ndarray:
        """Summed log-probabilities of each list of words."""
        index = self.index
        fresh = list({w: None for t in texts for w in t if w not in index})
        scores = self._new(fresh)
        # Long words are not kept: they need not come again, and their size has no bound.
        short = [k for k, w in enumerate(fresh) if len(w) <= SHORT][:CACHE_WORDS - len(index)]
        low = len(index)
        for k in short:
            index[fresh[k]] = len(index)
        self.table[low:len(index)] = scores[short]
        table = self.table
        if len(short) < len(fresh):
            table = np.concatenate([self.table, scores])
            index = index | {w: CACHE_WORDS + k for k, w in enumerate(fresh) if w not in index}
        out = np.zeros((len(texts), self.prob.shape[1]))
        for k, t in enumerate(texts):
            if t:
                out[k] = table[np.fromiter(map(index.__getitem__, t), np.int64, len(t))].sum(axis=0)
        return out


class Model:
    """Languages and their log-probabilities over pieces."""

    def __init__(self, langs: list[str], log_prob: np.ndarray, path: str):
        self.langs, self.log_prob, self.path = langs, log_prob, path


def remainder(key: Column) -> Column:
    """crc32 of the id as text, modulo 4 (null id: 0)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4, F.lit(0))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts: dict[tuple[str, str], int] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            for w in words_of(text.as_py()):
                counts[lang, w] = counts.get((lang, w), 0) + 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([counts[k] for k in keys], pa.int64())], names=["lang", "word", "n"])


def _expected(langs: list[str], prob: np.ndarray, path: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(prob.T.shape)
        for frame in frames:
            for lang, part in frame.assign(size=frame["word"].str.len()).sort_values("size").groupby("lang"):
                k = langs.index(lang)
                for lo in range(0, len(part), LATTICE_WORDS):
                    some = part[lo:lo + LATTICE_WORDS]
                    lattice = Lattice(some["word"].tolist(), path)
                    total[k] += lattice.expected(prob[:, k:k + 1], some["n"].to_numpy(float))
        k, p = np.nonzero(total)
        yield pd.DataFrame({"k": k, "p": p, "c": total[k, p]})

    return run


def fit(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
        train_rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on labelled rows, about ``train_rows`` a language; None without any.

    Rows are taken by a hash of id and text, at a rate set from the language's
    count of different rows, so the sample is bounded at every size of the
    table; a repeated row counts once, and rows that share an id are drawn each
    by itself.  Words of more than SHORT letters are left out of the fit (not
    of prediction)."""
    labelled = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"),
                           F.col(lang).cast("string").alias("l")).where("l is not null and t is not null").withColumn("h", F.xxhash64("t"))
    sizes = {r.l: r.n for r in labelled.select("k", "l", "h").distinct().groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    rate = F.create_map(*[F.lit(x) for c in langs for x in (c, min(1.0, train_rows / sizes[c]))])
    drawn = F.pmod(F.xxhash64("k", "h", F.lit("langid")), F.lit(1 << 20)) < rate[F.col("l")] * (1 << 20)
    counts = labelled.where(drawn).dropDuplicates(["k", "l", "h"]).select("l", "t").mapInArrow(_word_rows, "lang string, word string, n long")
    counts = counts.where(F.length("word") <= SHORT).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # The sample is bounded, so are its words: a few files, not one a shuffle partition.
    counts = materialize(counts.coalesce(docs.sparkSession.sparkContext.defaultParallelism), "langid-words")
    n_pieces = len(pieces(path)[0]) + 1
    prob = np.full((n_pieces, len(langs)), 1.0 / n_pieces)
    for _ in range(EM_STEPS):
        rows = counts.mapInPandas(_expected(langs, prob, path), "k long, p long, c double").groupBy("k", "p").agg(F.sum("c").alias("c"))
        found = np.full(prob.shape, SMOOTHING)
        for r in rows.collect():  # one number per piece and language
            found[r.p, r.k] += r.c
        prob = found / found.sum(axis=0)
    return Model(langs, np.log(prob), path)


def _identify(scorer: Scorer, langs: list[str], texts: pa.Array) -> tuple[list[str], list[float]]:
    """Language and score of every text, some at a time."""
    found: list[tuple[str, float]] = []
    block: list[list[str]] = []
    size = 0
    for nth, t in enumerate(texts, 1):
        block.append(words_of(t.as_py()))
        size += sum(map(len, block[-1]))
        if size >= BLOCK_CHARS or nth == len(texts):
            for words, total in zip(block, scorer.texts(block), strict=True):
                best = int(total.argmax())
                found.append((langs[best], float(1 / np.exp(total - total[best]).sum())) if words else (UNDETERMINED, 0.0))
            block, size = [], 0
    return [f[0] for f in found], [f[1] for f in found]


_scorers: dict[tuple[str, bytes], Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """The worker's scorer of a model, kept from task to task."""
    key = model.path, hashlib.sha256(model.log_prob.tobytes()).digest()
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model.log_prob, model.path)
    return _scorers[key]


def _predictor(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for b in batches:
            langs, scores = _identify(scorer, model.langs, b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["k", "lang_pred", "score"])

    return run


def _keeper(model: Model, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for b in batches:
            langs, _ = _identify(scorer, model.langs, b.column(b.schema.get_field_index(text)))
            yield b.filter(pa.array([c != UNDETERMINED for c in langs], pa.bool_()))

    return run


def predict(docs: DataFrame, model: Model | None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (the posterior under equal priors) of every document."""
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    if model is None:
        return rows.select(F.col("k").alias("doc_id"), F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(_predictor(model), "k long, lang_pred string, score double").withColumnRenamed("k", "doc_id")


def identified(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """The documents whose language is determined, all columns as they are;
    none without a model."""
    if model is None:
        return docs.limit(0)
    return docs.mapInArrow(_keeper(model, text), docs.schema)
