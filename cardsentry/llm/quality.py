"""Quality rules with robust multivariate outliers (operator 7).

Every text gets counts (words, characters, symbols, repeated lines, words in
repeated five-word windows).  Base rules reject very short and very repetitive
texts.  The rest are judged per language and source: the transformed counts
form a vector, a minimum-covariance-determinant estimate gives its centre and
scatter, and vectors beyond a chi-square bound in Mahalanobis distance are
rejected.

The estimate is found on all rows by concentration steps run as aggregates:
distances under the current estimate, the bound that holds the share ``H`` of
a group (from a histogram of distances in fixed bins), and the mean and
scatter of the rows within it.  Each group steps until its determinant no
longer falls by ``LEAST_FALL`` of its logarithm and keeps the lowest; as the
least variances bound it from below, every group ends, however many steps it
takes.  Ties: rows of one bin of distances are all in or all out, so equal
vectors never part.  Only sums per group move, so a group of any size is spread
over all tasks.

A group of language and source with fewer than ``MIN_ROWS`` rows takes the
estimate of its language, a small language that of the whole table, and a
table below that many rows has no multivariate verdict.  An estimate is
regularised by a small share of its own variances; only where a statistic
hardly varies (most texts have the same value) does its variance rise to a
least one.  The least ones leave every statistic able to reject by itself: in a
group that has no duplicate lines from 9 % of them on, no repeated words from
7 %, no symbols from 2 per 100 words, and in a group of equal texts at three
times the words or a mean word length a quarter off.

Defined cases: a null text has no words and fails the base rules; null
language or source is a group of its own; repeated rows count as often as they
occur; an empty table gives no rows; a text of any length is counted whole, one
text in memory at a time; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import ascii_words, materialize

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5

# Words at least, and share of words in repeated windows at most.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# Share of a group that an estimate is drawn from, smallest group with its own
# estimate, rejected tail of the chi-square distribution, fall of a determinant's
# logarithm that makes another step.
H = 0.75
MIN_ROWS = 50
TAIL = 0.001
LEAST_FALL = 1e-3
# Names of the transformed statistics with their least standard deviations, and
# the share of its own variances that is added to an estimate.
FLOORS = {"x_words": 0.25, "x_length": 0.05, "x_symbols": 0.25, "x_lines": 0.5, "x_repeats": 0.45}
RIDGE = 0.01
NAMES = list(FLOORS)
P = len(NAMES)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
# Distances are counted in bins of 1/BINS octave.
BINS = 16


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of ``window`` words that occurs at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for i in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def text_counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    text = text or ""
    words = ascii_words(text)
    seen: set[str] = set()
    lines = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            seen.add(line)
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
        lines - len(seen), repeated_words(words), lines,
    )


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = np.array([text_counts(t.as_py()) for t in b.column(3)], np.int64).reshape(-1, len(_COUNTS))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), *[pa.array(rows[:, i]) for i in range(len(_COUNTS))]],
            names=["doc_id", "lang", "source", *_COUNTS])


def base_counts(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
                source: str = "source") -> DataFrame:
    """The counts of every document, with its language and source."""
    rows = docs.select(F.col(key).cast("long").alias("a"), F.col(lang).cast("string").alias("b"),
                       F.col(source).cast("string").alias("c"), F.col(text).cast("string").alias("d"))
    ddl = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS)
    return rows.mapInArrow(_count, ddl)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def statistics() -> list[Column]:
    """The transformed statistics, in the order of NAMES."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p("n_words").alias("x_words"),
        F.log((F.col("word_chars") + 1) / (words + 1)).alias("x_length"),
        F.log1p(100 * F.col("n_symbols") / words).alias("x_symbols"),
        F.log1p(100 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("x_lines"),
        F.log1p(100 * F.col("n_repeat_words") / words).alias("x_repeats"),
    ]


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function by the incomplete gamma series."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < q else (low, mid)
    return high


def _level(level: int) -> Column:
    """Group key of a row: 2 language and source, 1 language, 0 everything."""
    parts = [F.lit(str(level)), F.col("lang") if level else F.lit(None), F.col("source") if level > 1 else F.lit(None)]
    return F.to_json(F.array(*[p.cast("string") for p in parts]))


def _solver(share: float):
    """From a group's sums to its centre, precision matrix and determinant.

    The scatter of the innermost ``share`` of a normal sample is too small by
    a known factor, which is put right here."""
    factor = share / chi2_cdf(chi2_quantile(share, P), P + 2) if share < 1 else 1.0
    least = np.array([f * f for f in FLOORS.values()])

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                n = r["n"]
                mean = np.array([r[f"s{i}"] for i in range(P)]) / n
                scatter = np.zeros((P, P))
                for i, j in PAIRS:
                    scatter[i, j] = scatter[j, i] = r[f"s{i}_{j}"] / n - mean[i] * mean[j]
                scatter = scatter * factor
                own = scatter.diagonal()
                scatter = scatter + np.diag(RIDGE * own + np.maximum(least - own, 0))
                out.append((r["g"], mean.tolist(), np.linalg.inv(scatter).ravel().tolist(), float(np.linalg.slogdet(scatter)[1])))
            yield pd.DataFrame(out, columns=["g", "centre", "precision", "log_det"])

    return solve


_FIT_DDL = "g string, centre array<double>, precision array<double>, log_det double"


def _fit(rows: DataFrame, share: float) -> DataFrame:
    sums = rows.groupBy("g").agg(
        F.count("*").alias("n"),
        *[F.sum(n).alias(f"s{i}") for i, n in enumerate(NAMES)],
        *[F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"s{i}_{j}") for i, j in PAIRS],
    )
    return materialize(sums.mapInPandas(_solver(share), _FIT_DDL), "mcd-fit")


def _distance() -> Column:
    """Squared Mahalanobis distance under the joined estimate."""
    off = [F.col(n) - F.col("centre")[i] for i, n in enumerate(NAMES)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + off[i] * off[j] * F.col("precision")[i * P + j] * (1.0 if i == j else 2.0)
    return F.greatest(total, F.lit(0.0))


def _measured(rows: DataFrame, fit: DataFrame) -> DataFrame:
    return rows.join(fit, "g").withColumn("d2", _distance())


def _start(rows: DataFrame) -> DataFrame:
    """First estimate: medians, and quartile ranges as standard deviations."""
    quartiles = [F.percentile_approx(n, [0.25, 0.5, 0.75], 10_000).alias(f"q{i}") for i, n in enumerate(NAMES)]
    q = rows.groupBy("g").agg(*quartiles)
    floors = list(FLOORS.values())
    variance = [F.greatest(F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2), F.lit(floors[i] ** 2)) for i in range(P)]
    precision = F.array(*[1 / variance[i] if i == j else F.lit(0.0) for i in range(P) for j in range(P)])
    log_det = sum((F.log(v) for v in variance), F.lit(0.0))
    centre = F.array(*[F.col(f"q{i}")[1] for i in range(P)])
    return materialize(q.select("g", centre.alias("centre"), precision.alias("precision"), log_det.alias("log_det")), "mcd-start")


def _concentrate(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """One step: the estimate from the H share of each group nearest to ``fit``."""
    binned = _measured(rows, fit).withColumn("bin", F.floor(F.log2(F.col("d2") + 1e-9) * BINS))
    counts = binned.groupBy("g", "bin").agg(F.count("*").alias("n"))
    group = Window.partitionBy("g")
    upto = group.orderBy("bin")
    bound = (
        counts.withColumn("below", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(group))
        .where(F.col("below") >= F.col("all") * H).groupBy("g").agg(F.min("bin").alias("last"))
    )
    bound = materialize(bound, "mcd-bound")
    return _fit(binned.join(bound, "g").where("bin <= last"), H)


def robust_estimates(rows: DataFrame) -> DataFrame:
    """g, centre, precision, log_det of every group of ``rows`` (g and the
    statistics of NAMES)."""
    fit, settled = _concentrate(rows, _start(rows)), None
    while True:
        # Only groups that still fall are joined, so a step reads no other rows.
        after = _concentrate(rows, fit).select("g", F.struct("centre", "precision", "log_det").alias("_after"))
        falls = F.coalesce(F.col("_after.log_det") < F.col("log_det") - LEAST_FALL, F.lit(False))
        step = materialize(fit.join(after, "g", "left").withColumn("_falls", falls), "mcd-step")
        ended = step.where("not _falls").select(fit.columns)
        settled = ended if settled is None else settled.unionByName(ended)
        fit = step.where("_falls").select("g", "_after.*")
        if fit.isEmpty():
            break
    fit = materialize(settled, "mcd-raw")
    # Reweighting: all rows within the 97.5 % bound of the raw estimate.
    inner = _measured(rows, fit).where(F.col("d2") <= chi2_quantile(0.975, P))
    return _fit(inner, 0.975)


def judge(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
          tail: float = TAIL) -> DataFrame:
    """The counts of every document with base_failed, distance2 (null where
    no estimate applies) and kept."""
    counted = materialize(base_counts(docs, key=key, text=text, lang=lang, source=source)
                          .withColumn("base_failed", base_failed()), "quality-counts")
    vectors = counted.where("not base_failed").select("lang", "source", *statistics())
    levels = vectors.select(F.explode(F.array(*[_level(k) for k in (2, 1, 0)])).alias("g"), *NAMES)
    sizes = levels.groupBy("g").agg(F.count("*").alias("n"))
    large = materialize(sizes.where(F.col("n") >= MIN_ROWS), "quality-groups")
    fits = robust_estimates(materialize(levels.join(large.select("g"), "g", "left_semi"), "quality-vectors"))
    # Each pair of language and source takes the nearest level that has an estimate.
    groups = counted.select("lang", "source").distinct().select("lang", "source", *[_level(k).alias(f"g{k}") for k in (2, 1, 0)])
    chosen = groups
    for k in (2, 1, 0):
        at = fits.select(F.col("g").alias(f"g{k}"), F.struct("centre", "precision").alias(f"f{k}"))
        chosen = chosen.join(at, f"g{k}", "left")
    chosen = materialize(
        chosen.select(F.col("g2").alias("_g"), F.coalesce("f2", "f1", "f0").alias("_f"))
        .select("_g", "_f.centre", "_f.precision"), "quality-estimates")
    out = counted.withColumn("_g", _level(2)).join(chosen, "_g", "left")
    d2 = out.select(*counted.columns, *statistics(), "centre", "precision").withColumn("distance2", F.when(F.col("centre").isNotNull(), _distance()))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= chi2_quantile(1 - tail, P))
    return d2.withColumn("kept", kept).drop("centre", "precision", *NAMES)
