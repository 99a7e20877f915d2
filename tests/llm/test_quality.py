"""Counts against brute force, robust estimates against planted outliers."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardsentry.llm import quality as q


def _counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside), len(lines))


def test_counts():
    rng = random.Random(1)
    texts = [None, "", " \n ", "a a a a a a", "a b c d e", "x\u00a0y z", "é# *$\n\né# *$\n x\n x\n"]
    texts += ["".join(rng.choice(["a ", "b ", "c\n", "d#", "\t", "\x1c"]) for _ in range(rng.randrange(120))) for _ in range(150)]
    for t in texts:
        assert q.text_counts(t) == _counts(t)


def test_chi2():
    assert q.chi2_quantile(0.975, 5) == pytest.approx(12.8325, abs=1e-3)
    assert q.chi2_cdf(4.3515, 5) == pytest.approx(0.5, abs=1e-4)


def _docs(spark, n, junk, lang="en", source="s", at=0):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(int(rng.lognormvariate(5, 0.6)) + 20)]
        if i < junk:
            words = [w + "###$$" for w in words]
        rows.append((at + i, " ".join(words), lang, source))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_outliers_go_and_the_rest_stays(spark):
    docs = _docs(spark, 300, 60).unionByName(_docs(spark, 8, 2, "de", None, 1000)).unionByName(_docs(spark, 20, 0, None, "t", 2000))
    got = {r.doc_id: r for r in q.judge(docs).collect()}
    assert not any(got[i].kept for i in [*range(60), 1000, 1001])
    assert all(got[i].kept for i in [*range(60, 300), *range(1002, 1008), *range(2000, 2020)])


@pytest.mark.parametrize("statistic", q.NAMES)
def test_each_statistic_rejects_by_itself(spark, statistic):
    """A clean group and one text that is off in one statistic only."""
    rng = random.Random(4)

    def words(n, least=2, most=8):
        return ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(least, most))) for _ in range(n)]

    def lines(w, per=10):
        return "\n".join(" ".join(w[i:i + per]) for i in range(0, len(w), per))

    rows = [(i, lines(words(rng.randint(150, 250))), "en", "s") for i in range(200)]
    planted = {
        "x_words": lambda: lines(words(6000)),
        "x_length": lambda: lines(words(200, 14, 16)),
        "x_symbols": lambda: lines([w + "#$" * (i % 4 == 0) for i, w in enumerate(words(200))]),
        "x_lines": lambda: lines(words(200), 20) + "\nmenu" * 30,
        "x_repeats": lambda: lines([*(w := words(180)), *w[:16]]),
    }[statistic]()
    docs = spark.createDataFrame([*rows, (1000, planted, "en", "s")], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in q.judge(docs).collect()}
    assert not got[1000].base_failed and not got[1000].kept
    assert sum(got[i].kept for i in range(200)) >= 198


def test_too_few_for_an_estimate(spark):
    got = q.judge(_docs(spark, 10, 5)).collect()
    assert all(r.kept and r.distance2 is None for r in got)


def test_estimate_is_that_of_plain_steps(spark):
    """The distributed steps end in a subset whose own mean they return."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, q.P)) * [1, 2, 3, 1, 1]
    x[:80] += 50
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x], "g string, " + ", ".join(f"{n} double" for n in q.NAMES))
    fit = q.robust_estimates(rows).first()
    centre, precision = np.array(fit.centre), np.array(fit.precision).reshape(q.P, q.P)
    assert np.abs(centre).max() < 0.6
    d2 = np.einsum("ij,jk,ik->i", x - centre, precision, x - centre)
    assert (d2[:80] > 100).all() and np.median(d2[80:]) < 6


def _regular(x, share):
    """Centre, precision and log determinant of a subset, regularised as documented."""
    least = np.array(list(q.FLOORS.values())) ** 2
    factor = share / q.chi2_cdf(q.chi2_quantile(share, q.P), q.P + 2)
    scatter = np.cov(x.T, bias=True) * factor
    own = scatter.diagonal()
    scatter = scatter + np.diag(q.RIDGE * own + np.maximum(least - own, 0))
    return x.mean(0), np.linalg.inv(scatter), np.linalg.slogdet(scatter)[1]


def _fast_mcd(x, starts=60, seed=5):
    """Random starts, concentration to the end, the lowest determinant, reweighted once."""
    rng, best = np.random.default_rng(seed), None
    distances = lambda f: np.einsum("ij,jk,ik->i", x - f[0], f[1], x - f[0])
    for _ in range(starts):
        fit = _regular(x[rng.choice(len(x), q.P + 2, replace=False)], q.H)
        while True:
            after = _regular(x[np.argsort(distances(fit), kind="stable")[:int(np.ceil(q.H * len(x)))]], q.H)
            if abs(after[2] - fit[2]) < 1e-9:
                break
            fit = after
        best = min(best or fit, fit, key=lambda f: f[2])
    return distances(_regular(x[distances(best) <= q.chi2_quantile(0.975, q.P)], 0.975))


def test_verdicts_are_those_of_many_random_starts(spark):
    """Three groups with a fifth of shifted rows each; the verdicts of plain
    FAST-MCD, but for rows as near to the bound as one bin of distances."""
    rng, bound, groups = np.random.default_rng(2), q.chi2_quantile(1 - q.TAIL, q.P), {}
    for g, shift in enumerate([3.0, 6.0, 20.0]):
        mixing = rng.normal(size=(q.P, q.P)) + 2 * np.eye(q.P)
        x = rng.normal(size=(500, q.P)) @ mixing
        x[:100] += shift * rng.choice([-1, 1], q.P) * 4
        groups[f"g{g}"] = x
    rows = spark.createDataFrame([(g, *map(float, r)) for g, x in groups.items() for r in x],
                                 "g string, " + ", ".join(f"{n} double" for n in q.NAMES))
    fits = {r.g: r for r in q.robust_estimates(rows).collect()}
    for g, x in groups.items():
        off, precision = x - np.array(fits[g].centre), np.array(fits[g].precision).reshape(q.P, q.P)
        got, want = np.einsum("ij,jk,ik->i", off, precision, off), _fast_mcd(x)
        clear = np.abs(want / bound - 1) > 0.1
        assert ((got > bound) == (want > bound))[clear].all() and clear.mean() > 0.9, g
        assert (got[:100] > bound).mean() > 0.9


def test_steps_run_to_the_end(spark, monkeypatch):
    """Every step but the last lowers the determinant, and the last one does not."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(600, q.P)) + np.linspace(0, 40, 600)[:, None], rng.normal(size=(40, q.P))])
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x], "g string, " + ", ".join(f"{n} double" for n in q.NAMES))
    dets, plain = [], q._concentrate

    def seen(rows, fit):
        got = plain(rows, fit)
        dets.extend(r.log_det for r in got.collect())
        return got

    monkeypatch.setattr(q, "_concentrate", seen)
    q.robust_estimates(rows).collect()
    assert all(b < a - q.LEAST_FALL for a, b in zip(dets[:-2], dets[1:-1])) and dets[-1] >= dets[-2] - q.LEAST_FALL


def test_odd_documents(odd_docs, no_docs):
    got = q.judge(odd_docs)
    assert got.count() == odd_docs.count()
    texts = sorted((str(r.doc_id), _counts(r.text)[:4]) for r in odd_docs.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines)) for r in got.collect()) == texts
    assert got.where(F.col("base_failed") & F.col("kept")).isEmpty() and got.where("kept is null or base_failed is null").isEmpty()
    assert q.judge(no_docs).count() == 0
