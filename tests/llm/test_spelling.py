"""Near words by plain edit distance; vocabulary by plain counting; the query by its SQL twin."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardsentry.llm import spelling


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _plain_vocabulary(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def _plain_variants(vocabulary):
    holes = defaultdict(set)
    for w in vocabulary:
        holes[w].add(w)
        for i in range(len(w)):
            holes[w[:i] + w[i + 1:]].add(w)
    near = {w: set() for w in vocabulary}
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if _one_edit(a, b)}
    out = {}
    for w, n in vocabulary.items():
        best = min(near[w], key=lambda v: (-vocabulary[v], v), default=None)
        out[w] = (best if best is not None and vocabulary[best] >= 2 * n else None, len(near[w]))
    return out


def _expect(vocabulary):
    plain = _plain_variants(vocabulary)
    rows = {}
    for w, (form, n_near) in plain.items():
        root = w
        while plain[root][0] is not None:
            root = plain[root][0]
        rows[w] = (form, root, vocabulary[w], n_near, None if form is None else vocabulary[form])
    return rows


def _got(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text(alphabet="abé\U0001f600", min_size=1, max_size=7), min_size=1, max_size=60))
def test_both_searches_find_each_near_pair_once(words):
    words = sorted(words)
    found = Counter()
    for back in (False, True):
        turned = sorted(w[::-1] if back else w for w in words)
        index = spelling.PrefixIndex(turned)
        half = [spelling._half(len(w), back) for w in turned]
        for q, v in zip(*index.near(turned, half), strict=True):
            a, b = turned[q], index.words[v]
            if not (back and len(a) != len(b) and b.endswith(a[half[q]:])):
                found[(a[::-1], b[::-1]) if back else (a, b)] += 1
    assert found == Counter((a, b) for a in words for b in words if a != b and _one_edit(a, b))


@pytest.mark.parametrize(("shard_words", "task_queries"), [(10_000, 100_000), (60, 25)])
def test_variants_of_many_ranges(spark, shard_words, task_queries):
    """Nine words in ten begin alike, so one half is in many ranges."""
    rng = random.Random(5)
    words = {("aaaa" if rng.random() < 0.9 else "") + "".join(rng.choices("abcdé", k=rng.randint(3, 6))): rng.randint(3, 60) for _ in range(900)}
    words = {w: n for w, n in words.items() if len(w) >= 5} | {"a" * 3000: 9, "a" * 3001: 40}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert _got(spelling.variants(df, shard_words=shard_words, task_queries=task_queries)) == _expect(words)


def test_long_way_to_the_root(spark):
    words = {"stem" + "abcdefghijkl"[:k]: 3 * 2 ** k for k in range(1, 13)}
    got = _got(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == _expect(words) and {r[1] for r in got.values()} == {"stemabcdefghijkl"}


def test_vocabulary_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    words = {r.word: r.n for r in spelling.vocabulary(odd_docs).collect()}
    assert words == _plain_vocabulary(rows)
    assert _got(spelling.variants(spelling.vocabulary(odd_docs))) == _expect(words)
    assert spelling.variants(spelling.vocabulary(no_docs)).count() == 0


def test_every_hash_of_the_fault_rule():
    text = "Straße ÀÉÿ × ÷ straße STRASSE naïve日本 x ŁÓDŹ déjà"
    for key in range(400):
        got = Counter()
        for w, n in spelling.damaged_words(str(key), text).items():
            got[(w[1] if isinstance(w, tuple) else w).decode("latin-1")] += n
        want = Counter()
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{key}:{run}".encode())
            want[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
        assert got == want
