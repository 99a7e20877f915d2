"""Pigeonhole matching against a plain dynamic programme."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from cardsentry.llm import decontaminate as d


def _distance(pattern, text):
    """Least edit distance of pattern to any substring of text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=1, max_size=80), st.text("ab", min_size=1, max_size=90))
def test_myers(pattern, text):
    assert min(d.myers(pattern, text)) == min(_distance(pattern, text), max(_distance(pattern, text), 0))
    assert min(d.myers(pattern, text), default=0) == _distance(pattern, text) or len(pattern) == _distance(pattern, text)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=6), st.text("ab", max_size=6))
def test_within_one(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    assert d.within_one(a, b) == (row[-1] <= 1)


def test_finds_exactly_what_brute_force_finds():
    rng = random.Random(3)
    letters = "abc "
    items = [(i, d.normalise("".join(rng.choice(letters) for _ in range(60)))) for i in range(8)]
    items = [x for x in items if len(x[1]) >= 30]
    matcher = d.Matcher(items, 0.1)
    seen = 0
    for _ in range(250):
        item = rng.choice(items)[1]
        edited = list(item)
        for _ in range(rng.choice([0, 2, 4, 5, 6, 7, 9])):
            at = rng.randrange(len(edited))
            kind = rng.randrange(3)
            if kind == 0:
                edited[at] = rng.choice("abcz")
            elif kind == 1:
                del edited[at]
            else:
                edited.insert(at, rng.choice("abcz"))
        noise = "".join(rng.choice(letters) for _ in range(rng.randrange(50)))
        text = d.normalise(noise + "".join(edited) + noise[::-1])
        found = matcher.find(text)
        for n, (_, own) in enumerate(items):
            best = _distance(own, text)
            assert (n in found) == (best <= matcher.budget[n])
            if n in found:
                seen += 1
                distance, start, end = found[n]
                assert _distance(own, text[start:end]) == distance >= best
    assert seen > 100


ITEM = "Which of the following rivers flows through the city of Vienna and then on to Budapest?"


def test_documents(spark, odd_docs, no_docs):
    docs = spark.createDataFrame(
        [(1, f"Some words before. {ITEM} And some after."), (2, ITEM.upper().replace(" ", " \n ")), (3, ITEM.replace("Vienna", "Vianna")),
         (4, ITEM[:40]), (5, "Nothing of the kind."), (6, None), (7, ""), (8, f"{ITEM} {ITEM}"), (1, f"Some words before. {ITEM} And some after.")],
        "doc_id long, text string")
    bench = spark.createDataFrame([(10, ITEM, 1), (11, "short", 2), (12, None, 3), (13, "", 4), (14, ITEM, 5)],
                                  "item_id long, text string, doc_id int")
    got = d.contaminated(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == sorted(
        [(k, i, 1 if k == 3 else 0) for k in (1, 1, 2, 3, 8) for i in (10, 14)])
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        assert d.normalise(texts[r.doc_id][r.start:r.end])[:20] == d.normalise(ITEM)[:20]
    assert sorted(r.doc_id for r in d.without_contaminated(docs, bench).collect()) == [4, 5, 6, 7]
    small = d.contaminated(docs, bench, block_bytes=50).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, got))
    assert d.contaminated(docs, bench.limit(0)).count() == 0 and d.contaminated(no_docs, bench).count() == 0
    assert d.contaminated(odd_docs, bench).count() == 0
    clean = d.without_contaminated(odd_docs, bench)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count()


def test_short_and_nameless_items(spark):
    bench = spark.createDataFrame([(1, "What is the boiling point"), (None, "A nameless item of thirty-six letters"), (3, "首都はどこですか"), (4, "x1"), (5, "  ")],
                                  "item_id long, text string")
    texts = ["so: WHAT is the  boiling point?", "say a nameless item of thirty-six letters now", "日本の首都はどこですか。", "what is the boiling points", "ax1 x12",
             "x1", "the x1, here", "clean", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = d.contaminated(docs, bench).collect()
    assert sorted((r.doc_id, str(r.item_id), r.distance) for r in got) == [(0, "1", 0), (1, "None", 0), (2, "3", 0), (5, "4", 0), (6, "4", 0)]
    assert {texts[r.doc_id][r.start:r.end] for r in got if r.doc_id == 0} == {"WHAT is the  boiling point?"}
    assert sorted(r.doc_id for r in d.without_contaminated(docs, bench).collect()) == [3, 4, 7, 8]
