"""Fingerprints and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cardsentry.llm import simhash


def _fingerprint(text, ngram):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + ngram]) for i in range(len(words) - ngram + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(prints):
    values = np.array(prints, np.uint64)
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2):
            parent[find(i)] = find(int(j))
    return [find(i) for i in range(len(values))]


def test_documents(odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    got = simhash.near_duplicates(odd_docs).collect()
    want = [_fingerprint(r.text, 3) for r in rows]
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(r.doc_id), f"{f:016x}") for r, f in zip(rows, want, strict=True))
    roots = _components(want)
    smallest = {}
    for r, f, root in zip(rows, want, roots, strict=True):
        if r.doc_id is not None:
            smallest[root] = min(smallest.get(root, r.doc_id), r.doc_id)
    by_print = {f"{f:016x}": smallest.get(root) for f, root in zip(want, roots, strict=True)}
    assert all(r.component_id == by_print[r.fingerprint] for r in got)
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("max_bits", [1, 2])
def test_links_of_crowded_fingerprints(spark, max_bits, monkeypatch):
    """Chains and crowds around a few centres, with lists long enough for the second index."""
    rng = random.Random(5)
    prints = set()
    for _ in range(3):
        at = rng.getrandbits(64)
        for _ in range(150):
            prints.add(at ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 3]))))
        for _ in range(40):
            at ^= 1 << rng.randrange(64)
            prints.add(at)
    prints |= {rng.getrandbits(64) for _ in range(200)}
    values = np.array(sorted(prints), np.uint64)
    differ = np.bitwise_count(values[:, None] ^ values[None, :])
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    for rows in (64, 8):
        monkeypatch.setattr(simhash, "LIST_ROWS", rows)
        found = simhash.components(simhash.links(df, max_bits)).collect()
        parent = list(range(len(values)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, j in zip(*np.nonzero(differ <= max_bits), strict=True):
            parent[find(i)] = find(j)
        signed = values.view(np.int64)
        groups = {}
        for i in range(len(values)):
            groups.setdefault(find(i), []).append(int(signed[i]))
        want = {v: min(g) for g in groups.values() for v in g if v != min(g)}
        assert {r.node: r.root for r in found} == want


def test_one_of_each_group_stays(odd_docs, no_docs):
    """One row of each component, rows without an id like any other."""
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    everything = {r.fingerprint for r in simhash.near_duplicates(odd_docs).select("fingerprint").distinct().collect()}
    left = [r.fingerprint for r in simhash.near_duplicates(kept).select("fingerprint").collect()]
    near = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1") <= 2
    # No two kept rows are near, and every text is reached from a kept one.
    assert not any(near(a, b) for i, a in enumerate(left) for b in left[:i])
    reached, todo = set(left), list(left)
    while todo:
        a = todo.pop()
        new = {b for b in everything - reached if near(a, b)}
        reached |= new
        todo += new
    assert reached == everything
    assert simhash.one_of_each(no_docs).count() == 0


def test_one_row_of_each_component_whatever_its_id(spark):
    """Two texts under one id, a near copy of one of them under a smaller id, copies without an id."""
    a = "the quick brown fox jumps over the lazy dog and runs on into the dark wood"
    b = "a quite different text about the rivers of Europe and the towns on their banks"
    rows = [(5, a, "a"), (5, b, "b"), (3, b, "copy of b"), (None, a, "nameless a"), (None, "only here , without an id", "n1"),
            (None, "only here , without an id", "n2"), (7, a, "a under 7"), (5, a, "another a")]
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string, note string").repartition(parts)
        got = sorted((str(r.doc_id), r.text) for r in simhash.one_of_each(docs).collect())
        assert got == [("3", b), ("5", a), ("None", "only here , without an id")]
        again = simhash.one_of_each(docs.orderBy(F.rand())).collect()
        assert sorted(map(str, again)) == sorted(map(str, simhash.one_of_each(docs).collect()))


def test_too_many_bits(odd_docs):
    with pytest.raises(ValueError):
        simhash.near_duplicates(odd_docs, max_bits=3)
