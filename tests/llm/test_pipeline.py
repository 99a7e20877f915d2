"""The pipeline against a plain run of its decisions, and on awkward tables."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from cardsentry.llm import decontaminate, simhash
from cardsentry.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        out[name] = docs
    return out


def is_card(digits: str) -> bool:
    """A card's first digit and its check digit."""
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return digits[0] in "23456" and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def test_columns_and_order(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "surrogates", "packing"]
    assert all(stages[n].columns == stages[""].columns for n in names[:-1])


def test_decisions(spark, stages):
    ids = {n: {r.doc_id for r in df.select("doc_id").collect()} for n, df in stages.items()}
    text = {r.doc_id: r.text for r in stages[""].collect()}
    assert ids["language_id"] == {k for k, t in text.items() if any(c.isalpha() for c in t or "")}
    found = simhash.near_duplicates(stages["language_id"]).collect()
    assert ids["near_duplicates"] == {r.component_id for r in found} and len(found) > len(ids["near_duplicates"])
    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {k for k in ids["near_duplicates"] if any(i in decontaminate.normalise(text[k]) for i in items)}
    assert leaks and ids["decontamination"] == ids["near_duplicates"] - leaks
    private = re.compile(r"\S+@\S+\.com|\+1 \(\d+\) \d+-\d+|\b\d+\.\d+\.\d+\.\d+\b|(?<=token = \")\w+")
    number = re.compile(r"\b\d{16}\b")
    new = {r.doc_id: r for r in stages["surrogates"].collect()}
    assert ids["surrogates"] == ids["decontamination"]
    for k, r in new.items():
        numbers = number.findall(text[k])
        old = private.findall(text[k]) + [x for x in numbers if is_card(x)]
        assert (r.text == text[k]) if not old else not any(x in r.text for x in old)
        assert all(x in r.text for x in numbers if not is_card(x))
        assert r.n_chars == len(r.text)
    assert ids["packing"] == ids["surrogates"]


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.exceptAll(stages["packing"]).isEmpty() and stages["packing"].exceptAll(got).isEmpty()


def test_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), "test-odd")
    assert docs.count() == 0
