"""The forward pass against all segmentations, and held-out accuracy."""

from __future__ import annotations

import glob
import itertools
import os
import unicodedata

import numpy as np
import public_tokenizers
import pytest

from cardsentry.llm import langid
from cardsentry.llm.queries import op8_language_id
from cardsentry.session import shared_dir

PATH = public_tokenizers.path("piece_bpe_32k.model")


def _all_ways(word, prob):
    """Sum over every segmentation, one by one."""
    known, _ = langid.pieces(PATH)
    s = langid.SPACE + word
    total = 0.0
    for cuts in itertools.product([False, True], repeat=len(s) - 1):
        at = [0, *[i for i, c in enumerate(cuts, 1) if c], len(s)]
        p = 1.0
        for a, b in itertools.pairwise(at):
            n = known.get(s[a:b], len(known) if b == a + 1 else None)
            p = 0.0 if n is None else p * prob[n]
        total += p
    return total


def test_forward_sums_all_segmentations():
    n = len(langid.pieces(PATH)[0]) + 1
    prob = np.random.default_rng(1).dirichlet(np.ones(n), 2).T
    words = ["the", "straße", "é", "thethe", "ж", "Ω日本", "handlung"]
    lattice = langid.Lattice(words, PATH)
    alpha = lattice.forward(prob)
    for w, word in enumerate(words):
        for k in range(2):
            want = _all_ways(word, prob[:, k])
            assert alpha[w, len(word) + 1, k] == pytest.approx(want)
            assert langid.long_word_score(word, np.log(prob), PATH)[k] == pytest.approx(np.log(want))


def test_expected_counts_spell_the_words():
    """Expected piece lengths add up to the words' lengths."""
    known, _ = langid.pieces(PATH)
    prob = np.random.default_rng(2).dirichlet(np.ones(len(known) + 1), 1).T
    words, weight = ["the", "handlung", "a", "étude"], np.array([3.0, 1.0, 2.0, 5.0])
    counts = langid.Lattice(words, PATH).expected(prob, weight)
    lengths = np.array([*map(len, known), 1])
    assert (counts * lengths).sum() == pytest.approx(sum(w * (len(x) + 1) for w, x in zip(weight, words, strict=True)))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.001"
    got = op8_language_id(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


def test_odd_documents(spark, odd_docs, no_docs):
    model = langid.fit(odd_docs, PATH)
    assert model.langs == ["de", "en"]
    got = langid.predict(odd_docs, model)
    assert got.count() == odd_docs.count()
    texts = odd_docs.select("doc_id", "text").collect()
    und = sorted(str(r.doc_id) for r in texts if not any(c.isalpha() for c in r.text or ""))
    assert sorted(str(r.doc_id) for r in got.where("lang_pred = 'und'").collect()) == und
    assert got.where("score < 0 or score > 1 or score is null").isEmpty()
    kept = langid.identified(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == len(texts) - len(und)
    assert langid.fit(no_docs, PATH) is None
    assert {r.lang_pred for r in langid.predict(odd_docs, None).collect()} == {"und"}
    assert langid.predict(no_docs, model).count() == 0 and langid.identified(no_docs, None).count() == 0


def test_letters_are_those_of_category_l():
    assert langid.words_of("½ 12 ² ① Ⅷ x² Ünder 日本一 a1b ª") == ["x", "ünder", "日本一", "a", "b", "ª"]
    for c in map(chr, range(0x3000)):
        letter = unicodedata.category(c).startswith("L")
        assert bool(langid.words_of(c)) == any(unicodedata.category(x).startswith("L") for x in c.lower()) and (not letter or langid.words_of(c))


def test_a_repeated_id_does_not_decide_the_sample(spark):
    """Thousands of texts under one id, and thousands of equal rows: the sample
    is about as large as asked for."""
    one_id = [(7, f"the word number {i} is here", "en") for i in range(4000)]
    same = [(8, "das ist ein haus", "de")] * 4000 + [(None, f"ein satz {i}", "de") for i in range(500)]
    df = spark.createDataFrame(one_id + same, "doc_id long, text string, lang string")
    model = langid.fit(df, PATH, train_rows=400)
    en = langid.predict(spark.createDataFrame([(1, "the word is here"), (2, "ein satz")], "doc_id long, text string"), model)
    assert {r.doc_id: r.lang_pred for r in en.collect()} == {1: "en", 2: "de"}
    drawn = {(r.lang): r.n for r in spark.read.parquet(max(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/cardsentry/langid-words-*"), key=os.path.getmtime))
             .where("word in ('here', 'satz')").groupBy("lang").sum("n").toDF("lang", "n").collect()}
    assert 300 < drawn["en"] < 500 and 300 < drawn["de"] < 500


def test_long_words_and_texts(spark):
    model = langid.fit(spark.createDataFrame([(1, "the house is big and the dog runs", "en"), (2, "das haus ist groß und der hund läuft", "de")],
                                             "doc_id long, text string, lang string"), PATH)
    long = ["x" * 200_000, "the house " * 100_000, "日本" * 30_000, "haus" * 5]
    got = langid.predict(spark.createDataFrame(list(enumerate(long)), "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.lang_pred for r in got}[1] == "en" and all(0 <= r.score <= 1 for r in got)
    scorer = langid.Scorer(model.log_prob, PATH)
    scorer.texts([langid.words_of(t) for t in long])
    assert max(map(len, scorer.index)) <= langid.SHORT


def test_the_sample_lies_in_a_few_files(spark):
    """However many partitions the session shuffles to, the fit writes and reads
    its words by as many tasks as there are cores at most."""
    df = spark.createDataFrame([(i, f"the word{chr(97 + i % 26)}{chr(97 + i // 26)} is here", "en") for i in range(500)], "doc_id long, text string, lang string")
    conf = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        langid.fit(df, PATH)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    newest = max(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/cardsentry/langid-words-*"), key=os.path.getmtime)
    assert 0 < len(glob.glob(f"{newest}/*.parquet")) <= spark.sparkContext.defaultParallelism < 97
    assert spark.read.parquet(newest).groupBy("lang").sum("n").first()[1] == 4 * 500
