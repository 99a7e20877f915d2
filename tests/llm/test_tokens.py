"""Word-cached encoding, token shards and packing against the library and brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cardsentry.llm import packing, tokenbin
from cardsentry.llm.wordids import text_encoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.sampled_from(list("abZé'sß 1.,!\n\t 日Σ́  _|<>")), max_size=60))
def test_chunked_ids_are_the_librarys(path, text):
    encoder = text_encoder(path)
    assert encoder.encode(text) == encoder.whole(text)


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(parts=st.lists(st.sampled_from([" ", "  ", "\u00a0", "\u00a0 ", "\u3000", "\t", "\n", "\r", "\x1c", "\x85", "a", "é", "日", ".", "<|endoftext|>",
                                       "<|ENDOFTEXT|>", "<|startoftext|>", "'s", "\u0301"]), max_size=30))
@example(parts=["a", " ", "\u00a0 ", "\u00a0 ", "b"])
@example(parts=["a ", "<|endoftext|>", " b"])
def test_ids_are_those_of_an_untouched_tokenizer(path, parts):
    text = "".join(parts)
    want = _untouched(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(text_encoder(path).encode(text), "<u4").tolist() == want


@lru_cache
def _untouched(path):
    return Tokenizer.from_file(path)


def _want(rows, path, end):
    encoder = text_encoder(path)
    return Counter((k, encoder.whole(t or "") + np.array([end], "<u4").tobytes()) for k, t in rows)


def test_shards_round_trip(spark, odd_docs, tmp_path):
    folder = f"file://{tmp_path}/shards"
    manifest = tokenbin.write_shards(odd_docs, folder, BYTE, end_id=0, shard_rows=5)
    got = tokenbin.read_records(spark, folder, manifest).collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    want = _want(rows, BYTE, 0)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (k, len(raw) // 4, zlib.crc32(raw)) for (k, raw), n in want.items() for _ in range(n))
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1]]
    keys = [r.doc_id for r in ordered]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k)
    shards = manifest.collect()
    for key in {k for k, _ in rows if k is not None}:
        found = Counter(ids.astype("<u4").tobytes() for ids in tokenbin.lookup(folder, shards, key))
        assert found == Counter({raw: n for (k, raw), n in want.items() if k == key})
    assert tokenbin.lookup(folder, shards, 10**12) == []


def test_no_documents_no_shards(spark, no_docs, tmp_path):
    folder = f"file://{tmp_path}/none"
    manifest = tokenbin.write_shards(no_docs, folder, BYTE)
    assert manifest.count() == 0 and tokenbin.read_records(spark, folder, manifest).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20_000])
def test_perfect_hash_is_minimal(n):
    rng = random.Random(n)
    keys = np.array(list({rng.getrandbits(64) for _ in range(n)}), np.uint64)
    index = tokenbin.MphIndex.build(keys)
    assert sorted(index.slots(keys)) == list(range(n))


def _one_by_one(lengths, window):
    """Plain best fit, one piece at a time."""
    rest = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rest) if r >= length]
        if fits:
            rest[min(fits, key=lambda i: rest[i])] -= length
        else:
            rest.append(window - length)
    return Counter(rest)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_plan_is_best_fit_decreasing(lengths):
    window = 40
    plan = packing.plan_best_fit(dict(Counter(lengths)), window)
    used = Counter()
    for length, low, high, first, per, offset in plan:
        for rank in range(low, high):
            w = first + (rank - low) // per
            assert used[w] >= 0 and used[w] == offset + (rank - low) % per * length
            used[w] += length
    assert Counter(window - n for n in used.values()) == _one_by_one(lengths, window)


def test_packed_pieces(spark, odd_docs):
    packed = packing.pack(odd_docs, WORD, window=64, end_id=2, keep_ids=True).cache()
    rows = packed.collect()
    docs = _want([(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()], WORD, 2)
    pieces = Counter()
    for (key, raw), n in docs.items():
        for at in range(0, len(raw) // 4, 64):
            piece = raw[4 * at:4 * (at + 64)]
            pieces[key, at, len(piece) // 4, zlib.crc32(piece), len(raw) // 4] += n
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == pieces
    fill = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 64 and sorted(fill) == list(range(len(fill)))
    assert Counter(64 - n for n in fill.values()) == _one_by_one([r.length for r in rows], 64)
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for s in fill:
        own = sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset)
        assert bytes(whole[s].ids) == b"".join(bytes(r.ids) for r in own) and whole[s].n_ids == fill[s]


def test_nothing_to_pack(no_docs):
    assert packing.pack(no_docs, WORD).count() == 0
