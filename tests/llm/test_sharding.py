"""Virtual slots: near equal bytes, gapless places, maps that are edited."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import xxhash

from cardsentry.llm import sharding


def _slot(doc_id, text, copy, n_slots=sharding.N_SLOTS):
    """Spark's 64-bit hash by columns (each seeds the next, nulls pass) in plain Python."""
    seed = 42
    for value in (doc_id, text):
        if value is not None:
            seed = xxhash.xxh64_intdigest(value.encode() if isinstance(value, str) else value.to_bytes(8, "little", signed=True), seed)
    last = xxhash.xxh64_intdigest(copy.to_bytes(8, "little"), xxhash.xxh64_intdigest(seed.to_bytes(8, "little"), 42))
    return (last - (1 << 64 if last >> 63 else 0)) % n_slots


def _by_hand(spark, rows, got, folder, n_shards):
    """Every placement recomputed from the rows and the stored maps."""
    seen, want = Counter(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        slot = _slot(doc_id, text, seen[doc_id, text])
        seen[doc_id, text] += 1
        want.append((str(doc_id), len(data) + 1, zlib.crc32(data), slot))
    assert sorted((str(r.doc_id), r["size"], r.text_crc32, r.virtual_slot) for r in got) == sorted(want)
    first, second = (sharding.read_map(spark, folder, v) for v in (1, 2))
    assert first == {s: s % n_shards for s in range(sharding.N_SLOTS)}
    assert set(second) == set(first) and set(second.values()) <= set(range(n_shards))
    assert all(second[r.virtual_slot] == r.shard for r in got)
    places = defaultdict(list)
    for r in sorted(got, key=lambda r: r.slot):
        places[r.shard].append(r)
    for placed in places.values():
        assert [r.slot for r in placed] == list(range(len(placed)))
        assert [r.virtual_slot for r in placed] == sorted(r.virtual_slot for r in placed)
    loads = [sum(r["size"] for r in places[s]) for s in range(n_shards)]
    return first, second, loads


def test_documents(spark, odd_docs, no_docs, tmp_path):
    folder = f"file://{tmp_path}/map"
    got = sharding.shard_documents(odd_docs, 4, folder).collect()
    _by_hand(spark, [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()], got, folder, 4)
    assert sharding.shard_documents(no_docs, 4, f"file://{tmp_path}/none").count() == 0


def test_repeated_rows_are_split(spark, tmp_path, monkeypatch):
    """Half of all rows are one row, a sixth one text; ranges of copies end in the middle."""
    monkeypatch.setattr(sharding, "COPY_RANGE", 700)
    rows = [(7, "one row again and again " * 8)] * 3000 + [(i, "one text of many ids " * 9) for i in range(1000)]
    rows += [(i, f"text {i} " * (1 + i % 40)) for i in range(2000)]
    folder = f"file://{tmp_path}/repeated"
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 8, folder).collect()
    first, second, loads = _by_hand(spark, rows, got, folder, 8)
    assert max(loads) - min(loads) <= 0.01 * sum(loads) / 8
    # An edit, not a new deal: most slots stay where they were.
    assert 0 < sum(first[s] != second[s] for s in first) < len(first) / 4


def test_the_next_edit_starts_from_the_stored_map(spark, tmp_path):
    folder = f"file://{tmp_path}/edits"
    rows = [(i, f"text {i} " * (1 + i % 7)) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sharding.shard_documents(docs, 4, folder).count()
    # Nothing changed, nothing moves.
    sharding.shard_documents(docs, 4, folder, version=2).count()
    assert sharding.read_map(spark, folder, 3) == sharding.read_map(spark, folder, 2)


def _sizes(n):
    return {s: (100 + 37 * s % 101, 1) for s in range(n)}


def test_balanced():
    sizes = _sizes(4096)
    loads = sharding._loads(sharding.balanced_map(sizes, 8), sizes, 8)
    assert max(loads) - min(loads) <= 200


def test_growing_moves_only_into_the_new_shard():
    sizes = _sizes(4096)
    before = sharding.balanced_map(sizes, 8)
    after = sharding.grow(before, sizes, 8)
    assert all(after[s] in (before[s], 8) for s in before)
    loads = sharding._loads(after, sizes, 9)
    assert max(loads) - min(loads) <= 0.01 * sum(loads)


def test_rebalancing_edits_few_slots():
    sizes = _sizes(4096)
    before = sharding.balanced_map(sizes, 8)
    grown = {s: (b * 3 if before[s] == 2 else b, n) for s, (b, n) in sizes.items()}
    after = sharding.rebalance(before, grown, 8)
    loads = sharding._loads(after, grown, 8)
    assert max(loads) - min(loads) <= 700
    assert sum(before[s] != after[s] for s in before) < 500


def test_versions_are_kept(spark, tmp_path):
    folder = f"file://{tmp_path}/versions"
    first = sharding.balanced_map(_sizes(64), 2, 64)
    sharding.write_map(spark, first, folder, 1)
    sharding.write_map(spark, sharding.grow(first, _sizes(64), 2), folder, 2)
    assert sharding.read_map(spark, folder, 1) == first != sharding.read_map(spark, folder, 2)
