"""Sharding against a placement that is computed row by row in Python."""

import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from curatrix.llm import sharding
from tests.llm.test_operators import TEXTS, documents, prose


def slot_of(doc_id, text):
    """pmod of the 64-bit xxHash of id and text, seeded with 42, in which nulls don't count."""
    seed = 42
    if doc_id is not None:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed)
    if text is not None:
        seed = xxhash.xxh64_intdigest(text.encode(), seed)
    return (seed - (1 << 64) if seed >> 63 else seed) % sharding.SLOTS


def size_of(text):
    return len((text or "").encode()) + 8


def placement(rows, shards=24):
    """Shard of each slot: the fullest slots first, each to the emptiest shard."""
    load = Counter()
    for i, t in rows:
        load[slot_of(i, t)] += size_of(t)
    sums, slots, of = [0] * shards, [0] * shards, {}
    for slot in sorted(range(sharding.SLOTS), key=lambda s: (-load[s], s)):
        to = min(range(shards), key=lambda s: (sums[s], slots[s], s))
        of[slot], sums[to], slots[to] = to, sums[to] + load[slot], slots[to] + 1
    return of


@pytest.fixture(scope="module")
def texts():
    return [(i, prose(i, 5 + i % 40)) for i in range(2000)] + TEXTS + [(7, "the same row")] * 500


def test_placement(spark, texts):
    got = sharding.shard(spark, documents(spark, texts)).collect()
    of = placement(texts)
    want = Counter((i, size_of(t), zlib.crc32((t or "").encode()), "bytes", of[slot_of(i, t)], None, slot_of(i, t)) for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard, r.vslot) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) == set(range(24)) and all(sorted(r.slot for r in rows) == list(range(len(rows))) for rows in by.values())
    loads = [sum(r.size for r in rows) for rows in by.values()]
    # the copies of one row and the two long texts can't be split by a hash; all other shards are near equal
    assert sorted(loads)[-4] - min(loads) <= 400


def test_map_is_loaded_edited_and_kept(spark, texts, tmp_path):
    path = f"file://{tmp_path}/map"
    plain = [t for t in texts if t[1] != "the same row"]
    first = sharding.shard(spark, documents(spark, plain), map_path=path).collect()
    v1 = sharding.load_map(spark, path, 1)
    assert all(v1.shard_of[r.vslot] == r.shard for r in first)
    again = sharding.shard(spark, documents(spark, plain), map_path=path).collect()
    assert sorted((str(r.doc_id), r.vslot, r.shard) for r in again) == sorted((str(r.doc_id), r.vslot, r.shard) for r in first)
    assert sharding.newest_version(spark, path) == 1  # nothing to move: no new version
    more = plain + [(10_000 + i, prose(i, 300)) for i in range(200)]
    changed = sharding.shard(spark, documents(spark, more), map_path=path).collect()
    v2 = sharding.load_map(spark, path, 2)
    assert sharding.newest_version(spark, path) == 2 and all(v2.shard_of[r.vslot] == r.shard for r in changed)
    moved = sum(a != b for a, b in zip(v1.shard_of, v2.shard_of, strict=True))
    assert 0 < moved < sharding.SLOTS / 10
    loads = Counter()
    for r in changed:
        loads[r.shard] += r.size
    assert max(loads.values()) <= 1.03 * sum(loads.values()) / 24
    placed = sharding.in_shards(spark, documents(spark, more), map_path=path)
    assert all(v2.shard_of[r.vslot] == r.shard for r in placed.collect()) and sharding.newest_version(spark, path) == 2
    # a version whose writer was lost doesn't count
    (tmp_path / "map" / "v000003").mkdir()
    assert sharding.newest_version(spark, path) == 2
    with pytest.raises(Exception, match="(?i)exists"):
        sharding.save_map(spark, v2, path)
    with pytest.raises(ValueError, match="slots, not"):
        sharding.current_map(spark, [1, 2], 2, path)


def test_one_more_shard(spark, texts, tmp_path):
    path = f"file://{tmp_path}/map"
    plain = [t for t in texts if t[1] != "the same row"]
    sharding.shard(spark, documents(spark, plain), map_path=path).collect()
    old = sharding.load_map(spark, path, 1)
    new = sharding.rebalanced(spark, documents(spark, plain), path, 1, 25)
    assert new.version == 2 and sharding.load_map(spark, path, 2) == new
    moved = [(a, b) for a, b in zip(old.shard_of, new.shard_of, strict=True) if a != b]
    assert moved and all(b == 24 for _, b in moved) and len(moved) < sharding.SLOTS / 10
    with pytest.raises(ValueError, match="taken away"):
        sharding.rebalance(old, [1] * sharding.SLOTS, 3)


def test_odd_input(spark, tmp_path):
    docs = documents(spark)  # its columns vslot and shard are replaced
    placed = sharding.in_shards(spark, docs)
    assert placed.columns == [c for c in docs.columns if c not in ("vslot", "shard")] + ["vslot", "shard"]
    placed.drop("Text").write.parquet(f"file://{tmp_path}/out")
    assert Counter((r.doc_id, r[1]) for r in placed.collect()) == Counter(TEXTS)
    upper = sharding.in_shards(spark, spark.createDataFrame([(1, "a", 9)], "doc_id long, text string, SHARD int"))
    assert upper.columns == ["doc_id", "text", "vslot", "shard"]
    none = documents(spark, [])
    assert sharding.shard(spark, none).count() == 0 and sharding.in_shards(spark, none).count() == 0
