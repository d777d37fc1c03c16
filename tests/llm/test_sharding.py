"""Shards of near equal bytes."""

import zlib
from collections import defaultdict

from llm import sharding


def _check(rows, texts, shards):
    sizes, slots, where = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        body = texts[r.doc_id] or ""
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(body.encode()) + 16, zlib.crc32(body.encode()), "bytes", None)
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        where[body].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sizes) <= set(range(shards))
    return sizes, where


def test_near_equal_and_groups_together(docs):
    texts = [f"text {i % 700} " + "x" * (i % 700 % 50) for i in range(1400)] + ["hot text"] * 700 + [None, "", "é" * 2000]
    rows = sharding.shard_report(docs(*texts).repartition(5), 4).collect()
    sizes, where = _check(rows, dict(enumerate(texts)), 4)
    mean = sum(sizes.values()) / 4
    assert len(rows) == len(texts) and len(sizes) == 4
    assert max(abs(s - mean) for s in sizes.values()) < 4016 + mean / 32
    assert sum(len(w) > 1 for t, w in where.items() if t not in ("hot text", "")) == 0  # null and empty are two texts


def test_small_and_empty(docs):
    rows = sharding.shard_report(docs("a", "a", None), 40).collect()
    _check(rows, {0: "a", 1: "a", 2: None}, 40)
    assert len(rows) == 3
    assert sharding.shard_report(docs("a").limit(0), 40).collect() == []


def test_nulls_repeats_and_other_columns(docs, tmp_path, spark):
    frame = docs("a", "a", "b", "b", None, ids=[1, 1, None, None, None])
    out = sharding.assign_shards(frame, 2)
    assert out.columns == ["doc_id", "text", "TEXT_1", "_range_1", "n_words", "size", "shard", "slot"] and out.count() == 5
    sharding.write_shards(out, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 5
