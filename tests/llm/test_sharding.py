import zlib

import pytest

from daybook.llm import sharding


def check(rows, shards):
    """Slots are gapless per shard."""
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(0 <= k < shards for k in slots)


def test_documents_by_key(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.report(df, bucket_bytes=20_000).collect()
    check(rows, 24)
    want = sorted((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in df.collect())
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert moved and all(r.grown_shard == 24 for r in moved) and len(moved) < len(rows) / 10
    amounts = [sum(r.shard == s for r in rows) for s in range(24)]
    assert min(amounts) > 15 and max(amounts) < 85
    half = {r.doc_id: r.shard for r in sharding.report(df.filter("doc_id % 2 = 0")).collect()}
    assert all(half[r.doc_id] == r.shard for r in rows if r.doc_id in half)  # the id decides, not the company


def test_order_is_shuffled_and_reproducible(spark, tmp_path):
    df = spark.range(4_000).selectExpr("id as doc_id", "cast(id as string) as text", "id * 2 as extra")
    first, second = (sharding.write_shards(df, str(tmp_path / name), shards=3, bucket_bytes=4_000) for name in "ab")
    rows = sorted((r.shard, r.slot, r.doc_id) for r in first.collect())
    assert rows == sorted((r.shard, r.slot, r.doc_id) for r in second.collect()) and len(rows) == 4_000
    ids = [d for s, _, d in rows if s == 0]
    falls = sum(a > b for a, b in zip(ids, ids[1:]))
    assert 0.4 < falls / len(ids) < 0.6  # ascending runs are gone
    assert first.columns == ["doc_id", "text", "extra", "shard", "slot"] and first.filter("extra <> doc_id * 2").count() == 0


def test_edge_rows(spark, tmp_path):
    rows = [(1, "a", 1)] * 50 + [(None, None, 2), (None, "x", 3), (2, "", 4), (3, "é" * 100_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, size int")
    got = sharding.report(df).collect()
    check(got, 24)
    assert len(got) == len(rows) and len({r.shard for r in got if r.doc_id is None}) == 1
    assert sorted(r.size for r in got if r.doc_id in (2, 3)) == [8, 200_008]
    assert sharding.report(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.write_shards(df.withColumnRenamed("size", "slot"), str(tmp_path / "x"))
