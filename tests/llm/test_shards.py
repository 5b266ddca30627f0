import zlib

from pyspark.sql import functions as F

from loadsieve.llm import QUERIES
from loadsieve.llm.shards import jump_points, with_shards, with_slots, write_shards


def jump(key, buckets):
    key, b, j = key % (1 << 64), -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_points_against_the_loop(spark):
    keys = [0, 1, -1, 7, 2**63 - 1, -(2**63), *range(100, 160)]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump_points(F.col("k"), 40).alias("p")).collect()
    for r in got:
        for n in range(1, 41):
            assert max(p for p in r.p if p < n) == jump(r.k, n)


def test_query(spark, sf_dir, docs):
    got = QUERIES["op6_jump_shards"](spark, sf_dir)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows, texts = got.collect(), {r.doc_id: r.text for r in docs.collect()}
    hashed = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (jump(hashed[r.doc_id], 16), jump(hashed[r.doc_id], 17))
        assert r.grown_shard in (r.shard, 16)
    for s in range(16):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))


def test_edges(spark, edge, nothing, tmp_path):
    placed = with_slots(with_shards(edge.select("doc_id", F.length("text").alias("n")), "doc_id", 3), ["doc_id", "n"], rows_per_chunk=2)
    rows = placed.collect()
    assert len(rows) == edge.count()
    for s in range(3):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    hot = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"))
    assert sorted(r.slot for r in with_slots(with_shards(hot, "doc_id", 4), ["doc_id"]).collect()) == list(range(5000))
    assert with_slots(with_shards(nothing.select("doc_id"), "doc_id", 3), ["doc_id"]).count() == 0
    write_shards(edge, "doc_id", 3, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == edge.count()
