"""What tasks, files and buffers grow with."""

import glob
import os
import tracemalloc

from pyspark.sql import functions as F

from loadsieve.functions import similarity as S
from workload import loads


def test_a_fixed_layout_is_written_as_files_of_bounded_size_from_shuffled_keys(spark, tmp_path, monkeypatch):
    rows = [(i * 31_250, n % 3 + 1) for i in range(12) for n in range(4)]
    lines = spark.createDataFrame(rows, "l_orderkey BIGINT, l_linenumber INT")
    lines.withColumns({"l_shipdate": F.lit("2020-01-02").cast("date"), "l_extendedprice": F.lit(1.5)}).write.parquet(f"{tmp_path}/sf/lineitem.parquet")
    monkeypatch.setattr(loads, "shared_dir", lambda spark, name: f"{tmp_path}/{name}")
    found = loads.load_fixed_files(spark, f"{tmp_path}/sf")
    assert found.count() == len(rows)
    assert len(glob.glob(f"{tmp_path}/fixed/f=*")) == 12
    assert {os.path.splitext(f)[1] for f in glob.glob(f"{tmp_path}/fixed/f=*/part-*")} == {".gz"}


def test_small_blocks_share_tasks(spark, tmp_path):
    spark.range(40_000).select(F.concat(F.lit("line "), "id").alias("value")).repartition(4).write.text(f"{tmp_path}/t")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def work():
        blocks = spark.read.text(f"{tmp_path}/t").select("_metadata.file_path", "_metadata.file_block_start", F.spark_partition_id().alias("task"))
        return blocks.agg(F.count_distinct("file_path", "file_block_start"), F.count_distinct("task"), F.count("*")).first()

    blocks, tasks, lines = loads._in_small_blocks(spark, work, 1_000)
    assert blocks > 400 and lines == 40_000
    assert tasks <= 8 * spark.sparkContext.defaultParallelism
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None


def test_one_long_text_does_not_widen_the_others():
    texts = ["informe de pedidos " * 2000, *(f"key {i}" for i in range(2_000))]
    tracemalloc.start()
    counts, lengths = S.signatures(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000
    for i in (0, 1, 1_999):
        assert lengths[i] == len(texts[i])
        assert counts[i].tolist() == [sum(ord(c) % 64 == b for c in texts[i]) for b in range(64)]


def test_bounds_of_very_long_texts_do_not_overflow():
    pairs = S.Pairs()
    pairs.left["a" * 40_000] = pairs.right["a" * 40_000] = 0
    assert pairs.bounds([0], [0]).tolist() == [1.0]


def test_signatures_in_slices(monkeypatch):
    texts = ["", "ab", "ñ€", "", "x" * 9, "cd"]
    whole = S.signatures(texts)[0].tolist()
    monkeypatch.setattr(S, "TABLE_CELLS", 3)
    assert S.signatures(texts)[0].tolist() == whole
    assert S.signatures([])[0].shape == (0, 64)


def test_folders_are_listed_by_a_bounded_number_of_tasks(spark):
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 200
