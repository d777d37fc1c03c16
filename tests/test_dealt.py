"""How rows of the given tables are dealt to tasks."""

import os

from registry import catalog
from registry.raw_tables import RawTables
from rostrum.sources import tables


def test_tables_are_dealt_to_more_parts_as_they_grow(spark, tmp_path, monkeypatch):
    spark.range(50_000).coalesce(1).write.parquet(path := str(tmp_path / "t"))
    df, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    assert catalog.dealt(df).rdd.getNumPartitions() == cores
    monkeypatch.setattr(catalog, "DEAL", 2000)
    assert catalog.dealt(df).rdd.getNumPartitions() > 10 * cores
    by_id = catalog.dealt(df, "id")
    assert by_id.rdd.getNumPartitions() > 10 * cores and by_id.count() == 50_000
    small = catalog.dealt(spark.range(10), "id", beside=df)
    assert small.rdd.getNumPartitions() > 10 * cores


def test_attendance_is_grouped_in_parts_that_grow(spark, monkeypatch):
    monkeypatch.setattr(catalog, "DEAL", 4000)
    raw = RawTables(spark, "/root/testdata/sf0.001")
    parts = -(-os.path.getsize("/root/testdata/sf0.001/lineitem.parquet") // 4000)
    assert raw["lineitem"].rdd.getNumPartitions() == parts
    plan = raw["attendance"]._jdf.queryExecution().toString()
    assert "hashpartitioning(c_custkey" in plan and f", {parts})" in plan


def test_tasks_that_deal_a_large_table_do_not_hold_their_rows(spark):
    """Spark's writer for more than 200 partitions keeps all rows of a task in memory; one for fewer doesn't."""
    most = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    cores = spark.sparkContext.defaultParallelism
    parts = [tables.part_count(spark, size, 250_000) for size in (1, 32_000_000, 195_000_000, 1_600_000_000, 16_000_000_000)]
    assert parts == [cores, 128, most, most, 2000]
