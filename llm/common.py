"""What several operators share: picking columns, and a place for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ID, TEXT = "doc_id", "text"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """Columns by exact name, the first of equal names; others that differ only in case don't get in the way."""
    wanted = {n: n for n in names} | renamed
    at = {old: df.columns.index(old) for old in wanted.values()}
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{at[old]}").alias(new) for new, old in wanted.items()])


def clear(df: DataFrame, *keep: str, reserved: Iterable[str] = ()) -> DataFrame:
    """All columns, under names that differ by more than case.

    The first column of each name in ``keep`` has it for itself; others of that name, of a reserved one, or of any earlier
    column's, get ``_1`` at the end.
    """
    at = {df.columns.index(k): k for k in keep if k in df.columns}
    used = {k.lower() for k in at.values()} | {r.lower() for r in reserved}
    names = []
    for i, name in enumerate(df.columns):
        if i not in at:
            while name.lower() in used:
                name += "_1"
            used.add(name.lower())
        names.append(name)
    return df.toDF(*names)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Only a local session may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Written once and read back: the lineage ends there and lost executors lose nothing.

    The shuffle files of the write are of no more use then, so Spark is asked to delete them with it. ``batch``: most rows that
    Python functions get at a time, where these are whole texts.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    wanted = {_CLEAN_UP: "true"} | ({} if batch is None else {_BATCH: str(batch)})
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the files of stored tables, once everything read from them is stored itself."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, *order: Column, name: str = "no") -> DataFrame:
    """A stored copy with consecutive numbers from 0 in the given order, without any global sort in one task.

    Rows fall into sorted ranges; the number is that within the range plus the rows of the ranges before, of which there are as
    many as shuffle partitions. Rows that are equal in all of ``order`` fall into one range, so give a last key that differs.
    """
    spark, names = df.sparkSession, df.columns
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = stored(ranged, name).withColumn("_range", F.shiftright("_at", 33))
    before, offsets = 0, []
    for r in sorted(ranged.groupBy("_range").count().collect()):  # one row per shuffle partition
        offsets.append((r[0], before))
        before += r["count"]
    known = spark.createDataFrame(offsets, "_range long, _before long")
    out = ranged.join(F.broadcast(known), "_range")
    return out.select(*names, (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))
