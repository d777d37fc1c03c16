"""Reading and writing tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum import fixed_values as fv


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table: either ``name.parquet`` or a folder of part files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_sheet(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """An exported spreadsheet range: header row, declared types, nothing inferred.

    Cells may hold quotes (doubled), commas and line breaks. A cell that is not of its declared type, or a row of another
    length, fails the read. Sheets are small, so one that spans lines is read as a whole.
    """
    schema = T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in columns.items()])
    return spark.read.schema(schema).csv(
        path, header=True, enforceSchema=False, mode="FAILFAST", quote='"', escape='"', multiLine=True
    )


def load_seed(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A small lookup that ships with the code."""
    return spark.createDataFrame(list(rows), schema=", ".join(f"{c} string" for c in columns))


def topic_type_seed(spark: SparkSession) -> DataFrame:
    return load_seed(spark, fv.TOPIC_TYPES, ["section_type_code", "section_type_name"])


def rename_cast(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Project to ``{new name: (source column, type)}``."""
    return df.select(*[F.col(source).cast(kind).alias(new) for new, (source, kind) in spec.items()])


_COMMITS = "_commits"
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _freeing(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside are deleted with its end: the stored table is read from then on."""
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)


def by_month(date: str) -> dict[str, Column]:
    """A table layout by year and month of a date."""
    return {"__year": F.year(date), "__month": F.month(date)}


def write_table(
    df: DataFrame, path: str, layout: Mapping[str, Column] | None = None, cluster: Sequence[str] = (), together: bool = False
) -> DataFrame:
    """Replace a stored table and read it back, which also cuts the lineage.

    Rows go to a version folder of their own. Then one rename puts a numbered commit in place that names the folder, so that
    readers see the old table or the new one, never a part, and a failed write changes nothing. The version before stays
    for those who are reading it; older ones are deleted.

    ``layout``: partition columns to add. Rows of a partition are brought together, large ones in several files, and sorted by
    the ``cluster`` columns within them. ``together``: they lie in few parts already, so rows aren't moved for it.
    """
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    layout = dict(layout or {})
    if layout:
        df = df.withColumns(layout)
        df = (df if together else df.hint("rebalance", *layout)).sortWithinPartitions(*layout, *cluster)
    elif cluster:
        df = df.sortWithinPartitions(*cluster)
    fs, at = _files(spark, path)
    try:
        with _freeing(spark):
            df.write.partitionBy(*layout).parquet(f"{path}/{version}")
    except Exception:
        fs.delete(at(version), True)
        raise
    _commit(spark, path, version)
    return spark.read.schema(df.schema).parquet(f"{path}/{version}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table that ``write_table`` stored, with its layout's columns."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/{versions[max(versions)]}")


def _files(spark: SparkSession, path: str):
    """The path's file system, and Hadoop paths below it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()), lambda *names: hadoop("/".join([path, *names]))


def total_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Size of files as they are stored."""
    found = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths)
    return sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in found)


FEW = 200  # most partitions that Spark writes row by row (spark.shuffle.sort.bypassMergeThreshold); beyond, a task holds all its rows


def part_count(spark: SparkSession, size: int, least: int) -> int:
    """How many parts to bring rows of a large table together in, each with ``least`` of its ``size`` (bytes or rows) or more.

    Parts grow, up to 32 times ``least``, before they become more than ``FEW``: a small, well packed file holds very many rows,
    which the task that deals them to more parts would all keep in memory.
    """
    fine, coarse = -(-size // least), -(-size // (32 * least))
    return max(spark.sparkContext.defaultParallelism, min(fine, max(FEW, coarse)))


def _versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Folder names by number of commit."""
    fs, at = _files(spark, path)
    if not fs.exists(at(_COMMITS)):
        return {}
    names = [f.getPath().getName() for f in fs.listStatus(at(_COMMITS))]
    return {int(number): version for number, _, version in (n.partition(".") for n in names) if version}


def _commit(spark: SparkSession, path: str, version: str) -> None:
    fs, at = _files(spark, path)
    before = _versions(spark, path)
    fs.mkdirs(at(_COMMITS))
    number = max(before, default=0) + 1
    blank, placed = at(_COMMITS, version), at(_COMMITS, f"{number:012d}.{version}")  # the folder's name is all there is to tell
    fs.create(blank).close()
    if not fs.rename(blank, placed):
        raise OSError(f"can't commit {placed}")
    for old in sorted(before)[:-1]:
        fs.delete(at(before[old]), True)
        fs.delete(at(_COMMITS, f"{old:012d}.{before[old]}"), False)


def on_date(df: DataFrame, column: str, date: str) -> DataFrame:
    """Rows of one date; of a table laid out ``by_month`` only that month's files are read."""
    day = F.to_date(F.lit(date))
    wanted = F.col(column) == day
    for name, part in (("__year", F.year(day)), ("__month", F.month(day))):
        if name in df.columns:
            wanted = wanted & (F.col(name) == part)
    return df.filter(wanted)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, named by the session's ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="rostrum-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def kept_aside(df: DataFrame) -> DataFrame:
    """A small intermediate table, written once below the shared folder and read back."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    with _freeing(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def materialise(
    df: DataFrame, name: str, kind: str, folder: str | None = None, layout: Mapping[str, Column] | None = None, cluster: Sequence[str] = (),
    together: bool = False,
) -> DataFrame:
    """``table`` is stored in full under the folder; ``view`` stays lazy, under the folder's and its own name."""
    if kind == "table":
        return write_table(df, f"{folder}/{name}", layout, cluster, together)
    return publish_view(df, f"{re.sub('[^A-Za-z0-9]+', '_', folder.rpartition('/')[2])}_{name}" if folder else name)
