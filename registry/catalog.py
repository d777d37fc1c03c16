"""The catalogue of registered queries: a Spark callable and its checking SQL each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.sources.tables import part_count, total_bytes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


def _as_text(column, kind: T.DataType):
    if isinstance(kind, T.StructType):
        return F.concat_ws("/", *[_as_text(column[f.name], f.dataType) for f in kind.fields])
    if isinstance(kind, T.TimestampNTZType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    return column.cast("string")


def portable(df: DataFrame) -> DataFrame:
    """Dates and arrays as text, so that both engines show the same values."""

    def shown(field: T.StructField):
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.ArrayType):
            texts = F.transform(column, lambda x: _as_text(x, kind.elementType))
            return F.array_join(texts, "|").alias(field.name)
        if isinstance(kind, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return _as_text(column, kind).alias(field.name)
        if isinstance(kind, (T.IntegerType, T.ShortType)):
            return column.cast("bigint").alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema.fields])


DEAL = 2 << 20  # bytes of a table's files for each part, or more (part_count)


def dealt(df: DataFrame, *keys: str, beside: DataFrame | None = None) -> DataFrame:
    """A table of few files, which as few tasks would read: deal its rows to all cores, and to more parts as it grows.

    So no part, nor what a task holds of it, grows with the table. Tables of many files stay as they are, unless ``keys`` are
    given, by which rows are brought together: joins and groups on these keys then need no shuffle of their own. ``beside``:
    a larger table that these rows meet, whose size then tells the number of parts.
    """
    cores, files = df.sparkSession.sparkContext.defaultParallelism, (df if beside is None else beside).inputFiles()
    if not keys and len(files) >= min(cores, 64):
        return df
    return df.repartition(part_count(df.sparkSession, total_bytes(df.sparkSession, files), DEAL), *keys)
