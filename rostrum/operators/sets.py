"""Unions of differently shaped tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_tagged(tables: Mapping[str, DataFrame], tag: str = "type") -> DataFrame:
    """All rows of all tables; missing columns are NULL and the tag names the table."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def replace_column(df: DataFrame, name: str, value) -> DataFrame:
    """``select * except (name), value as name``: the replaced column moves to the end."""
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, value.alias(name))


def computed_once(df: DataFrame, **columns) -> DataFrame:
    """Add costly columns that later filters and projections read several times.

    Catalyst copies a column's expression into every place that uses it, which
    repeats regular expressions over long texts. Behind a one-element generator the
    value is computed once per row and then carried.
    """
    record = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(record)))
