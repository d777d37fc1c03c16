"""Joins.

No join here is forced to broadcast unless its small side has a proven bound.
Lookups are left to Spark's own size check (``spark.sql.autoBroadcastJoinThreshold``
on measured sizes, re-checked at run time); above it they become shuffled joins whose
hot left-hand keys adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY = "__key_"


def _with_renamed_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: _KEY + k for k in keys})


def _keys_match(keys: Sequence[str], null_safe: Sequence[str]) -> Column:
    tests = [
        F.col(k).eqNullSafe(F.col(_KEY + k)) if k in null_safe else F.col(k) == F.col(_KEY + k)
        for k in keys
    ]
    return reduce(and_, tests)


def left_lookup(
    facts: DataFrame, dimension: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()
) -> DataFrame:
    """Facts with the dimension's other columns; NULL keys match only where ``null_safe``."""
    keys = list(keys)
    return facts.join(_with_renamed_keys(dimension, keys), _keys_match(keys, null_safe), "left").drop(
        *[_KEY + k for k in keys]
    )


def inner_lookup(facts: DataFrame, dimension: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()) -> DataFrame:
    """As ``left_lookup``, without the facts that find nothing."""
    keys = list(keys)
    return facts.join(_with_renamed_keys(dimension, keys), _keys_match(keys, null_safe)).drop(*[_KEY + k for k in keys])


def canonical_lookup(
    df: DataFrame, column: str, mapping: DataFrame, variant: str, canonical: str
) -> DataFrame:
    """Replace a column by its canonical form where a mapping has one."""
    known = mapping.select(F.col(variant).alias(column), F.col(canonical).alias("__canonical"))
    return left_lookup(df, known, [column]).withColumn(
        column, F.coalesce("__canonical", column)
    ).drop("__canonical")


def reconcile_full(
    preferred: DataFrame, other: DataFrame, keys: Sequence[str], fill: Sequence[str] = ()
) -> DataFrame:
    """Full outer join on keys; shared ``fill`` columns prefer the first side.

    Each side is used once. Rows with a NULL key match nothing; a further key spreads them over all tasks.
    """
    keys, fill = list(keys), list(fill)
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])

    def spread(side: DataFrame) -> DataFrame:
        return side.withColumn("__spread", F.when(complete, F.lit(0).cast("bigint")).otherwise(F.xxhash64(*side.columns)))

    right = spread(other).withColumnsRenamed({c: "__other_" + c for c in fill})
    return (
        spread(preferred)
        .join(right, [*keys, "__spread"], "full")
        .withColumns({c: F.coalesce(c, "__other_" + c) for c in fill})
        .drop("__spread", *["__other_" + c for c in fill])
    )


def membership(df: DataFrame, column: str, members: DataFrame, name: str) -> DataFrame:
    """Three-valued ``column IN (members)`` as a boolean column, from one join.

    TRUE when found; NULL when the value is NULL, or is not found and the set holds a
    NULL; FALSE otherwise.
    """
    source = members.columns[0]
    listed = members.select(F.col(source).alias(_KEY)).filter(F.col(_KEY).isNotNull()).distinct()
    has_null = members.agg(F.coalesce(F.bool_or(F.col(source).isNull()), F.lit(False)).alias("n")).scalar()
    found = df.join(listed, F.col(column) == F.col(_KEY), "left")
    answer = F.when(F.col(_KEY).isNotNull(), True).when(F.col(column).isNull() | has_null, None).otherwise(False)
    return found.withColumn(name, answer).drop(_KEY)


def not_in(df: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """Null-aware ``NOT IN``: only rows for which it is TRUE."""
    return membership(df, column, members, "__in").filter(~F.col("__in")).drop("__in")


def next_step(df: DataFrame, keys: Sequence[str], step: str, columns: Sequence[str], prefix: str) -> DataFrame:
    """Self-join each row to the row of the same keys one step later."""
    later = df.select(*keys, (F.col(step) - 1).alias(step), *[F.col(c).alias(prefix + c) for c in columns])
    return left_lookup(df, later, [*keys, step])
