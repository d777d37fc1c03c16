"""Ranking of categories within a key.

Every window here runs over counted rows: a key has at most one row per category, so
the rows behind a hot key have been combined before any window sees them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_categories(df: DataFrame, keys: Sequence[str], category: str, weight: str | None = None) -> DataFrame:
    """Count each category per key; rank by count (ties share a rank) and give its share.

    ``weight`` names a column of counts where the rows have been counted already.
    """
    keys = list(keys)
    by_count = Window.partitionBy(*keys).orderBy(F.desc("category_count"))
    counted = (
        df.filter(F.col(category).isNotNull())
        .groupBy(*keys, category)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("category_count"))
    )
    return share_of_partition(
        counted.withColumn("category_rank", F.rank().over(by_count).cast("bigint")),
        keys,
        "category_count",
        "category_share",
    )


def share_of_partition(df: DataFrame, keys: Sequence[str], amount: str, name: str) -> DataFrame:
    """The row's part of its key's total; meant for rows that are already grouped."""
    return df.withColumn(name, F.try_divide(F.col(amount), F.sum(amount).over(Window.partitionBy(*keys))))


def primary_secondary(ranked: DataFrame, keys: Sequence[str], category: str) -> DataFrame:
    """One row per key with the categories of rank 1 and rank 2 and their shares.

    Two categories sharing rank 1 leave no rank 2: the greater name is primary and
    there is no secondary.
    """

    def at(rank: int, column: str, name: str):
        return F.max(F.when(F.col("category_rank") == rank, F.col(column))).alias(name)

    return ranked.filter(F.col("category_rank") <= 2).groupBy(*keys).agg(
        at(1, category, "primary"),
        at(1, "category_share", "primary_share"),
        at(2, category, "secondary"),
        at(2, "category_share", "secondary_share"),
    )
