"""Latest record per key and flags for the current record.

Both are aggregations with partial (map-side) combining. A key that holds a third of
all rows costs one row per map task in the shuffle; a sorted window would pull the
whole key into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.operators.joins import left_lookup


def latest_per_key(df: DataFrame, keys: Sequence[str], *recency: Column | str) -> DataFrame:
    """One row per key: the greatest by ``recency``, ties settled by all other columns.

    A NULL recency counts as oldest. The result does not depend on row order.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(r) if isinstance(r, str) else r for r in recency], *rest)
    if not rest:
        return df.select(*keys).distinct()
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), order).alias("__latest"))
        .select(*keys, "__latest.*")
        .select(*df.columns)
    )


def flag_current(df: DataFrame, keys: Sequence[str], end: str, flag: str) -> DataFrame:
    """Flag the current interval of each key.

    One open interval: it is current. None open: those with the last end are.
    Several open: undecided, NULL.
    """
    keys = list(keys)
    summary = df.groupBy(*keys).agg(
        F.count_if(F.col(end).isNull()).alias("__open"), F.max(end).alias("__last")
    )
    current = F.when(F.col("__open") == 1, F.col(end).isNull()).when(
        F.col("__open") == 0, F.col(end) == F.col("__last")
    )
    return left_lookup(df, summary, keys, null_safe=keys).withColumn(flag, current).drop("__open", "__last")
