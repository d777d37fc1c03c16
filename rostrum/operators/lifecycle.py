"""Reconstruction of a lifecycle (first, second, third event) from dated events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.operators.joins import next_step
from rostrum.operators.temporal import neighbour


def flagged_events(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column], name: str) -> DataFrame:
    """One row per key and flag that holds for any row of the key.

    Flags are OR-ed before the shuffle, so the texts they are read from stay where
    they are.
    """
    labels = list(flags)
    grouped = df.groupBy(*keys).agg(*[F.bool_or(flags[x]).alias(f"__f{i}") for i, x in enumerate(labels)])
    events = F.array(*[F.when(F.col(f"__f{i}"), F.lit(x)) for i, x in enumerate(labels)])
    return grouped.select(*keys, F.explode(events).alias(name)).filter(F.col(name).isNotNull())


def lifecycle_summary(
    events: DataFrame, keys: Sequence[str], stage: str, date: str, subject: str, stages: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """One row per key with the date and subject of each stage.

    ``stages`` maps an output prefix to (leading character of the stage, 'first' or
    'last'). Among events of one date the smallest subject is the first and the
    greatest the last.
    """
    measures = []
    for prefix, (mark, which) in stages.items():
        at_stage = F.left(F.col(stage), F.lit(1)) == mark
        when = F.when(at_stage & F.col(date).isNotNull(), F.struct(date, subject))
        by = F.min if which == "first" else F.max
        measures += [
            by(when)[date].alias(f"{prefix}_date"),
            by(when)[subject].alias(f"{prefix}_topic"),
        ]
    return events.groupBy(*keys).agg(*measures)


def stitch_across_years(
    summary: DataFrame, subject: str, year: str, prefixes: Sequence[str], start: str, complete_when: Sequence[str]
) -> DataFrame:
    """Fill the gaps of incomplete rows from the next year's incomplete row.

    A row whose predecessor (same subject, among incomplete rows) holds the start of
    the lifecycle has been used to fill that one, and is dropped.
    """
    columns = [f"{p}_{part}" for p in prefixes for part in ("date", "topic")]
    is_complete = F.lit(True)
    for p in complete_when:
        is_complete = is_complete & F.col(f"{p}_date").isNotNull()

    incomplete = summary.filter(~is_complete).select(year, subject, *columns)
    started = neighbour(
        incomplete, [subject], [year], [f"{start}_date"], bucket=F.floor(F.col(year) / 10), prefix="__before_"
    )
    filled = (
        next_step(started, [subject], year, columns, "__next_")
        .filter(F.col(f"__before_{start}_date").isNull())
        .select(year, subject, *[F.coalesce(c, f"__next_{c}").alias(c) for c in columns])
    )
    return filled.unionByName(summary.filter(is_complete).select(year, subject, *columns))
