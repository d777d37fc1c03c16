"""Operators on dates and validity intervals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.operators.joins import left_lookup

_BUCKETS = {
    "year": lambda d: F.year(d),
    "month": lambda d: F.year(d) * 12 + F.month(d),
    "day": lambda d: F.unix_date(d),
}


def open_end(end: Column, as_of: Column | None) -> Column:
    """An open interval lasts until ``as_of``, today unless the caller fixes it."""
    return F.coalesce(end, F.current_date() if as_of is None else as_of)


def interval_left_join(
    facts: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    as_of: Column | None = None,
    bucket: str = "year",
) -> DataFrame:
    """Facts with the attributes of every interval of the same key that covers their date.

    The equality keys include a calendar bucket: an interval is listed once in each
    bucket it touches, so a pair can meet in one bucket only. A hot key is spread over
    its buckets and a fact is compared with the intervals of its own bucket, not with
    the whole history of the key. Facts without an interval are kept; overlapping
    intervals give one row each.
    """
    keys = list(keys)
    to_bucket = _BUCKETS[bucket]
    attributes = [c for c in intervals.columns if c not in (*keys, start, end)]
    spread = (
        intervals.select(
            *keys, F.col(start).alias("__from"), open_end(F.col(end), as_of).alias("__to"), *attributes
        )
        .filter(F.col("__from") <= F.col("__to"))
        .withColumn("__bucket", F.explode(F.sequence(to_bucket(F.col("__from")), to_bucket(F.col("__to")))))
        .withColumnsRenamed({k: f"__iv_{k}" for k in keys})
    )
    dated = facts.withColumn("__at_bucket", to_bucket(F.col(at)))
    match = (F.col("__at_bucket") == F.col("__bucket")) & F.col(at).between(F.col("__from"), F.col("__to"))
    for k in keys:
        match = match & (F.col(k) == F.col(f"__iv_{k}"))
    return dated.join(spread, match, "left").drop(
        "__at_bucket", "__bucket", "__from", "__to", *[f"__iv_{k}" for k in keys]
    )


def _by_month(intervals: DataFrame, start: str, end: str, as_of: Column | None) -> DataFrame:
    """Intervals listed in each month they touch: ``__month``, and their closed end ``__to``."""
    to_month = _BUCKETS["month"]
    closed = intervals.withColumn("__to", open_end(F.col(end), as_of)).filter(F.col(start) <= F.col("__to"))
    return closed.withColumn("__month", F.explode(F.sequence(to_month(F.col(start)), to_month(F.col("__to")))))


def _on_days(listed: DataFrame, calendar: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """Rows of ``_by_month`` with each calendar date between ``start`` and ``end``, within their month.

    The calendar may be broadcast: cast to dates, it holds at most one row per calendar day, whatever the data size.
    """
    days = calendar.select(F.col(date).cast("date").alias("__day")).distinct()
    days = days.withColumn("__its_month", _BUCKETS["month"](F.col("__day")))
    covered = (F.col("__month") == F.col("__its_month")) & F.col("__day").between(F.col(start), F.col(end))
    return listed.join(F.broadcast(days), covered).withColumnRenamed("__day", date).drop("__its_month", "__month")


def expand_intervals(
    calendar: DataFrame,
    intervals: DataFrame,
    date: str,
    start: str,
    end: str,
    as_of: Column | None = None,
) -> DataFrame:
    """One row per interval and calendar date inside it (a range join without other keys).

    Intervals are listed by month and meet the month's dates; nothing is shuffled.
    """
    return _on_days(_by_month(intervals, start, end, as_of), calendar, date, start, "__to").drop("__to")


def position_segments(
    intervals: DataFrame, keys: Sequence[str], position: str, start: str, end: str, as_of: Column | None = None
) -> DataFrame:
    """What each key holds, as elementary segments: between two changes, within a month, the list of positions stays as it is.

    A sweep over one key's month: starts and days after ends are its change points. One row per segment, with ``__month``,
    ``__from``, ``__to``, ``positions`` (in order) and ``count_positions``. A row of the sweep is bounded by what one key holds
    in one month.
    """
    listed = _by_month(intervals, start, end, as_of)
    first = F.make_date(F.floor((F.col("__month") - 1) / 12).cast("int"), ((F.col("__month") - 1) % 12 + 1).cast("int"), F.lit(1))
    held = F.collect_list(F.struct(F.col(position).alias("p"), F.col(start).alias("f"), F.col("__to").alias("t"))).alias("__held")
    swept = listed.groupBy("__month", *keys).agg(held).withColumn("__first", first).withColumn("__last", F.last_day("__first"))
    changes = F.concat(
        F.array("__first"), F.transform("__held", lambda h: h["f"]), F.transform("__held", lambda h: F.date_add(h["t"], 1))
    )
    inside = F.filter(changes, lambda d: d.between(F.col("__first"), F.col("__last")))
    swept = swept.withColumn("__points", F.array_sort(F.array_distinct(inside)))

    def segment(point: Column, i: Column) -> Column:
        now = F.filter("__held", lambda h: (h["f"] <= point) & (point <= h["t"]))
        names = F.array_sort(F.filter(F.transform(now, lambda h: h["p"]), lambda p: p.isNotNull()))
        until = F.coalesce(F.date_sub(F.get(F.col("__points"), i + 1), 1), F.col("__last"))
        return F.struct(point.alias("__from"), until.alias("__to"), names.alias("positions"), F.size(now).alias("__open"))

    segments = swept.select("__month", *keys, F.inline(F.transform("__points", segment))).filter("__open > 0").drop("__open")
    return segments.withColumn("count_positions", F.size("positions").cast("bigint"))


def positions_held(
    intervals: DataFrame, keys: Sequence[str], position: str, start: str, end: str, as_of: Column | None = None
) -> DataFrame:
    """All that each key ever holds, as one list ``held``; its length is bounded by its meaning, the positions of one person."""
    until = open_end(F.col(end), as_of)
    term = F.struct(F.col(start).alias("f"), until.alias("t"), F.col(position).alias("p"))
    return intervals.filter(F.col(start) <= until).groupBy(*keys).agg(F.collect_list(term).alias("held"))


def positions_on_date(rows: DataFrame, calendar: DataFrame, date: str) -> DataFrame:
    """Rows with a list ``held``, which gives way to the positions held on their date, if that is in the calendar."""
    days = calendar.select(F.col(date).cast("date").alias(date)).distinct().withColumn("__listed", F.lit(True))
    met = left_lookup(rows, F.broadcast(days), [date])
    met = met.withColumn("__now", F.filter("held", lambda h: F.col("__listed") & F.col(date).between(h["f"], h["t"])))
    names = F.array_sort(F.filter(F.transform("__now", lambda h: h["p"]), lambda p: p.isNotNull()))
    met = met.withColumn("positions", F.when(F.size("__now") > 0, names)).drop("held", "__now", "__listed")
    return met.withColumn("count_positions", F.when(F.col("positions").isNotNull(), F.size("positions").cast("bigint")))


def _positions_of_rows(
    rows: DataFrame, calendar: DataFrame, intervals: DataFrame, date: str, keys: Sequence[str], position: str, start: str,
    end: str, as_of: Column | None = None,
) -> DataFrame:
    """``concurrent_positions_by_date`` of given rows: one list per key with all it ever holds, met once, by key.

    Rows that lie by key already aren't moved, and no date is listed for a key that has no row on it. The list is bounded by
    its meaning, the positions of one person.
    """
    held = positions_held(intervals, keys, position, start, end, as_of)
    met = positions_on_date(left_lookup(rows, held, keys), calendar, date)
    return met.select(*rows.columns, "positions", "count_positions")


def concurrent_positions_by_date(
    calendar: DataFrame,
    intervals: DataFrame,
    date: str,
    keys: Sequence[str],
    position: str,
    start: str,
    end: str,
    as_of: Column | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Positions held by each key on each calendar date, with their number.

    Dates meet segments, whose lists are built once, not single positions. With ``rows`` (keys and date among their columns)
    the answer is for these alone: they come back with both columns added, NULL where nothing is held or the date is not in
    the calendar.
    """
    if rows is not None:
        return _positions_of_rows(rows, calendar, intervals, date, keys, position, start, end, as_of)
    segments = position_segments(intervals, keys, position, start, end, as_of)
    found = _on_days(segments, calendar, date, "__from", "__to")
    return found.select(date, *keys, "positions", "count_positions")


def open_count_by_date(
    calendar: DataFrame,
    intervals: DataFrame,
    date: str,
    start: str,
    end: str,
    as_of: Column | None = None,
) -> DataFrame:
    """How many intervals are open on each calendar date.

    Counting needs no pairs: starts and ends are summed by day, and a running total
    over the days (one row per calendar day) gives the level.
    """
    closed = intervals.withColumn("__to", open_end(F.col(end), as_of)).filter(F.col(start) <= F.col("__to"))
    change = F.explode(
        F.array(
            F.struct(F.col(start).cast("date").alias("day"), F.lit(1).alias("step")),
            F.struct(F.date_add("__to", 1).alias("day"), F.lit(-1).alias("step")),
        )
    )
    steps = closed.select(change.alias("c")).groupBy(F.col("c.day").alias("day")).agg(F.sum("c.step").alias("step"))
    days = calendar.select(F.col(date).cast("date").alias("day")).distinct().withColumn("asked", F.lit(True))
    timeline = days.join(steps, "day", "full")
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        timeline.withColumn("count_open", F.sum(F.coalesce("step", F.lit(0))).over(running).cast("bigint"))
        .filter("asked")
        .select(F.col("day").alias(date), "count_open")
    )


def session_dates(
    sittings: DataFrame,
    keys: Sequence[str],
    date: str,
    first_session: Mapping[str, object] | None = None,
    first_start: str | None = None,
) -> DataFrame:
    """First and last date of each session; the newest session has an open end.

    The start of the first session may be set by the caller, for data that begins
    in its middle.
    """
    latest = sittings.agg(F.max(date).alias("latest")).scalar()
    spans = sittings.groupBy(*keys).agg(F.min(date).alias("__first"), F.max(date).alias("__last"))
    start = F.col("__first")
    if first_session:
        is_first = F.lit(True)
        for k, v in first_session.items():
            is_first = is_first & (F.col(k) == v)
        start = F.when(is_first, F.to_date(F.lit(first_start))).otherwise(start)
    return spans.select(
        *keys,
        start.alias("effective_from_date"),
        F.when(F.col("__last") != latest, F.col("__last")).alias("effective_to_date"),
    )


def close_stale_intervals(
    history: DataFrame, key: str, end: str, snapshot: str, close_on: Column, text: str | None = None,
    text_from: str = "Current", text_to: str = "",
) -> DataFrame:
    """Reduce repeated snapshots of a history to one statement per key.

    Keys in the newest snapshot keep only its rows. Keys that left it keep all their
    rows, and intervals still open there are closed on ``close_on``.
    """
    seen = history.agg(
        F.struct(
            F.max(snapshot).alias("newest"),
            F.max(F.when(F.col(key).isNull(), F.col(snapshot))).alias("newest_unnamed"),
        ).alias("s")
    ).scalar()
    latest = history.groupBy(key).agg(F.max(snapshot).alias("__latest"))
    # as with NOT IN: an unnamed row in the newest snapshot leaves absence undecided
    present = (
        F.when(F.col(key).isNull(), None)
        .when(F.col("__latest") == seen["newest"], True)
        .when(seen["newest_unnamed"] == seen["newest"], None)
        .otherwise(False)
    )
    flagged = left_lookup(history, latest, [key]).withColumn("__present", present)
    stale = F.col(end).isNull() & ~F.col("__present")
    changes = {end: F.when(stale, close_on).otherwise(F.col(end))}
    if text:
        changes[text] = F.when(stale, F.replace(F.col(text), F.lit(text_from), F.lit(text_to))).otherwise(F.col(text))
    return (
        flagged.filter(~F.col("__present") | (F.col(snapshot) == seen["newest"]))
        .withColumns(changes)
        .drop("__present", "__latest")
    )


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    bucket: Column,
    offset: int = -1,
    prefix: str = "prev_",
) -> DataFrame:
    """Values of the previous (``offset=-1``) or next (``+1``) row of the same key.

    ``bucket`` must grow with the order columns (their month, say). Rows are compared
    inside a bucket, and the row at its edge takes the edge of the neighbouring bucket,
    so that a hot key is sorted in as many tasks as it has buckets.
    """
    keys, order, values = list(keys), list(order), list(values)
    # one struct is never NULL and takes NULLs inside as equal, so the window and the join share one shuffle and sort
    marked = df.withColumn("__at", F.struct(*keys, bucket.alias("__b")))
    forward = offset > 0
    inside = Window.partitionBy("__at").orderBy(*order)
    step = F.lead if forward else F.lag
    record = F.struct(*values)
    local = marked.withColumn("__near", step(record, 1).over(inside))

    pick = F.min_by if forward else F.max_by
    edges = marked.groupBy("__at").agg(pick(record, F.struct(*order)).alias("__edge"))
    # one row per key and bucket
    across = Window.partitionBy(*[F.col(f"__at.{k}") for k in keys]).orderBy("__at.__b")
    edges = edges.withColumn("__edge", step("__edge", 1).over(across))
    joined = left_lookup(local, edges, ["__at"])
    near = F.coalesce("__near", "__edge")
    return joined.withColumns({prefix + v: near[v] for v in values}).drop("__at", "__near", "__edge")
