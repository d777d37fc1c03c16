"""Monthly aggregates per member."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum import fixed_values as fv
from rostrum.functions.text import contains_any
from rostrum.operators.joins import left_lookup


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("date"), "month": F.month("date")})


def _met_on(sides: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """A full join on ``keys`` of what stands in two columns of the same rows, NULL where a side has nothing.

    Rows with a NULL key match nothing. The rows of a key must be few by their meaning (constituencies of a member's month).
    """
    of_key = Window.partitionBy(*keys)
    both = sides.withColumns({"__lefts": F.count(left).over(of_key), "__rights": F.collect_list(right).over(of_key)})
    no_left, no_right = (F.lit(None).cast(sides.schema[c].dataType) for c in (left, right))
    pair = lambda x, y: F.struct(x.alias(left), y.alias(right))
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    met = F.transform("__rights", lambda y: pair(F.col(left), y))
    met = F.when(complete & (F.size("__rights") > 0), met).otherwise(F.array(pair(F.col(left), no_right)))
    alone = F.array(pair(no_left, F.col(right)))
    none = F.slice(alone, 1, 0)
    met = F.when(F.col(left).isNotNull(), met).otherwise(none)
    alone = F.when(F.col(right).isNotNull() & ~(complete & (F.col("__lefts") > 0)), alone).otherwise(none)
    return both.select(*keys, F.inline(F.concat(met, alone)))


def agg_speech_metrics_by_member(
    speeches: DataFrame, attendance: DataFrame, party: DataFrame, ordered: bool = False, parts: int | None = None
) -> DataFrame:
    """Speech and attendance counts per member and month. ``parts``: so many to bring members' rows together in.

    Speeches and attendance meet on the month, not on the constituency: a member with
    several constituencies in a month has a row for each pair.
    """
    grain = ["parliament", "year", "month", "member_name", "member_constituency"]
    keys = grain[:-1]
    sums = ["count_speeches", "count_words", "count_pri_questions", "count_sentences", "count_syllables"]
    aloud = ~F.col("topic_type").isin(fv.WRITTEN_TYPES)
    # distinct days are bits of their month, distinct topics are groups: no row is expanded to be counted twice
    by_topic = (
        _by_month(speeches)
        .filter(
            (F.col("member_name") != "")
            & ~contains_any(F.lower("member_name"), fv.NON_MEMBER_WORDS)
            & ~F.col("is_topic_procedural")
        )
        .groupBy(*grain, "topic_id")
        .agg(
            F.bit_or(F.when(aloud, F.expr("shiftleft(1L, day(date))"))).alias("days"),
            F.count(F.lit(1)).alias("count_speeches"),
            F.sum("count_speeches_words").alias("count_words"),
            F.count_if("is_primary_question").alias("count_pri_questions"),
            F.sum("count_speeches_sentences").alias("count_sentences"),
            F.sum("count_speeches_syllables").alias("count_syllables"),
        )
    )
    # everything of a member comes together once; grouping, the meeting of both sides and the party then move nothing more
    heard = by_topic.select(
        *grain, F.lit(None).cast("boolean").alias("is_present"),
        F.struct(F.col("topic_id").isNotNull().alias("named"), "days", *sums).alias("topic"),
    )
    none = F.lit(None).cast(heard.schema["topic"].dataType)
    seen = _by_month(attendance).filter("member_name != ''").select(*grain, "is_present", none.alias("topic"))
    by_member = lambda df: df.repartition("member_name") if parts is None else df.repartition(parts, "member_name")
    rows = by_member(seen.unionByName(heard))
    # put in order once, by member and month: sums of a month's rows are told on its first, and nothing is hashed
    order = ["member_name", *keys[:-1]]
    of_grain = Window.partitionBy(*order, "member_constituency")
    counted = rows.withColumn("__id", F.monotonically_increasing_id()).select(
        *grain, "__id", F.min("__id").over(of_grain).alias("__first"),
        F.count_if(F.col("topic").isNull()).over(of_grain).alias("count_sittings_total"),
        F.count_if("is_present").over(of_grain).alias("count_sittings_present"),
        F.count("topic").over(of_grain).alias("n"),
        F.coalesce(F.bit_count(F.bit_or("topic.days").over(of_grain)), F.lit(0)).cast("bigint").alias("count_sittings_spoken"),
        F.count_if("topic.named").over(of_grain).alias("count_topics"),
        *[F.sum(f"topic.{c}").over(of_grain).alias(c) for c in sums],
    ).filter("__id = __first")
    spoken_counts = [
        "count_sittings_spoken", "count_topics", "count_pri_questions", "count_speeches", "count_words",
        "count_sentences", "count_syllables",
    ]
    sat = ["count_sittings_total", "count_sittings_present"]
    sides = counted.select(
        *keys,
        F.when(F.col("count_sittings_total") > 0, F.struct("member_constituency", *sat)).alias("attended"),
        F.when(F.col("n") > 0, F.struct("member_constituency", *spoken_counts)).alias("spoken"),
    )
    parties = by_member(party).groupBy("member_name").agg(F.collect_list(F.struct("parliament", "party")).alias("parties"))
    met = left_lookup(_met_on(sides, order, "attended", "spoken"), parties, ["member_name"])
    of_parliament = F.filter("parties", lambda p: p["parliament"] == F.col("parliament"))
    filled = met.select("*", F.explode_outer(of_parliament).alias("member_of")).select(
        "parliament", "year", "month", "member_name", F.col("member_of.party").alias("member_party"),
        F.coalesce("attended.member_constituency", "spoken.member_constituency").alias("member_constituency"),
        *[f"attended.{c}" for c in sat],
        *[F.coalesce(f"spoken.{c}", F.lit(0)).alias(c) for c in spoken_counts],
    )
    return filled.orderBy("member_name", "parliament", "year", "month") if ordered else filled


def agg_pri_questions_topics_by_member(speeches: DataFrame, ordered: bool = False) -> DataFrame:
    grain = ["parliament", "year", "month", "member_name", "member_constituency", "ministry_addressed"]
    counted = (
        _by_month(speeches.filter("is_primary_question and ministry_addressed is not null and member_name != ''"))
        .groupBy(*grain)
        .agg(F.count(F.lit(1)).alias("count_pri_questions"))
    )
    return counted.orderBy("member_name", "parliament", "year", "month") if ordered else counted
