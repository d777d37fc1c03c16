"""Dashboard tables. Levels called "All" cover every parliament of a member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.functions.numeric import guarded_ratio, percent, round_to_long
from rostrum.functions.text import readability
from rostrum.operators.aggregate import quartiles, with_all_level
from rostrum.operators.joins import left_lookup

ALL = "All"


def _readable_speeches(speeches: DataFrame) -> DataFrame:
    presiding = F.coalesce(F.array_contains("member_appointments", "Speaker"), F.lit(False))
    return speeches.filter(
        ~F.col("is_vernacular_speech")
        & ~F.col("is_primary_question")
        & (F.col("count_speeches_words") > 0)
        & F.col("member_constituency").isNotNull()
        & ~presiding
    ).select(
        "member_name",
        "parliament",
        readability(
            F.col("count_speeches_words"), F.col("count_speeches_sentences"), F.col("count_speeches_syllables")
        ).alias("score"),
    )


def dash_by_member_metrics(metrics: DataFrame, speeches: DataFrame) -> DataFrame:
    """Activity, readability, attendance and participation per member.

    The "All" level of activity covers months with a known constituency only, that of
    participation all months: one pass of grouping sets sums both.
    """
    keys = ["member_name", "parliament", "member_party", "member_constituency"]
    seated = F.col("member_constituency").isNotNull()
    sums = with_all_level(
        metrics.withColumns({"seated": seated, "only_speeches": F.col("count_speeches") - F.col("count_pri_questions")}),
        keys,
        ["parliament", "member_constituency"],
        {
            "questions": F.sum(F.when(F.col("seated"), F.col("count_pri_questions"))),
            "words": F.sum(F.when(F.col("seated"), F.col("count_words"))),
            "spoken_only": F.sum(F.when(F.col("seated"), F.col("only_speeches"))),
            "present_seated": F.sum(F.when(F.col("seated"), F.col("count_sittings_present"))),
            "any_seated": F.bool_or("seated"),
            "total": F.sum("count_sittings_total"),
            "present": F.sum("count_sittings_present"),
            "spoken": F.sum("count_sittings_spoken"),
        },
        ALL,
    ).filter("any_seated")
    scores = with_all_level(
        _readable_speeches(speeches), ["member_name", "parliament"], ["parliament"],
        {"readability_score": F.round(F.avg("score"), 1)}, ALL,
    )
    # rates of attendance are matched by party as well: without one there is none
    comparable = F.col("member_party").isNotNull() & F.col("parliament").isNotNull() & F.col("member_name").isNotNull()
    return left_lookup(sums, scores, ["member_name", "parliament"]).select(
        "member_name",
        "member_party",
        "member_constituency",
        "parliament",
        guarded_ratio(F.col("questions"), F.col("present_seated"), 2).alias("questions_per_sitting"),
        round_to_long(guarded_ratio(F.col("words"), F.col("spoken_only"))).alias("words_per_speech"),
        guarded_ratio(F.col("spoken_only"), F.col("present_seated"), 2).alias("speeches_per_sitting"),
        "readability_score",
        F.when(comparable, percent(F.col("present"), F.col("total"))).alias("attendance"),
        F.when(comparable, percent(F.col("spoken"), F.col("present"))).alias("participation"),
    )


def dash_demographics(members: DataFrame, attendance: DataFrame, party: DataFrame, ordered: bool = False) -> DataFrame:
    """Who sat in each parliament, and their age when they entered it."""
    entered = (
        attendance.filter("member_constituency is not null")
        .groupBy("member_name", "parliament", "member_constituency")
        .agg(F.min("date").alias("first_date"))
    )
    people = members.select("member_name", "member_ethnicity", "gender", "member_birth_year")
    seated = left_lookup(left_lookup(people, entered, ["member_name"]), party, ["member_name", "parliament"])
    out = seated.select(
        "member_name",
        "parliament",
        "party",
        "member_constituency",
        "member_ethnicity",
        "gender",
        "member_birth_year",
        age_at_entry(F.col("first_date"), F.col("member_birth_year")).alias("year_age_entered"),
    )
    return out.orderBy("member_name", "parliament") if ordered else out


def age_at_entry(first_date, birth_year):
    return F.year(first_date) - birth_year


def dash_questions(speeches: DataFrame) -> DataFrame:
    asked = speeches.filter("is_primary_question and member_party is not null and ministry_addressed is not null")
    return with_all_level(
        asked,
        ["member_name", "parliament", "member_constituency", "member_party", "ministry_addressed"],
        ["parliament", "member_constituency"],
        {"count_questions_ministry": F.count(F.lit(1))},
        ALL,
    )


def dash_speech_lengths(speeches: DataFrame) -> DataFrame:
    kind = F.col("topic_type_name")
    return speeches.filter(
        ~kind.contains("Correction by Written Statements")
        & ~kind.contains("Bill Introduced")
        & ~F.col("is_primary_question")
        & (F.col("member_name") != "")
        & (F.col("member_name") != "Speaker")
        & F.col("member_constituency").isNotNull()
    ).select("count_speeches_words")


def dash_topics(assigned: DataFrame, speeches: DataFrame, metrics: DataFrame) -> DataFrame:
    """Speeches per assigned topic; a speech counts once per constituency of its member.

    Speeches are counted per member, party, parliament and topic before the
    constituencies are looked up.
    """
    who = ["member_name", "member_party", "parliament"]
    spoken = assigned.select("speech_id", "topic_assigned").join(speeches.select("speech_id", *who), "speech_id")
    counted = spoken.groupBy(*who, "topic_assigned").agg(F.count(F.lit(1)).alias("n"))
    seats = metrics.select(*who, "member_constituency").filter("member_constituency is not null").distinct()
    return with_all_level(
        counted.join(seats, who),
        ["parliament", "member_party", "member_constituency", "member_name", "topic_assigned"],
        ["parliament", "member_constituency"],
        {"count_topic_speeches": F.sum("n")},
        ALL,
    )


def speech_length_spread(speeches: DataFrame) -> DataFrame:
    """Quartiles of speech lengths by party, as drawn in a box plot."""
    return quartiles(speeches.filter("member_party is not null"), ["member_party"], "count_speeches_words")
