"""Facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum import fixed_values as fv
from rostrum.functions import text as tx
from rostrum.functions.text import canonicalise, contains_any, contains_ci, extract_or_null
from rostrum.operators.lifecycle import flagged_events
from rostrum.operators.sets import computed_once


def fact_attendance(attendance: DataFrame) -> DataFrame:
    return attendance.select("date", "member_name", "is_present")


def fact_sittings(sittings: DataFrame) -> DataFrame:
    return sittings.select("date", "datetime", "parliament", "session", "volume", "sittings")


def fact_speeches(speeches: DataFrame) -> DataFrame:
    """Speeches with the vernacular flag and language."""
    vernacular = contains_ci(F.col("text"), fv.VERNACULAR_MARK)
    language = extract_or_null(F.lower("text"), fv.VERNACULAR_LANGUAGE_PATTERN)
    return speeches.select(
        "speech_id",
        "date",
        "topic_id",
        "speech_order",
        "member_name",
        "text",
        "count_words",
        "count_characters",
        "count_sentences",
        "count_syllables",
        vernacular.alias("is_vernacular_speech"),
        F.when(vernacular, language).alias("vernacular_speech_language"),
    )


def worded_speeches(speeches: DataFrame) -> DataFrame:
    """Speeches with what later models want to know of their texts, as short columns.

    ``asks`` a minister, ``stood`` in another member's name, and the ``ministry`` addressed where either holds.
    """
    asks, stood = tx.asks_a_minister(F.col("text")), tx.stood_in_name(F.col("text"))
    told = computed_once(speeches, asks=asks, stood=stood)
    told = computed_once(told, words=F.when(F.col("asks") | F.col("stood"), tx.extract_minister_for(F.col("text"))))
    return told.withColumn("ministry", tx.ministry_of(F.col("words"))).drop("words")


def fact_bills_introduced(bills: DataFrame) -> DataFrame:
    return bills.select(
        "bill_number", "title", "first_reading_date", "second_reading_date", "passed_date", "bill_pdf_link"
    )


def reading_events(topics: DataFrame, speeches: DataFrame) -> DataFrame:
    """First readings are a topic's type; later ones are told from what was said.

    Texts are tested before any shuffle: only speeches with a hit, as two booleans,
    leave their task, and a topic with very many speeches is combined there as well.
    """
    first, second, third = fv.READINGS
    introduced = topics.filter(F.col("section_type") == fv.BILL_INTRODUCED).select(
        "topic_id", F.lit(first).alias("reading")
    )
    text = F.lower("text")
    said = speeches.select(
        "topic_id",
        contains_any(text, fv.SECOND_READING_WORDS).alias("says_second"),
        contains_any(text, fv.THIRD_READING_WORDS).alias("says_third"),
    ).filter("says_second or says_third")
    flags = {second: F.col("says_second"), third: F.col("says_third")}
    debated = topics.filter(F.col("section_type") == fv.BILL_DEBATED).select("topic_id")
    heard = flagged_events(said, ["topic_id"], flags, "reading").join(debated, "topic_id", "left_semi")
    return introduced.unionByName(heard)


def fact_bill_activity(topics: DataFrame, speeches: DataFrame) -> DataFrame:
    bills = topics.filter(F.col("section_type").isin(fv.BILL_TYPES)).select("topic_id", "title", "date", "section_type")
    title = canonicalise(F.col("title"), fv.BILL_TITLE_EXACT, fv.BILL_TITLE_TRIMMED, fv.BILL_TITLE_PREFIX)
    return (
        reading_events(bills, speeches)
        .join(bills.select("topic_id", "date", "title"), "topic_id", "left")
        .select("date", "topic_id", "reading", title.alias("title"))
    )
