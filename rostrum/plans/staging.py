"""Staging: typed, cleaned and de-duplicated source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum import fixed_values as fv
from rostrum.functions.numeric import zero_unless
from rostrum.functions.text import first_case, normalise_role, replace_nbsp, trim_ws
from rostrum.operators.dedupe import flag_current, latest_per_key
from rostrum.operators.joins import canonical_lookup, left_lookup
from rostrum.operators.temporal import close_stale_intervals, session_dates
from rostrum.sources.schemas import STAGED_SHEETS
from rostrum.sources.tables import rename_cast


def _to_canonical(df: DataFrame, name_map: DataFrame) -> DataFrame:
    """Variants of names are kept in a sheet by hand, so it is sent to the rows: else whole texts would move by speaker."""
    return canonical_lookup(df, "member_name", F.broadcast(name_map), "possible_variation", "member_name")


def stg_attendance(raw: DataFrame, name_map: DataFrame, exclusions=tuple(fv.ATTENDANCE_EXCLUSIONS)) -> DataFrame:
    typed = rename_cast(
        raw.filter("member_name is not null"),
        {"date": ("date", "date"), "is_present": ("is_present", "boolean"), "member_name": ("member_name", "string")},
    )
    named = _to_canonical(typed, name_map).filter("member_name != ''")
    for member, first, last in exclusions:
        barred = F.col("date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
        named = named.filter(~(barred & (F.lower("member_name") == member)))
    return named


def stg_sittings(raw: DataFrame) -> DataFrame:
    numbers = {c: (c, "bigint") for c in ("parliament", "session", "volume", "sittings")}
    return rename_cast(raw, numbers | {"date": ("date", "date"), "datetime": ("datetime", "timestamp_ntz")})


def stg_speeches(raw: DataFrame, name_map: DataFrame) -> DataFrame:
    characters = F.col("num_characters").cast("bigint")

    def counted(column: str):
        return zero_unless(characters != 0, F.col(column).cast("bigint"))

    typed = raw.select(
        F.col("speech_id").cast("string"),
        F.col("topic_id").cast("string"),
        F.col("speech_order").cast("bigint"),
        F.col("text").cast("string"),
        counted("num_words").alias("count_words"),
        characters.alias("count_characters"),
        counted("num_sentences").alias("count_sentences"),
        counted("num_syllables").alias("count_syllables"),
        F.col("date").cast("date"),
        normalise_role(F.col("member_name"), F.col("member_name_original")).alias("member_name"),
    )
    return _to_canonical(typed, name_map)


def stg_topics(raw: DataFrame) -> DataFrame:
    return rename_cast(
        raw,
        {
            "topic_id": ("topic_id", "string"),
            "topic_order": ("topic_order", "bigint"),
            "title": ("title", "string"),
            "section_type": ("section_type", "string"),
            "date": ("date", "date"),
        },
    )


def stg_topic_group(raw: DataFrame) -> DataFrame:
    return rename_cast(
        raw,
        {
            "topic_id": ("topic_id", "string"),
            "topic_group_id": ("highest_topic", "bigint"),
            "topic_group_distribution": ("highest_topic_distribution", "double"),
        },
    )


def stg_topic_names(raw: DataFrame) -> DataFrame:
    return rename_cast(
        raw,
        {
            "topic_group_id": ("topic", "bigint"),
            "topic_group_name": ("topic_summary", "string"),
            "topic_group_top_n_words": ("top_n_words", "string"),
        },
    )


def stg_bills_introduced(raw: DataFrame) -> DataFrame:
    corrections = [(F.col("title") == wrong, right) for wrong, right in fv.INTRODUCED_TITLE_EXACT.items()]
    corrections += [(F.col("number") == number, right) for number, right in fv.INTRODUCED_TITLE_BY_NUMBER.items()]
    return raw.select(
        F.col("number").alias("bill_number"),
        F.col("pdf_link").alias("bill_pdf_link"),
        F.col("date_introduced").cast("date").alias("first_reading_date"),
        F.col("date_2nd_reading").cast("date").alias("second_reading_date"),
        F.col("date_passed").cast("date").alias("passed_date"),
        first_case(corrections, F.col("title")).alias("title"),
    )


def stg_sheet(name: str, raw: DataFrame) -> DataFrame:
    """One of the staged spreadsheets, by name."""
    return rename_cast(raw, STAGED_SHEETS[name][1])


def _latest_of(scraped: DataFrame, sheet: DataFrame, value: str, keep_null: bool = False) -> DataFrame:
    both = scraped.unionByName(sheet).select("member_name", value, "accessed_at")
    if not keep_null:
        both = both.filter(F.col(value).isNotNull())
    return latest_per_key(both, ["member_name"], "accessed_at").select("member_name", value)


def stg_members_full_name(raw: DataFrame, sheet: DataFrame) -> DataFrame:
    scraped = raw.select(
        F.col("original").alias("member_name"),
        F.col("converted").alias("member_name_website"),
        F.to_date(F.lit(fv.FULL_NAME_SCRAPED_ON)).alias("accessed_at"),
    )
    return _latest_of(scraped, sheet, "member_name_website")


def stg_members_image(raw: DataFrame, sheet: DataFrame) -> DataFrame:
    scraped = raw.select(
        "member_name", F.col("image_link").alias("member_image_link"), F.col("accessed_at").cast("date")
    )
    return _latest_of(scraped, sheet, "member_image_link", keep_null=True)


def stg_members_year_of_birth(raw: DataFrame, sheet: DataFrame) -> DataFrame:
    scraped = raw.select(
        "member_name",
        F.col("year_of_birth").cast("bigint").alias("member_birth_year"),
        F.col("accessed_at").cast("date"),
    )
    return _latest_of(scraped, sheet, "member_birth_year")


def _closed(raw: DataFrame) -> DataFrame:
    return close_stale_intervals(
        raw, "member_name", "to_date", "accessed_at", F.lit(fv.STALE_CLOSE_DATE),
        text="date_range", text_to="14 April 2025",
    )


def _history(df: DataFrame, source: str, name: str) -> DataFrame:
    return df.select(
        "member_name",
        F.col(source).alias(name),
        F.col("from_date").cast("date").alias("effective_from_date"),
        F.col("to_date").cast("date").alias("effective_to_date"),
        F.col("accessed_at").cast("date"),
        "date_range",
    )


def _distinct_terms(both: DataFrame, position: str) -> DataFrame:
    """One row per term; the latest of equal statements would say the same again."""
    terms = ["member_name", position, "effective_from_date", "effective_to_date"]
    return both.filter(F.col(position).isNotNull()).select(*terms).distinct()


def stg_members_member_of_parliament(raw: DataFrame, sheet: DataFrame, compat: bool = False) -> DataFrame:
    """Constituency history. ``compat`` uses all scrapes as they are, stale ones included."""
    position = "member_constituency"
    terms = _history(raw if compat else _closed(raw), "constituency", position)
    current = F.lower("date_range").contains("current")
    terms = terms.withColumn(
        "effective_to_date", F.when(F.coalesce(current, F.lit(False)), None).otherwise(F.col("effective_to_date"))
    ).drop("date_range")
    both = terms.unionByName(sheet).withColumn(position, trim_ws(replace_nbsp(F.col(position))))
    return flag_current(_distinct_terms(both, position), ["member_name"], "effective_to_date", "is_latest_constituency")


def stg_members_office_holding(raw: DataFrame, sheet: DataFrame) -> DataFrame:
    terms = _history(_closed(raw), "position", "member_appointment").drop("date_range")
    return _distinct_terms(terms.unionByName(sheet), "member_appointment").withColumn(
        "is_latest_appointment", F.col("effective_to_date").isNull()
    )


def stg_members_select_committee(raw: DataFrame, sittings: DataFrame) -> DataFrame:
    seat = ["member_name", "parliament", "session", "committee"]
    roles = (
        raw.groupBy(*seat)
        .agg(F.array_sort(F.collect_set("position")).alias("member_committee_position"))
        .withColumnRenamed("committee", "member_committee")
    )
    spans = session_dates(
        sittings, ["parliament", "session"], "date",
        dict(zip(("parliament", "session"), fv.FIRST_SESSION)), fv.FIRST_SESSION_START,
    ).withColumnsRenamed({"parliament": "p", "session": "s"})
    numbered = roles.withColumns({"p": F.col("parliament").cast("bigint"), "s": F.col("session").cast("bigint")})
    return left_lookup(numbered, spans, ["p", "s"]).drop("p", "s").withColumn(
        "is_latest_committee", F.col("effective_to_date").isNull() & F.col("effective_from_date").isNotNull()
    )
