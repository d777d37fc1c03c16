"""Dimensions: members, their positions, and topics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum import fixed_values as fv
from rostrum.operators.joins import left_lookup
from rostrum.operators.sets import union_tagged

_POSITION = {
    "constituency": ("member_constituency", "is_latest_constituency"),
    "appointment": ("member_appointment", "is_latest_appointment"),
    "select_committee": ("member_committee", "is_latest_committee"),
}


def dim_prep_member_positions(
    member_of_parliament: DataFrame, office_holding: DataFrame, select_committee: DataFrame
) -> DataFrame:
    """All positions of all members as one long table; undated ones are left out."""
    tables = dict(zip(_POSITION, (member_of_parliament, office_holding, select_committee)))
    unioned = union_tagged(tables)
    return unioned.filter("effective_from_date is not null or effective_to_date is not null").select(
        "member_name",
        "type",
        F.coalesce(*[p for p, _ in _POSITION.values()]).alias("member_position"),
        "effective_from_date",
        "effective_to_date",
        F.coalesce(*[f for _, f in _POSITION.values()]).alias("is_latest_position"),
    )


def dim_members(
    attendance: DataFrame,
    gender: DataFrame,
    birth_year: DataFrame,
    ethnicity: DataFrame,
    party: DataFrame,
    full_name: DataFrame,
    image: DataFrame,
    positions: DataFrame,
    parts: int | None = None,
) -> DataFrame:
    """One row per attending member. All inputs shuffle on the member's name once.

    Histories come from a single pass over the positions. Several current
    constituencies of one member give one row each. ``parts``: so many for attendance, which comes together by member before
    anything is grouped; a member's days are few, so combining in the parts that a table is read in would only fill memory.
    """
    attended = attendance.filter("member_name is not null")
    attended = attended if parts is None else attended.repartition(parts, "member_name")
    days = attended.groupBy("member_name", "date").agg(F.bool_or("is_present").alias("present"))
    seen = days.groupBy("member_name").agg(
        F.min("date").alias("earliest_sitting"),
        F.max("date").alias("latest_sitting"),
        F.count_if(F.col("present") & F.col("date").isNotNull()).alias("count_sittings_present"),
        F.count("date").alias("count_sittings_total"),
    )
    parties = party.groupBy("member_name").agg(
        F.array_sort(F.collect_list(F.struct("party", "parliament"))).alias("party")
    )

    def history(kind: str):
        of_kind = F.when(
            F.col("type") == kind, F.struct("effective_from_date", "member_position", "effective_to_date")
        )
        return F.transform(
            F.array_sort(F.collect_list(of_kind)),
            lambda t: F.struct(t["member_position"].alias("member_position"), t["effective_from_date"].alias("effective_from_date"), t["effective_to_date"].alias("effective_to_date")),
        )

    def held_now(kind: str):
        return F.array_sort(
            F.collect_list(F.when((F.col("type") == kind) & F.col("is_latest_position"), F.col("member_position")))
        )

    histories = positions.groupBy("member_name").agg(
        history("constituency").alias("member_constituencies"),
        held_now("constituency").alias("__seats"),
        history("appointment").alias("member_appointments"),
        held_now("appointment").alias("latest_member_appointments"),
        history("select_committee").alias("member_committees"),
        held_now("select_committee").alias("latest_member_committees"),
    )
    lookups = [gender, parties, birth_year, ethnicity, full_name, image, histories]
    wide = reduce(lambda df, d: left_lookup(df, d, ["member_name"]), lookups, seen)

    def filled(column: str):
        return F.when(F.size(column) > 0, F.col(column)).alias(column)

    return wide.select("*", F.explode_outer("__seats").alias("latest_member_constituency")).select(
        "member_name",
        "member_birth_year",
        "member_ethnicity",
        "gender",
        "party",
        filled("member_constituencies"),
        "latest_member_constituency",
        filled("member_appointments"),
        filled("latest_member_appointments"),
        filled("member_committees"),
        filled("latest_member_committees"),
        "earliest_sitting",
        "latest_sitting",
        "count_sittings_present",
        "count_sittings_total",
        "member_name_website",
        "member_image_link",
    )


def dim_topics(topics: DataFrame, topic_types: DataFrame, topic_group: DataFrame, topic_names: DataFrame) -> DataFrame:
    kinds = topic_types.withColumnRenamed("section_type_code", "section_type")
    names = topic_names.select("topic_group_id", "topic_group_name")
    grouped = left_lookup(left_lookup(topics, topic_group, ["topic_id"]), names, ["topic_group_id"])
    constitutional = F.col("section_type").isin(fv.BILL_TYPES) & F.lower("title").contains("constitution")
    return left_lookup(grouped, kinds, ["section_type"]).select(
        "topic_id",
        "date",
        "topic_order",
        "title",
        "section_type",
        "section_type_name",
        "topic_group_id",
        "topic_group_name",
        "topic_group_distribution",
        constitutional.alias("is_topic_constitutional"),
        F.col("section_type").isin(fv.PROCEDURAL_TYPES).alias("is_topic_procedural"),
    )
