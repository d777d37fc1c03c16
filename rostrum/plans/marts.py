"""Marts: speeches, attendance and bills joined with all their dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum import fixed_values as fv
from rostrum.functions import text as tx
from rostrum.operators.joins import left_lookup, reconcile_full
from rostrum.operators.lifecycle import lifecycle_summary, stitch_across_years
from rostrum.operators.ranking import primary_secondary, rank_categories
from rostrum.operators.sets import replace_column
from rostrum.operators.temporal import concurrent_positions_by_date, open_end, positions_held, positions_on_date
from rostrum.plans.facts import worded_speeches
from rostrum.sources.tables import on_date


def _seats(positions: DataFrame) -> DataFrame:
    return positions.filter("type = 'constituency'").select(
        "member_name", F.col("member_position").alias("constituency"), "effective_from_date", "effective_to_date"
    )


def _offices(positions: DataFrame) -> DataFrame:
    return positions.filter("type = 'appointment' and member_name is not null").select(
        "member_name", "member_position", "effective_from_date", "effective_to_date"
    )


_APPOINTED = {"positions": "appointments", "count_positions": "count_concurrent_appointments"}


def mart_prep_appointment_by_date(
    sittings: DataFrame, positions: DataFrame, as_of: Column | None = None, rows: DataFrame | None = None
) -> DataFrame:
    """Appointments held on each sitting date; with ``rows`` (member_name, date) added to these, instead of for all dates."""
    return concurrent_positions_by_date(
        sittings, _offices(positions), "date", ["member_name"], "member_position", "effective_from_date", "effective_to_date", as_of, rows
    ).withColumnsRenamed(_APPOINTED)


def mart_prep_bill_activity(activity: DataFrame) -> DataFrame:
    events = activity.withColumns(
        {"year": F.year("date"), "title": F.replace(tx.trim_ws(F.col("title")), F.lit("."), F.lit(""))}
    )
    stages = {"first_reading": ("1", "first"), "second_reading": ("2", "first"), "third_reading": ("3", "last")}
    summary = lifecycle_summary(events, ["year", "title"], "reading", "date", "topic_id", stages)
    stitched = stitch_across_years(
        summary, "title", "year", list(stages), "first_reading", ["first_reading", "second_reading"]
    )
    numbered = F.regexp_replace("title", r"(No)\s(\d)", "$1. $2")
    return replace_column(stitched, "title", numbered)


def member_histories(members: DataFrame, party: DataFrame, positions: DataFrame, as_of: Column | None = None) -> DataFrame:
    """All that is known of a member over time, in one row: ``people``, ``parties`` by parliament, ``seats`` and offices ``held``.

    The lists are bounded by what they mean: the party of each parliament, the seats and the offices of one person.
    """
    people = members.groupBy("member_name").agg(F.collect_list(F.struct("gender", "member_ethnicity")).alias("people"))
    parties = party.groupBy("member_name").agg(F.collect_list(F.struct("parliament", "party")).alias("parties"))
    until = open_end(F.col("effective_to_date"), as_of).alias("until")
    seat = F.struct(F.col("effective_from_date").alias("since"), until, "constituency")
    seats = _seats(positions).groupBy("member_name").agg(F.collect_list(seat).alias("seats"))
    held = positions_held(_offices(positions), ["member_name"], "member_position", "effective_from_date", "effective_to_date", as_of)
    known = people.join(parties, "member_name", "full").join(seats, "member_name", "full").join(held, "member_name", "full")
    return known.filter("member_name is not null")


def with_history(rows: DataFrame, histories: DataFrame, *lists: str) -> DataFrame:
    """``rows`` (member_name, date, parliament) with gender, member_ethnicity, party and constituency, by one join.

    Several of them on a date give a row each; what a member lacks is NULL. ``lists`` of the histories come along as they are.
    """
    met = left_lookup(rows, histories, ["member_name"])
    of_parliament = F.filter("parties", lambda p: p["parliament"] == F.col("parliament"))
    of_date = F.filter("seats", lambda s: F.col("date").between(s["since"], s["until"]))
    met = met.select("*", F.explode_outer("people").alias("__person")).select("*", F.explode_outer(of_parliament).alias("__party"))
    met = met.select("*", F.explode_outer(of_date).alias("__seat"))
    return met.select(
        *rows.columns, "__person.gender", "__person.member_ethnicity", F.col("__party.party").alias("party"),
        F.col("__seat.constituency").alias("constituency"), *lists,
    )


def mart_attendance(
    attendance: DataFrame,
    sittings: DataFrame,
    members: DataFrame,
    party: DataFrame,
    positions: DataFrame,
    as_of: Column | None = None,
    histories: DataFrame | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Attendance with the sitting and the member; its rows move once, by member, into ``parts`` if that is given.

    The calendar may be broadcast: it is one row per calendar day, whatever the data size. A member has a row a day at most.
    """
    calendar = sittings.groupBy(F.col("date").cast("date").alias("date")).agg(F.collect_list(F.struct("parliament", "session")).alias("__sat"))
    dated = left_lookup(attendance, F.broadcast(calendar), ["date"]).select(*attendance.columns, F.inline_outer("__sat"))
    dated = dated if parts is None else dated.repartition(parts, "member_name")
    seated = with_history(dated, member_histories(members, party, positions, as_of) if histories is None else histories)
    return seated.select(
        "date",
        "parliament",
        "session",
        "member_name",
        F.col("gender").alias("member_gender"),
        "member_ethnicity",
        F.col("constituency").alias("member_constituency"),
        "party",
        "is_present",
    )


_SPOKEN = ["member_name", "date", "parliament"]


def _top_two(ranked: DataFrame) -> DataFrame:
    return primary_secondary(ranked, ["topic_id"], "ministry_addressed").withColumnsRenamed(
        {
            "primary": "ministry_addressed_primary",
            "primary_share": "ministry_proportion_primary",
            "secondary": "ministry_addressed_secondary",
            "secondary_share": "ministry_proportion_secondary",
        }
    )


def topic_ministries(speeches: DataFrame, topics: DataFrame, histories: DataFrame) -> DataFrame:
    """Per topic the two ministries asked most, with their share of its questions.

    ``speeches`` are ``worded_speeches``; texts aren't read. A question counts once per row of its speaker on that day, as in
    the mart itself.
    """
    labels = (
        speeches.filter("(asks or stood) and ministry is not null")
        .groupBy("topic_id", "stood", F.col("ministry").alias("ministry_addressed"), *_SPOKEN)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    labels = with_history(labels, histories).select("topic_id", "stood", "ministry_addressed", "n")
    typed = left_lookup(labels, topics.select("topic_id", "section_type"), ["topic_id"])
    questions = typed.filter(F.col("stood") | F.col("section_type").isin(fv.PRIMARY_QUESTION_TYPES))
    return _top_two(rank_categories(questions, ["topic_id"], "ministry_addressed", weight="n"))


def member_days(
    dated_speeches: DataFrame,
    members: DataFrame,
    party: DataFrame,
    positions: DataFrame,
    sittings: DataFrame,
    appointments: DataFrame | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """What is known of each speaker on each day they spoke.

    ``appointments`` by date are told for these days alone, unless they are given.

    One row per (member, date, parliament), so a member who made a third of all
    speeches has as many rows as days, and no member attribute is ever joined to the
    texts themselves.
    """
    days = dated_speeches.select("member_name", "date", "parliament").filter("member_name is not null").distinct()
    seated = with_history(days, member_histories(members, party, positions, as_of))
    if appointments is None:
        return mart_prep_appointment_by_date(sittings, positions, as_of, seated)
    return left_lookup(seated, appointments, ["member_name", "date"])


_SAT = ["date", "parliament", "session", "volume", "sittings"]


def topics_told(speeches: DataFrame, topics: DataFrame, sittings: DataFrame, histories: DataFrame) -> DataFrame:
    """What the mart tells of a topic, with the ministries asked most; ``speeches`` are ``worded_speeches``."""
    about = topics.select(
        "topic_id", "title", "section_type", "section_type_name", "is_topic_constitutional", "is_topic_procedural"
    )
    dated = left_lookup(speeches, sittings.select(*_SAT), ["date"])
    return left_lookup(about, topic_ministries(dated, topics, histories), ["topic_id"])


def _met_by_month(told: DataFrame, texts: DataFrame, date: Column, parts: int, shares: int) -> DataFrame:
    """``told`` (row_id, __date) joined with ``texts`` by row_id, where rows of a month come together in few of ``parts``.

    Each row moves once. Both sides are one table meanwhile, in which a text stands beside the rows that tell of it. Months are
    dealt in ``shares``; rows without a date are a month of their own.
    """

    def dealt(side: DataFrame, day: Column, name: str, columns: list[str]) -> DataFrame:
        month = F.coalesce(F.year(day) * 12 + F.month(day), F.lit(-1)).cast("bigint")
        share = (month * shares + F.pmod("row_id", F.lit(shares))).alias("__share")
        return side.select(share, "row_id", F.struct(*columns).alias(name))

    short = dealt(told, F.col("__date"), "__told", [c for c in told.columns if c not in ("row_id", "__date")])
    whole = dealt(texts, date, "__text", [c for c in texts.columns if c != "row_id"])
    both = short.unionByName(whole, allowMissingColumns=True).repartition(parts, "__share")
    beside = Window.partitionBy("__share", "row_id")  # one text and the few rows that tell of it
    both = both.withColumn("__text", F.first("__text", ignorenulls=True).over(beside))
    return both.filter("__told is not null and __text is not null").select("row_id", "__told.*", "__text.*")


def _told_by_row(
    dated: DataFrame, about: DataFrame, histories: DataFrame, sittings: DataFrame, appointments: DataFrame | None, texts: DataFrame,
    by_month: tuple[int, int] | None = None,
) -> DataFrame:
    """Speeches with all that is told of their speaker and topic, met by ``texts`` last.

    Only what is needed for looking up moves to the members, by one join, whose hot keys adaptive execution can split; the other
    columns stay with ``texts``.
    """
    beside = [c for c in texts.columns if c in dated.columns and c not in ("row_id", "topic_id", *_SPOKEN)]
    told = with_history(dated.drop(*beside), histories, "held")
    if appointments is None:
        told = positions_on_date(told, sittings, "date").withColumnsRenamed(_APPOINTED)
    else:
        told = left_lookup(told.drop("held"), appointments, ["member_name", "date"])
    told = left_lookup(told, about, ["topic_id"])
    if by_month is not None:
        told = told.withColumn("__date", F.col("date"))
    told = told.drop(*[c for c in texts.columns if c != "row_id"])
    return told.join(texts, "row_id") if by_month is None else _met_by_month(told, texts, F.col("date"), *by_month)


def mart_speeches(
    speeches: DataFrame,
    topics: DataFrame,
    sittings: DataFrame,
    members: DataFrame,
    party: DataFrame,
    positions: DataFrame,
    appointments: DataFrame | None = None,
    as_of: Column | None = None,
    compat: bool = False,
    texts: DataFrame | None = None,
    histories: DataFrame | None = None,
    about: DataFrame | None = None,
    by_month: tuple[int, int] | None = None,
) -> DataFrame:
    """Speeches with everything known about their topic, sitting and speaker.

    With ``texts`` (row_id, text, and any other columns of the speeches) the speeches are ``worded_speeches`` under stored row
    ids, without texts: all joins move short rows, and texts come in last by row id, moved once. Without it speeches carry their
    texts along. ``histories`` (``member_histories``) and ``about`` (``topics_told``) may be given if they are stored.
    ``by_month``: into how many parts rows come when they meet their texts, each month in how many shares.
    ``compat`` repeats the constitutional flag as the procedural one.
    """
    worded = worded_speeches(speeches) if texts is None else speeches
    dated = left_lookup(worded, sittings.select(*_SAT), ["date"])
    histories = member_histories(members, party, positions, as_of) if histories is None else histories
    about = topics_told(worded, topics, sittings, histories) if about is None else about
    if texts is None:
        speakers = member_days(dated, members, party, positions, sittings, appointments, as_of)
        enriched = left_lookup(
            left_lookup(dated, about, ["topic_id"]),
            speakers,
            ["member_name", "date", "parliament"],
            null_safe=["date", "parliament"],
        )
    else:
        enriched = _told_by_row(dated, about, histories, sittings, appointments, texts, by_month)
    asked = F.col("section_type").isin(fv.PRIMARY_QUESTION_TYPES) & F.col("asks")
    enriched = enriched.withColumn("is_primary_question", F.coalesce(asked | F.col("stood"), F.lit(False)))
    enriched = enriched.withColumn("ministry_addressed", F.when(F.col("is_primary_question"), F.col("ministry")))
    procedural = "is_topic_constitutional" if compat else "is_topic_procedural"
    seat = F.when(F.col("party") == fv.NOMINATED_PARTY, fv.NOMINATED_SEAT).otherwise(F.col("constituency"))
    return enriched.select(
        "date",
        "speech_id",
        "topic_id",
        "parliament",
        "session",
        "volume",
        "sittings",
        "member_name",
        F.col("gender").alias("member_gender"),
        "member_ethnicity",
        F.col("party").alias("member_party"),
        seat.alias("member_constituency"),
        F.col("appointments").alias("member_appointments"),
        F.col("count_concurrent_appointments").alias("member_count_concurrent_appointments"),
        F.col("title").alias("topic_title"),
        F.col("section_type").alias("topic_type"),
        F.col("section_type_name").alias("topic_type_name"),
        "is_topic_constitutional",
        F.col(procedural).alias("is_topic_procedural"),
        F.col("text").alias("speech_text"),
        F.col("count_words").alias("count_speeches_words"),
        F.col("count_characters").alias("count_speeches_characters"),
        F.col("count_sentences").alias("count_speeches_sentences"),
        F.col("count_syllables").alias("count_speeches_syllables"),
        "is_vernacular_speech",
        "vernacular_speech_language",
        "is_primary_question",
        "ministry_addressed",
        "ministry_addressed_primary",
        "ministry_proportion_primary",
        "ministry_addressed_secondary",
        "ministry_proportion_secondary",
    )


def mart_bills(introduced: DataFrame, activity: DataFrame, compat: bool = False) -> DataFrame:
    """Bills of both sources; dates of the introduced list win.

    ``compat`` leaves the year of bills without activity empty and repeats the
    second-to-third difference as the third-to-passed one.
    """
    listed = introduced.withColumn("year", F.year("first_reading_date"))
    active = activity.withColumn("__active_year", F.col("year"))
    bills = reconcile_full(listed, active, ["title", "year"], fill=["first_reading_date", "second_reading_date"])
    third_from = "second_reading_date" if compat else "third_reading_date"
    third_to = "third_reading_date" if compat else "passed_date"
    return bills.select(
        "bill_number",
        F.col("__active_year" if compat else "year").alias("year"),
        "title",
        "first_reading_date",
        "first_reading_topic",
        "second_reading_date",
        "second_reading_topic",
        "third_reading_date",
        "third_reading_topic",
        "passed_date",
        F.datediff("second_reading_date", "first_reading_date").alias("day_diff_first_second_reading"),
        F.datediff("third_reading_date", "second_reading_date").alias("day_diff_second_third_reading"),
        F.datediff(third_to, third_from).alias("day_diff_third_reading_passed"),
        "bill_pdf_link",
    )


def speeches_on_date(mart: DataFrame, date: str) -> DataFrame:
    """The extract of one day: its speeches in order of their identifier."""
    return (
        on_date(mart, "date", date)
        .select("speech_id", "member_name", "member_party", "speech_text", "count_speeches_words", "topic_title")
        .orderBy("speech_id")
    )
