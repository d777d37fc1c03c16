"""The plans on small hand-made tables, one case per semantic trap."""

import datetime

import pytest
from pyspark.sql import functions as F

from rostrum.plans import aggregates, dashboards, dimensions, facts, marts, staging

NO_MAP = ("member_name string, possible_variation string",)


def test_speeches_are_cleaned_and_named(table, rows):
    raw = table(
        "speech_id string, topic_id string, speech_order string, member_name string, member_name_original string, text string, "
        "num_words string, num_characters string, num_sentences string, num_syllables string, date string",
        ("1", "t", "1", "Ann Lee ", "Ann", "x", "5", "0", "1", "2", "2020-01-01"),
        ("2", "t", "2", "A. Lee", "A. Lee", "x", "5", "9", "1", "2", "2020-01-01"),
        ("3", "t", "3", "Mr Speaker", "x", "x", "5", None, "1", "2", "2020-01-01"),
    )
    names = table(*NO_MAP, ("Ann Lee", "A. Lee"))
    out = staging.stg_speeches(raw, names)
    assert rows(out, "speech_id", "member_name", "count_words", "count_characters") == [
        ("1", "Ann Lee", 0, 0), ("2", "Ann Lee", 5, 9), ("3", "Speaker", 0, None),
    ]


def test_attendance_excludes_the_member_who_never_sat(table, rows):
    raw = table(
        "date string, member_name string, is_present string", ("2016-01-15", "Lee Li Lian", "false"),
        ("2020-06-24", "Lee Li Lian", "true"), ("2016-01-15", "", "true"), ("2016-01-15", None, "true"), ("2016-01-15", "Bo", "true"),
    )
    out = staging.stg_attendance(raw, table(*NO_MAP, ("x", "y")))
    assert rows(out) == [("2016-01-15", True, "Bo"), ("2020-06-24", True, "Lee Li Lian")]


def test_bad_casts_raise(table):
    raw = table("topic_id string, topic_order string, title string, section_type string, date string", ("t", "one", "T", "BI", "2020-01-01"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_topics(raw).collect()


def test_bill_titles_are_corrected_by_title_and_number(table, rows):
    ddl = "title string, number string, pdf_link string, date_introduced string, date_2nd_reading string, date_passed string"
    wrong = "Foreign Interference (countermeasures) Bill"
    raw = table(ddl, (wrong, "22/2023", None, None, None, None), ("X", "22/2023", None, None, None, None), ("X ", "1", None, None, None, None))
    assert rows(staging.stg_bills_introduced(raw), "title") == [
        ("Constitution of the Republic of Singapore (Amendment No. 2) Bill",), ("Foreign Interference (Countermeasures) Bill",), ("X ",),
    ]


def test_constituency_history_intended_and_compat(table, rows):
    ddl = "member_name string, constituency string, from_date string, to_date string, date_range string, accessed_at string"
    raw = table(
        ddl, ("gone", "A GRC", "2015-01-01", None, "2015 - Current", "2024-01-01"),
        ("here", "B", "2015-01-01", None, "2015 - Current", "2024-01-01"), ("here", "B", "2015-01-01", None, "2015 - Current", "2024-06-01"),
    )
    sheet = table("member_name string, member_constituency string, effective_from_date date, effective_to_date date, accessed_at date", ("here", " C ", "2011-01-01", "2014-01-01", "2024-01-01"))
    out = rows(staging.stg_members_member_of_parliament(raw, sheet))
    assert out == [("gone", "A GRC", "2015-01-01", "2025-04-14", True), ("here", "B", "2015-01-01", None, True), ("here", "C", "2011-01-01", "2014-01-01", False)]
    assert ("gone", "A GRC", "2015-01-01", None, True) in rows(staging.stg_members_member_of_parliament(raw, sheet, compat=True))


def test_image_keeps_null_of_latest_scrape_and_name_does_not(table, rows):
    raw = table("member_name string, image_link string, accessed_at string", ("a", "old", "2023-01-01"), ("a", None, "2024-01-01"))
    sheet = table("member_name string, member_image_link string, accessed_at date", ("b", "x", "2024-01-01"), ("b", "y", "2024-01-01"))
    assert rows(staging.stg_members_image(raw, sheet)) == [("a", None), ("b", "y")]
    names = table("original string, converted string", ("a", "A"), ("b", None))
    sheet = table("member_name string, member_name_website string, accessed_at date", ("a", None, "2025-01-01"), ("b", "B", "2020-01-01"))
    assert rows(staging.stg_members_full_name(names, sheet)) == [("a", "A"), ("b", "B")]


def test_vernacular_language(table, rows):
    ddl = "speech_id string, date date, topic_id string, speech_order int, member_name string, text string, count_words int, count_characters int, count_sentences int, count_syllables int"
    said = ["(In Malay): [Vernacular Speech]", "VERNACULAR speech", "plain (in malay)"]
    df = table(ddl, *[(str(i), "2020-01-01", "t", 1, "a", s, 1, 1, 1, 1) for i, s in enumerate(said)])
    out = facts.fact_speeches(df)
    assert rows(out, "is_vernacular_speech", "vernacular_speech_language") == [(False, None), (True, "malay"), (True, None)]


@pytest.fixture
def bills(table):
    topics = table(
        "topic_id string, title string, date date, section_type string",
        ("i1", "Statue Law Reform Bill", "2019-11-01", "BI"), ("p1", "Statute Law Reform Bill", "2020-01-05", "BP"),
        ("p2", "Other (Amendment No 2) Bill. \t", "2018-02-01", "BP"), ("i2", "Other (Amendment No 2) Bill", "2018-01-01", "BI"),
        ("o", "Talk", "2020-01-05", "OS"),
    )
    speeches = table(
        "topic_id string, text string", ("p1", "read a SECOND time"), ("p1", "Third reading"), ("p2", "second reading"),
        ("p2", "clause"), ("o", "second reading"), ("i1", "third time"),
    )
    return facts.fact_bill_activity(topics, speeches)


def test_bill_activity(bills, rows):
    assert rows(bills, "topic_id", "reading", "title") == [
        ("i1", "1 First", "Statute Law Reform Bill"), ("i2", "1 First", "Other (Amendment No 2) Bill"),
        ("p1", "2 Second", "Statute Law Reform Bill"), ("p1", "3 Third", "Statute Law Reform Bill"),
        ("p2", "2 Second", "Other (Amendment No 2) Bill."),
    ]


def test_bills_are_stitched_and_reconciled(bills, table, rows):
    activity = marts.mart_prep_bill_activity(bills)
    assert rows(activity, "year", "title", "first_reading_date", "second_reading_date", "third_reading_topic") == [
        (2018, "Other (Amendment No. 2) Bill", "2018-01-01", "2018-02-01", None),
        (2019, "Statute Law Reform Bill", "2019-11-01", "2020-01-05", "p1"),
    ]
    introduced = table(
        "bill_number string, title string, first_reading_date date, second_reading_date date, passed_date date, bill_pdf_link string",
        ("1", "Statute Law Reform Bill", "2019-11-02", None, "2020-01-15", "l"), ("2", "Only Listed Bill", "2017-01-01", None, None, "l"),
        ("3", "No Date Bill", None, None, None, "l"),
    )
    columns = ["bill_number", "year", "first_reading_date", "day_diff_first_second_reading", "day_diff_third_reading_passed"]
    assert rows(marts.mart_bills(introduced, activity), *columns) == [
        ("1", 2019, "2019-11-02", 64, 10), ("2", 2017, "2017-01-01", None, None), ("3", None, None, None, None),
        (None, 2018, "2018-01-01", 31, None),
    ]
    assert rows(marts.mart_bills(introduced, activity, compat=True), *columns) == [
        ("1", 2019, "2019-11-02", 64, 0), ("2", None, "2017-01-01", None, None), ("3", None, None, None, None),
        (None, 2018, "2018-01-01", 31, None),
    ]


@pytest.fixture
def speech_inputs(table):
    q = "Mr A asked the Minister for Law whether"
    return dict(
        speeches=table(
            "speech_id string, date date, topic_id string, member_name string, text string, count_words int, count_characters int, "
            "count_sentences int, count_syllables int, is_vernacular_speech boolean, vernacular_speech_language string",
            ("1", "2017-05-01", "q", "Ann", q, 10, 50, 2, 15, False, None), ("2", "2017-05-01", "q", "Bob", q, 10, 50, 2, 15, False, None),
            ("3", "2017-05-01", "q", "Ann", "asked the Minister for Health", 10, 50, 2, 15, False, None),
            ("4", "2017-05-02", "b", "Ann", "clause", 5, 20, 0, 7, False, None), ("5", "2017-05-01", "b", None, "x", 5, 20, 1, 7, False, None),
            ("6", "2017-05-01", "o", "Bob", "Sir, no.", 5, 20, 1, 7, False, None),
        ),
        topics=table(
            "topic_id string, title string, section_type string, section_type_name string, is_topic_constitutional boolean, "
            "is_topic_procedural boolean",
            ("q", "Q", "OA", "Oral", False, False), ("b", "B", "BI", "Bill Introduced", False, True), ("o", "O", "OS", "Oral", False, False),
        ),
        sittings=table("date date, parliament int, session int, volume int, sittings int", ("2017-05-01", 13, 1, 90, 1)),
        members=table("member_name string, gender string, member_ethnicity string", ("Ann", "F", "x"), ("Bob", "M", "y")),
        party=table("member_name string, party string, parliament int", ("Ann", "NMP", 13)),
        positions=table(
            "member_name string, type string, member_position string, effective_from_date date, effective_to_date date",
            ("Bob", "constituency", "East", "2015-01-01", None), ("Bob", "constituency", "West", "2017-05-01", "2017-05-01"),
            ("Ann", "constituency", "North", "2015-01-01", "2017-05-02"), ("Ann", "appointment", "Speaker", "2015-01-01", None),
        ),
    )


def _mart(spark, inputs, **kw):
    as_of = F.to_date(F.lit("2020-01-01"))
    held = marts.mart_prep_appointment_by_date(inputs["sittings"], inputs["positions"], as_of)
    return marts.mart_speeches(**inputs, appointments=held, as_of=as_of, **kw)


def test_mart_speeches(spark, speech_inputs, rows):
    out = _mart(spark, speech_inputs)
    assert rows(out, "speech_id", "parliament", "member_party", "member_constituency", "is_topic_procedural") == [
        ("1", 13, "NMP", "Nominated Member of Parliament", False), ("2", 13, None, "East", False), ("2", 13, None, "West", False),
        ("3", 13, "NMP", "Nominated Member of Parliament", False), ("4", None, None, "North", True), ("5", 13, None, None, True),
        ("6", 13, None, "East", False), ("6", 13, None, "West", False),
    ]
    ministries = ["ministry_addressed", "ministry_addressed_primary", "ministry_proportion_primary", "ministry_addressed_secondary"]
    asked = out.filter("topic_id = 'q'")
    # the speech of overlapping intervals has two rows and counts twice
    assert rows(asked, *ministries)[0] == ("Health", "Law", pytest.approx(3 / 4), "Health")
    # read as written, the flag repeats another one
    compat = _mart(spark, speech_inputs, compat=True)
    assert rows(compat.filter("topic_id = 'q'"), *ministries)[0][2] == pytest.approx(3 / 4)
    assert rows(compat, "is_topic_procedural") == [(False,)] * 8
    held = {r["speech_id"]: r["member_appointments"] for r in out.collect()}
    assert held["1"] == ["Speaker"] and held["2"] is None


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_move_once(spark, speech_inputs, rows, tmp_path):
    """Texts stored under row ids give the same mart, even if a speech id repeats, by one exchange that carries them."""
    speeches = speech_inputs["speeches"]
    speeches = speeches.union(speeches.filter("speech_id = '6'").withColumn("text", F.lit("other words")))
    lazy = _mart(spark, speech_inputs | {"speeches": speeches})
    facts.worded_speeches(speeches).withColumn("row_id", F.monotonically_increasing_id()).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        late = _mart(spark, speech_inputs | {"speeches": stored.drop("text")}, texts=stored.select("row_id", "text"))
        plan = _plan(late)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shown = [c for c in late.columns if c != "member_appointments"]
    assert late.columns == lazy.columns and rows(late, *shown) == rows(lazy, *shown)
    assert late.filter("speech_text = 'other words'").count() == 2
    reads = [line for line in plan.splitlines() if "FileScan" in line and "text:string" in line]
    assert len(reads) == 1 and "ReadSchema: struct<row_id:bigint,text:string>" in reads[0] or "text" in reads[0]


def test_distinct_counts_expand_no_rows(spark, speech_inputs, table):
    attendance = table("date date, parliament int, member_name string, member_constituency string, is_present boolean", ("2017-05-01", 13, "Bob", "East", True))
    metrics = aggregates.agg_speech_metrics_by_member(_mart(spark, speech_inputs), attendance, speech_inputs["party"])
    assert "Expand" not in _plan(metrics)


def test_days_spoken_are_counted_on_every_day_of_a_month(table, rows):
    speeches = table(
        "date date, parliament int, member_name string, member_constituency string, topic_id string, topic_type string, is_topic_procedural boolean, "
        "is_primary_question boolean, count_speeches_words int, count_speeches_sentences int, count_speeches_syllables int",
        *[(f"2017-05-{d:02d}", 13, "Ann", "East", f"t{d % 2}" if d > 1 else None, "OS", False, d == 3, 2, 1, 3) for d in (1, 2, 3, 31, 31, 30)],
        ("2017-05-04", 13, "Ann", "East", "t0", "WA", False, False, 2, 1, 3), (None, 13, "Ann", "East", "t0", "OS", False, False, 2, 1, 3),
    )
    attendance = table("date date, parliament int, member_name string, member_constituency string, is_present boolean", ("2017-05-01", 13, "Ann", "East", True))
    party = table("member_name string, party string, parliament int", ("Ann", "X", 13))
    out = aggregates.agg_speech_metrics_by_member(speeches, attendance, party)
    got = rows(out.filter("month = 5"), "count_sittings_spoken", "count_topics", "count_speeches", "count_words", "count_pri_questions")
    assert got == [(5, 2, 7, 14, 1)]


def test_extract_of_a_day(spark, speech_inputs, rows):
    out = marts.speeches_on_date(_mart(spark, speech_inputs), "2017-05-02")
    assert rows(out, "speech_id", "topic_title") == [("4", "B")]


def test_metrics_and_dashboards(spark, table, rows, speech_inputs):
    mart = _mart(spark, speech_inputs)
    attendance = table(
        "date date, parliament int, session int, member_name string, member_gender string, member_ethnicity string, "
        "member_constituency string, party string, is_present boolean",
        ("2017-05-01", 13, 1, "Bob", "M", "y", "East", None, True), ("2017-05-08", 13, 1, "Bob", "M", "y", "East", None, False),
        ("2017-05-01", 13, 1, "Cyd", "M", "y", None, None, True),
    )
    party = speech_inputs["party"]
    metrics = aggregates.agg_speech_metrics_by_member(mart, attendance, party)
    got = rows(metrics, "member_name", "member_constituency", "count_sittings_total", "count_pri_questions", "count_speeches")
    # two constituencies of one month meet the one of the attendance; no attendance leaves NULL, no speech leaves 0
    assert got == [
        ("Ann", "Nominated Member of Parliament", None, 2, 2), ("Bob", "East", 2, 1, 2), ("Bob", "East", 2, 1, 2), ("Cyd", None, 1, 0, 0),
    ]
    shown = rows(
        dashboards.dash_by_member_metrics(metrics, mart), "member_name", "parliament", "member_constituency", "questions_per_sitting",
        "words_per_speech", "readability_score", "attendance",
    )
    score = round(206.835 - 1.015 * 5 - 84.6 * 7 / 5, 1)
    # without attendance there is no rate; a presiding member has no score; without a party no attendance rate
    assert shown == [
        ("Ann", "13", "Nominated Member of Parliament", None, 0, None, None), ("Ann", "All", "All", None, 0, None, None),
        ("Bob", "13", "East", 1.0, 15, score, None), ("Bob", "All", "All", 1.0, 15, score, None),
    ]
    assigned = table("speech_id string, topic_assigned string", ("1", "health"), ("3", "health"), ("2", "law"), ("9", "law"))
    assert rows(dashboards.dash_topics(assigned, mart, metrics)) == [
        ("13", "NMP", "Nominated Member of Parliament", "Ann", "health", 2), ("All", "NMP", "All", "Ann", "health", 2),
    ]
    assert rows(dashboards.dash_questions(mart)) == [
        ("Ann", "13", "Nominated Member of Parliament", "NMP", "Health", 1),
        ("Ann", "13", "Nominated Member of Parliament", "NMP", "Law", 1),
        ("Ann", "All", "All", "NMP", "Health", 1), ("Ann", "All", "All", "NMP", "Law", 1),
    ]
    assert dashboards.dash_speech_lengths(mart).count() == 2
    people = table("member_name string, member_ethnicity string, gender string, member_birth_year int", ("Bob", "y", "M", 1970))
    assert rows(dashboards.dash_demographics(people, attendance, party), "member_name", "parliament", "year_age_entered") == [("Bob", 13, 47)]


def test_members_are_one_wide_row(spark, table, rows):
    attendance = table("date date, member_name string, is_present boolean", ("2017-05-01", "Ann", True), ("2017-05-02", "Ann", False), ("2017-05-02", "Ann", False))
    positions = table(
        "member_name string, type string, member_position string, effective_from_date date, effective_to_date date, is_latest_position boolean",
        ("Ann", "constituency", "New", "2016-01-01", None, True), ("Ann", "constituency", "Old", "2011-01-01", "2015-01-01", False),
    )
    single = table("member_name string, v string", ("Ann", "v"))
    out = dimensions.dim_members(
        attendance, single.withColumnRenamed("v", "gender"), single.withColumnRenamed("v", "member_birth_year"),
        single.withColumnRenamed("v", "member_ethnicity"), table("member_name string, party string, parliament int", ("Ann", "X", 13)),
        single.withColumnRenamed("v", "member_name_website"), single.withColumnRenamed("v", "member_image_link"), positions,
    ).first()
    assert (out["count_sittings_present"], out["count_sittings_total"], out["latest_member_constituency"]) == (1, 2, "New")
    assert [t["member_position"] for t in out["member_constituencies"]] == ["Old", "New"]
    assert out["member_appointments"] is None and out["earliest_sitting"] == datetime.date(2017, 5, 1)


def test_sources_are_read_and_all_models_built(spark, tmp_path):
    """The way a user goes: raw tables and sheets in folders, read, built, stored; as the lazily built models."""
    from registry.raw_tables import AS_OF, RawTables
    from rostrum.plans.warehouse import MODELS, RAW_TABLES, Warehouse, read_sources
    from rostrum.sources.schemas import SHEETS
    from rostrum.sources.tables import read_table

    given = RawTables(spark, "/root/testdata/sf0.001")
    for name in RAW_TABLES:
        given[name].coalesce(2).write.parquet(str(tmp_path / "raw" / f"{name}.parquet"))
    for name in SHEETS:
        given[f"sheet_{name}"].coalesce(1).write.option("header", True).option("escape", '"').csv(str(tmp_path / "sheets" / f"{name}.csv"))
    raw = read_sources(spark, str(tmp_path / "raw"), str(tmp_path / "sheets"))
    assert set(raw) == {*RAW_TABLES, *(f"sheet_{s}" for s in SHEETS)}
    house = Warehouse(raw, F.to_date(F.lit(AS_OF)), folder=str(tmp_path / "house"))
    built = house.build_all()
    assert set(built) == set(MODELS)
    lazy = Warehouse(raw, F.to_date(F.lit(AS_OF)))
    for name in ("fact_speeches", "mart_attendance", "mart_bills", "dash_by_member_metrics"):
        assert built[name].columns == getattr(lazy, name).columns
        assert built[name].exceptAll(getattr(lazy, name)).isEmpty() and getattr(lazy, name).exceptAll(built[name]).isEmpty()
    assert read_table(spark, str(tmp_path / "house" / "mart_speeches")).count() == built["mart_speeches"].count() > 0
    assert "__year" in house.laid_out("mart_speeches").columns and "__year" not in built["mart_speeches"].columns
