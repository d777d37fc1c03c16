"""Plans whose cost once grew faster than their input."""

import time

import pytest
from pyspark.sql import functions as F

from registry.raw_tables import RawTables
from rostrum import fixed_values as fv
from rostrum.operators.joins import reconcile_full
from rostrum.operators.temporal import concurrent_positions_by_date
from rostrum.plans import aggregates, marts
from rostrum.plans.warehouse import Warehouse
from rostrum.sources import tables


@pytest.fixture
def terms(table):
    return table(
        "who string, seat string, f date, t date",
        ("a", "x", "2020-01-01", "2020-02-10"), ("a", "y", "2020-02-01", None), ("a", "x", "2020-01-01", "2020-02-10"),
        ("a", "z", None, "2020-03-01"), ("b", None, "2020-01-05", "2020-01-05"), ("b", "v", "2020-03-01", "2020-02-01"),
    )


def test_positions_of_given_rows_are_those_by_date(table, terms):
    calendar = table("day date", ("2020-01-01",), ("2020-01-05",), ("2020-02-05",), ("2020-03-01",), ("2020-03-01",), (None,))
    asked = [(w, d) for w in ("a", "b", "c", None) for d in ("2020-01-01", "2020-01-05", "2020-02-05", "2020-02-06", "2020-03-01", None)]
    rows = table("n int, who string, day date", *[(n, *pair) for n, pair in enumerate(asked * 2)])
    given = (calendar, terms, "day", ["who"], "seat", "f", "t", F.to_date(F.lit("2020-12-31")))
    found = concurrent_positions_by_date(*given, rows=rows)
    want = rows.join(concurrent_positions_by_date(*given), ["who", "day"], "left").select(found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert found.schema["count_positions"].dataType == want.schema["count_positions"].dataType
    told = {(r.who, str(r.day)): (r.positions, r.count_positions) for r in found.collect()}
    assert told["a", "2020-02-05"] == (["x", "x", "y"], 3) and told["b", "2020-01-05"] == ([], 0) and told["a", "2020-02-06"] == (None, None)


def test_speakers_get_their_appointments_without_a_table_of_all_dates(table, monkeypatch):
    sittings = table("date date", ("2020-01-01",), ("2020-01-02",))
    positions = table(
        "member_name string, type string, member_position string, effective_from_date date, effective_to_date date",
        ("Ann", "appointment", "Speaker", "2019-01-01", None), ("Ann", "appointment", "Mayor", "2020-01-02", None),
        ("Bob", "appointment", "Mayor", "2020-01-02", "2020-01-02"), ("Bob", "constituency", "East", "2015-01-01", None),
    )
    members = table("member_name string, gender string, member_ethnicity string", ("Ann", "F", "x"), ("Bob", "M", "y"))
    party = table("member_name string, party string, parliament int", ("Ann", "P", 1))
    spoke = table("member_name string, date date, parliament int", *[(m, f"2020-01-0{d}", 1) for m in ("Ann", "Bob", "Cy", None) for d in (1, 2, 3)])
    as_of = F.to_date(F.lit("2021-01-01"))
    held = marts.mart_prep_appointment_by_date(sittings, positions, as_of)
    want = marts.member_days(spoke, members, party, positions, sittings, held, as_of)
    asked = []
    plain = marts.concurrent_positions_by_date
    monkeypatch.setattr(marts, "concurrent_positions_by_date", lambda *a: asked.append(a[-1]) or plain(*a))
    found = marts.member_days(spoke, members, party, positions, sittings, as_of=as_of)
    assert sorted(map(str, found.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert len(asked) == 1 and asked[0] is not None  # for the days of speakers alone


def test_the_stored_mart_needs_no_appointments_of_all_dates(spark, tmp_path):
    house = Warehouse(RawTables(spark, "/root/testdata/sf0.001"), F.to_date(F.lit("2019-08-01")), folder=str(tmp_path / "house"))
    assert house.mart_speeches.filter("member_appointments is not null").count() > 0
    assert "mart_prep_appointment_by_date" not in house._built


def _exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_the_stored_mart_moves_its_rows_twice(spark, tmp_path):
    """Once what is looked up by, to the members; then all columns by row id. Not to topics and to days of speakers as well."""
    house = Warehouse(RawTables(spark, "/root/testdata/sf0.001"), F.to_date(F.lit("2019-08-01")), folder=str(tmp_path / "house"))
    lazy = Warehouse(house.raw, house.as_of)
    found = house.plan("mart_speeches")
    columns = [c for c in found.columns if c != "member_appointments"] + ["array_join(member_appointments, '|')"]
    assert sorted(map(str, found.selectExpr(*columns).collect())) == sorted(map(str, lazy.mart_speeches.selectExpr(*columns).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")  # topics and sittings are below that, members are made to be above
    try:
        joined = house.plan("mart_speeches")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "topic_id" not in "".join(line.partition("hashpartitioning(")[2] for line in _exchanges(joined))
        assert text.count("speech_id") and "parliament" not in "".join(line.partition("hashpartitioning(")[2] for line in _exchanges(joined))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_attendance_comes_together_by_member_in_parts_that_grow(spark, tmp_path, monkeypatch):
    from rostrum.plans import warehouse as w

    monkeypatch.setattr(w, "ROWS", 100)
    house = Warehouse(RawTables(spark, "/root/testdata/sf0.001"), F.to_date(F.lit("2019-08-01")), folder=str(tmp_path / "house"))
    parts = -(-house.fact_attendance.count() // 100)
    assert parts > 8
    for model in ("dim_members", "mart_attendance"):
        assert any(line.partition("hashpartitioning(member_name")[2].partition(", ")[2].startswith(f"{parts})") for line in _exchanges(house.plan(model)))


def test_orders_are_not_dealt_each_time_they_are_read(spark):
    plan = RawTables(spark, "/root/testdata/sf0.001")["sittings"]._jdf.queryExecution().toString()
    assert "RoundRobinPartitioning" not in plan and "REPARTITION_BY_NUM" not in plan


def test_rows_do_not_move_by_name_to_meet_the_sheet_of_names(spark):
    lazy = Warehouse(RawTables(spark, "/root/testdata/sf0.001"), F.to_date(F.lit("2019-08-01")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the sheet is made to be above it
    try:
        for model in ("stg_speeches", "stg_attendance"):
            moved = _exchanges(getattr(lazy, model))
            assert moved and not any("hashpartitioning(member_name" in line for line in moved)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plain_metrics(speeches, attendance, party):
    """The metrics by two groups, a full join on the month and a join with the parties."""
    grain = ["parliament", "year", "month", "member_name", "member_constituency"]
    by_month = lambda df: df.withColumns({"year": F.year("date"), "month": F.month("date")})
    aloud = F.when(~F.col("topic_type").isin(fv.WRITTEN_TYPES), F.col("date"))
    spoken = by_month(speeches.filter("member_name <> '' and not is_topic_procedural")).groupBy(*grain).agg(
        F.count_distinct(aloud).alias("count_sittings_spoken"), F.count_distinct("topic_id").alias("count_topics"),
        F.count_if("is_primary_question").alias("count_pri_questions"), F.count("*").alias("count_speeches"),
        *[F.sum(f"count_speeches_{c}").alias(f"count_{c}") for c in ("words", "sentences", "syllables")],
    )
    attended = by_month(attendance.filter("member_name <> ''")).groupBy(*grain).agg(
        F.count("*").alias("count_sittings_total"), F.count_if("is_present").alias("count_sittings_present")
    )
    both = reconcile_full(attended, spoken, grain[:-1], fill=["member_constituency"])
    return both.na.fill(0, spoken.columns[5:]).join(party.withColumnRenamed("party", "member_party"), ["member_name", "parliament"], "left")


@pytest.fixture
def odd_months(table):
    """Speeches, attendance and parties with NULLs in every key, rows that come twice, and members with several seats and parties."""
    days = ["2020-01-01", "2020-01-02", "2020-02-01", None]
    who = [(d, p, m, c) for d in days for p in (1, None) for m in ("Ann", "Bob", "", None) for c in ("East", "West", None)]
    seen = [(*w, present) for k, w in enumerate(who) for present in ((True, None) if k % 3 else (False, False, True)) if k % 7]
    attendance = table("date date, parliament bigint, member_name string, member_constituency string, is_present boolean", *seen, ("2020-03-01", 1, "Cy", "North", True))
    said = [(*w, topic, kind, topic == "t2", k % 2 == 0, k, None if k % 5 else 2, 1) for k, w in enumerate(who) for topic, kind in (("t0", "OS"), (None, "OS"), ("t1", "WA"), ("t2", "OS")) if k % 4]
    speeches = table(
        "date date, parliament bigint, member_name string, member_constituency string, topic_id string, topic_type string, is_topic_procedural boolean, "
        "is_primary_question boolean, count_speeches_words bigint, count_speeches_sentences bigint, count_speeches_syllables bigint",
        *said, ("2020-04-01", 1, "Di", "South", "t0", "WA", False, None, None, None, None),
    )
    party = table("member_name string, party string, parliament bigint", ("Ann", "X", 1), ("Ann", "Y", 1), ("Bob", None, 1), ("Bob", "Z", 2), ("Cy", "X", None), (None, "X", 1))
    return speeches, attendance, party


def test_metrics_of_odd_months(odd_months):
    found = aggregates.agg_speech_metrics_by_member(*odd_months)
    want = _plain_metrics(*odd_months).select(found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and found.count() > 50
    assert [f.dataType for f in found.schema] == [f.dataType for f in want.schema]


@pytest.mark.parametrize("parts", [None, 3])
def test_months_of_members_move_once(spark, odd_months, parts):
    """To the member, who then has the other side and the party; not to the month, the join and the party each."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = [line.partition("hashpartitioning(")[2] for line in _exchanges(aggregates.agg_speech_metrics_by_member(*odd_months, parts=parts))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [line for line in moved if "month" in line and "topic_id" not in line] == []
    assert sum("member_name" in line and "month" not in line for line in moved) == 2  # all rows, and the parties


def test_shuffle_files_go_when_a_table_is_stored(spark, tmp_path):
    def shuffles():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [found.apply(k).getName() for k in range(found.size())]
        return {name.split("_")[1] for name in names if name.startswith("shuffle_")}

    before, key = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    asked = spark.conf.get(key, None)
    for store in (lambda df: tables.write_table(df, str(tmp_path / "t")), tables.kept_aside):
        store(spark.range(1000).repartition(3, "id"))
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before and spark.conf.get(key, None) == asked


def test_the_stored_mart_meets_its_texts_by_month(spark, tmp_path, monkeypatch):
    """Rows move to their texts and to the layout by month at once; a large month is dealt to several parts."""
    from rostrum.plans import warehouse as w

    raw = RawTables(spark, "/root/testdata/sf0.001")
    undated = raw["speeches"].filter("speech_id like '%7'").withColumns({"date": F.lit(None).cast("string"), "speech_id": F.concat("speech_id", F.lit("-"))})
    raw["speeches"] = raw["speeches"].unionByName(undated)
    lazy = Warehouse(raw, F.to_date(F.lit("2019-08-01")))
    columns = [c for c in lazy.mart_speeches.columns if c != "member_appointments"] + ["array_join(member_appointments, '|')"]
    want = sorted(map(str, lazy.mart_speeches.selectExpr(*columns).collect()))
    assert any("date=None" in row for row in want)
    for most in (250_000, 5):
        monkeypatch.setattr(w, "ROWS", most)
        house = Warehouse(raw, F.to_date(F.lit("2019-08-01")), folder=str(tmp_path / f"house-{most}"))
        assert not any("row_id" in line for line in _exchanges(house.plan("mart_speeches")))
        assert sorted(map(str, house.mart_speeches.selectExpr(*columns).collect())) == want
        months = house.laid_out("mart_speeches").select("__year", "__month").distinct().count()
        files = len(house.mart_speeches.inputFiles())
        assert files == months if most > 5 else months < files <= 20 * months
