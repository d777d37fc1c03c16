import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.operators import aggregate, dedupe, joins, lifecycle, quality, ranking, sets, temporal
from rostrum.sources import tables


def test_latest_per_key_settles_ties(table, rows):
    df = table("k string, v string, at date", ("a", "x", "2020-01-01"), ("a", "y", "2020-01-01"), ("a", "z", None), ("b", None, None))
    assert rows(dedupe.latest_per_key(df, ["k"], "at"), "k", "v") == [("a", "y"), ("b", None)]


def test_flag_current_three_ways(table, rows):
    df = table(
        "k string, until date", ("open", None), ("open", "2020-01-01"), ("closed", "2020-01-01"), ("closed", "2021-01-01"),
        ("many", None), ("many", None), (None, "2020-01-01"),
    )
    flags = rows(dedupe.flag_current(df, ["k"], "until", "now"))
    assert ("open", None, True) in flags and ("open", "2020-01-01", False) in flags
    assert ("closed", "2021-01-01", True) in flags and ("closed", "2020-01-01", False) in flags
    assert flags.count(("many", None, None)) == 2 and (None, "2020-01-01", True) in flags


def test_membership_is_three_valued(table, rows):
    df, plain, holed = table("v int", (1,), (2,), (None,)), table("s int", (1,)), table("s int", (1,), (None,))
    assert rows(joins.membership(df, "v", plain, "m")) == [(1, True), (2, False), (None, None)]
    assert rows(joins.membership(df, "v", holed, "m")) == [(1, True), (2, None), (None, None)]
    assert rows(joins.not_in(df, "v", plain)) == [(2,)] and rows(joins.not_in(df, "v", holed)) == []


def test_full_reconcile_keeps_rows_without_key(table, rows):
    a = table("k int, v string, a int", (1, "x", 1), (2, None, 2), (None, "n", 3))
    b = table("k int, v string, b int", (2, "y", 20), (3, "z", 30), (None, "m", 40))
    out = rows(joins.reconcile_full(a, b, ["k"], fill=["v"]), "k", "v", "a", "b")
    assert out == sorted(
        [(1, "x", 1, None), (2, "y", 2, 20), (3, "z", None, 30), (None, "n", 3, None), (None, "m", None, 40)], key=str
    )


def test_full_reconcile_uses_each_side_once(table, rows):
    a = table("k string, v string, a int", *[(None, "n", i) for i in range(50)], ("x", "1", 1))
    b = table("k string, v string, b int", *[(None, "m", i) for i in range(50)], ("x", "2", 2), ("y", "3", 3))
    out = joins.reconcile_full(a, b, ["k"], fill=["v"])
    assert out.count() == 102 and ("x", "1", 1, 2) in rows(out, "k", "v", "a", "b") and ("y", "3", None, 3) in rows(out, "k", "v", "a", "b")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 2


def test_neighbour_shuffles_full_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"), F.lit("text").alias("payload"))
        out = temporal.neighbour(df, ["k"], ["at"], ["at"], F.floor(F.col("at") / 10))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # besides the rows: edges by key and bucket, by key, and by key and bucket again
    assert plan.count("Exchange hashpartitioning") == 4


def test_quartiles_of_one_group_of_continuous_values(spark):
    values = [((i * 7919) % 10_007) / 3.0 for i in range(10_007)]
    got = aggregate.quartiles(spark.createDataFrame([(1, v) for v in values], "k int, v double"), ["k"], "v").first()
    assert [got.q1, got.median, got.q3] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]))


@pytest.mark.parametrize("small, pieces", [(3, 4), (1, 2), (50, 200)])
def test_broad_slices_are_cut_until_they_are_small(spark, monkeypatch, small, pieces):
    """Only small pieces, or single values, are ever put in order; the values don't depend on how they are cut."""
    kept = []

    def spied(df):
        kept.append(tables.kept_aside(df))
        return kept[-1]

    monkeypatch.setattr(aggregate, "SMALL", small)
    monkeypatch.setattr(aggregate, "_PIECES", pieces)
    monkeypatch.setattr(aggregate, "_SKETCH_ACCURACY", 20)
    monkeypatch.setattr(aggregate, "_MARGIN", 0.1)
    monkeypatch.setattr(aggregate, "kept_aside", spied)
    rng = np.random.default_rng(8)
    groups = {"wide": rng.normal(0, 1, 2000), "ties": np.repeat([1.0, 2.0, 2.5], [900, 50, 1000]), None: rng.integers(0, 9, 300) / 2.0}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, v double")
    got = aggregate.quartiles(df, ["k"], "v").collect()
    assert {r["k"] for r in got} == set(groups)
    for r in got:
        assert [r.q1, r.median, r.q3] == pytest.approx(list(np.quantile(groups[r["k"]], [0.25, 0.5, 0.75])), rel=1e-12)
    assert len(kept) > 1 and kept[-1].filter(f"__n > {small} and __lo < __hi").isEmpty()


def _random_intervals(seed):
    rng, first = random.Random(seed), date(2018, 1, 1)
    spans, facts = [], []
    for i in range(120):
        start = first + timedelta(rng.randrange(900))
        end = None if rng.random() < 0.1 else start + timedelta(rng.randrange(-5, 500))
        spans.append((rng.choice("abc"), i, start, end))
        facts.append((rng.choice("abcd"), first + timedelta(rng.randrange(1200))))
    spans.append(("a", 999, None, date(2019, 1, 1)))
    return spans, facts + [(None, first), ("a", None)]


@pytest.mark.parametrize("bucket", ["day", "month", "year"])
def test_interval_join_equals_brute_force(spark, rows, bucket):
    spans, facts = _random_intervals(1)
    as_of = date(2020, 6, 1)
    out = temporal.interval_left_join(
        spark.createDataFrame(facts, "k string, at date"), spark.createDataFrame(spans, "k string, i int, f date, t date"),
        ["k"], "at", "f", "t", F.lit(as_of), bucket,
    )
    want = []
    for k, at in facts:
        hits = [i for kk, i, f, t in spans if k == kk and at and f and f <= at <= (t or as_of)]
        want += [(k, str(at) if at else None, i) for i in hits or [None]]
    assert rows(out) == sorted(want, key=str)


def test_expanded_intervals_and_open_counts_equal_brute_force(spark, rows):
    spans, facts = _random_intervals(2)
    as_of, days = date(2020, 6, 1), sorted({at for _, at in facts if at})
    calendar = spark.createDataFrame([(x,) for x in days * 2], "day date")
    intervals = spark.createDataFrame(spans, "k string, i int, f date, t date")
    pairs = [(str(x), i) for x in days for _, i, f, t in spans if f and f <= x <= (t or as_of)]
    out = temporal.expand_intervals(calendar, intervals, "day", "f", "t", F.lit(as_of))
    assert rows(out, "day", "i") == sorted(pairs, key=str)
    counted = temporal.open_count_by_date(calendar, intervals, "day", "f", "t", F.lit(as_of))
    assert rows(counted) == sorted([(str(x), sum(p[0] == str(x) for p in pairs)) for x in days], key=str)


@pytest.mark.parametrize("offset", [-1, 1])
def test_neighbour_crosses_buckets(spark, rows, offset):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.4 else rng.choice("ab"), rng.randrange(1000), i) for i in range(200)]
    df = spark.createDataFrame(data, "k string, at int, i int")
    out = temporal.neighbour(df, ["k"], ["at", "i"], ["i"], F.floor(F.col("at") / 100), offset, "near_")
    want = []
    for k in ("hot", "a", "b"):
        line = sorted((at, i) for kk, at, i in data if kk == k)
        for n, (_, i) in enumerate(line):
            j = n + offset
            want.append((i, line[j][1] if 0 <= j < len(line) else None))
    assert rows(out, "i", "near_i") == sorted(want, key=str)


def test_quartiles_are_exact(spark):
    rng = np.random.default_rng(4)
    groups = {"hot": rng.lognormal(0, 3, 5000), "same": np.full(50, 7.0), "one": np.array([3.0]), "two": np.array([1.0, 2.0])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs] + [("hot", None)], "k string, v double")
    for r in aggregate.quartiles(df, ["k"], "v").collect():
        values = groups[r["k"]]
        assert r["n"] == len(values)
        got = [r[c] for c in ("min", "q1", "median", "q3", "max")]
        assert got == pytest.approx(list(np.quantile(values, [0, 0.25, 0.5, 0.75, 1])), rel=1e-12)


def test_all_level_keeps_null_groups_apart(table, rows):
    df = table("who string, parl int, seat string", ("a", 12, "x"), ("a", 13, None), ("a", 13, "x"))
    out = aggregate.with_all_level(df, ["who", "parl", "seat"], ["parl", "seat"], {"n": F.count("*")})
    assert rows(out) == sorted([("a", "12", "x", 1), ("a", "13", None, 1), ("a", "13", "x", 1), ("a", "All", "All", 3)], key=str)


def test_tied_categories_leave_no_secondary(table, rows):
    df = table("t int, m string", (1, "Law"), (1, "Health"), (2, "Law"), (2, "Law"), (2, "Health"), (2, None), (3, None))
    out = ranking.primary_secondary(ranking.rank_categories(df, ["t"], "m"), ["t"], "m")
    assert rows(out) == [(1, "Law", 0.5, None, None), (2, "Law", pytest.approx(2 / 3), "Health", pytest.approx(1 / 3))]


def test_union_of_different_columns(table, rows):
    out = sets.union_tagged({"x": table("a int", (1,)), "y": table("b int", (2,))})
    assert rows(out, "a", "b", "type") == [(1, None, "x"), (None, 2, "y")]


def test_stale_intervals_are_closed(table, rows):
    df = table(
        "who string, until string, seen date", ("gone", None, "2024-01-01"), ("gone", "2020-01-01", "2024-01-01"),
        ("here", None, "2024-01-01"), ("here", None, "2024-06-01"), (None, None, "2024-01-01"),
    )
    out = temporal.close_stale_intervals(df, "who", "until", "seen", F.lit("2025-04-14"))
    assert rows(out) == [
        ("gone", "2020-01-01", "2024-01-01"), ("gone", "2025-04-14", "2024-01-01"), ("here", None, "2024-06-01"),
    ]


def test_sessions(table, rows):
    df = table("p int, s int, d date", (12, 1, "2012-09-10"), (12, 1, "2013-01-01"), (12, 2, "2014-01-01"), (12, 2, "2015-01-01"))
    out = temporal.session_dates(df, ["p", "s"], "d", {"p": 12, "s": 1}, "2010-10-10")
    assert rows(out) == [(12, 1, "2010-10-10", "2013-01-01"), (12, 2, "2014-01-01", None)]


def test_bills_across_two_years_are_stitched(table, rows):
    columns = "year int, title string, a_date date, a_topic string, b_date date, b_topic string"
    df = table(
        columns, (2019, "T", "2019-11-01", "t1", None, None), (2020, "T", None, None, "2020-01-05", "t2"),
        (2020, "U", None, None, "2020-03-01", "u"), (2018, "V", "2018-01-01", "v1", "2018-02-01", "v2"),
    )
    out = lifecycle.stitch_across_years(df, "title", "year", ["a", "b"], "a", ["a", "b"])
    assert rows(out) == [
        (2018, "V", "2018-01-01", "v1", "2018-02-01", "v2"), (2019, "T", "2019-11-01", "t1", "2020-01-05", "t2"),
        (2020, "U", None, None, "2020-03-01", "u"),
    ]


def test_checks(table, rows):
    df = table("k int, v int", (1, 0), (1, 5), (None, 9), (None, None))
    checks = [
        quality.not_null("k"), quality.unique("k", severity="warn"), quality.unique_combination("k", "v"),
        quality.accepted_range("v", minimum=0, inclusive=False), quality.expression_is_true("v >= k", where="v != 9"),
    ]
    out = {r["check_name"]: (r["severity"], r["failures"], r["status"]) for r in quality.report(df, checks, "t").collect()}
    assert out == {
        "not_null(k)": ("error", 2, "error"), "unique(k)": ("warn", 1, "warn"), "unique_combination(k, v)": ("error", 0, "pass"),
        "accepted_range(v)": ("error", 1, "error"), "expression_is_true(v >= k)": ("error", 1, "error"),
    }
    assert rows(quality.violations(df, checks[1])) == [(1, 2)]


def test_sheet_is_read_with_declared_types(spark, tmp_path):
    path = tmp_path / "party.csv"
    path.write_text("member_name,party,parliament\nAnn,X,12\nBob,,\n")
    df = tables.read_sheet(spark, str(path), {"member_name": "string", "party": "string", "parliament": "bigint"})
    assert [tuple(r) for r in df.collect()] == [("Ann", "X", 12), ("Bob", None, None)]


def test_tables_and_views_are_kept(spark, tmp_path):
    df = spark.range(3)
    assert tables.materialise(df, "t", "table", str(tmp_path)).count() == 3
    assert tables.materialise(spark.range(2), "t", "table", str(tmp_path)).count() == 2
    tables.materialise(df, "kept_view", "view")
    assert spark.table("kept_view").count() == 3


def test_sheet_cells_may_hold_quotes_and_line_breaks_but_no_wrong_types(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('name,n\n"A ""B"" C, D",1\n"two\nlines",2\n')
    read = lambda: tables.read_sheet(spark, str(path), {"name": "string", "n": "bigint"}).collect()
    assert [tuple(r) for r in read()] == [('A "B" C, D', 1), ("two\nlines", 2)]
    for wrong in ("x,twelve", "x,1,more"):
        path.write_text(f"name,n\n{wrong}\n")
        with pytest.raises(Exception, match="(?i)malformed|failfast"):
            read()


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    tables.write_table(spark.range(5), path)
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.write_table(bad, path)
    assert tables.read_table(spark, path).count() == 5
    assert len(list((tmp_path / "t").glob("v-*"))) == 1


def test_readers_of_the_version_before_can_finish(spark, tmp_path):
    path = str(tmp_path / "t")
    versions = [tables.write_table(spark.range(n), path) for n in (1, 2)]
    assert [v.count() for v in versions] == [1, 2]
    tables.write_table(tables.read_table(spark, path).union(spark.range(1)), path)  # a table may be read to replace itself
    assert versions[1].count() == 2 and tables.read_table(spark, path).count() == 3
    assert len(list((tmp_path / "t").glob("v-*"))) == 2


def test_tables_by_month_skip_files(spark, table, tmp_path):
    rows = [(f"20{y}-{m:02d}-{d:02d}", y * m * d) for y in (19, 20) for m in (1, 2, 12) for d in (1, 15)] + [(None, 0)]
    df = table("date date, n int", *rows)
    tables.write_table(df, str(tmp_path / "t"), tables.by_month("date"), ["date"])
    kept = tables.read_table(spark, str(tmp_path / "t"))
    assert kept.count() == len(rows) and len(list((tmp_path / "t").glob("v-*/__year=*/__month=*"))) == 7
    day = tables.on_date(kept, "date", "2020-02-15")
    assert [r.n for r in day.collect()] == [20 * 2 * 15]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__year" in plan and "= 2020)" in plan
    assert len(day.inputFiles()) == len(kept.inputFiles()) and tables.on_date(df, "date", "2020-02-15").count() == 1
