"""The operators on the given tables, each with its checking SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry.catalog import dealt, portable, query
from rostrum.functions import numeric as nm
from rostrum.functions import text as tx
from rostrum.operators import aggregate, dedupe, joins, lifecycle, quality, ranking, sets, temporal
from rostrum.plans.dashboards import age_at_entry
from rostrum.sources import tables
from rostrum.sources.tables import load_table, shared_folder

D = F.col


def day(column: str):
    return D(column).cast("date")


# ---------------------------------------------------------------- sources, sinks


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def scan_table(spark, d):
    return load_table(spark, d, "orders").drop("o_orderdate")


@query("""select p_partkey, 'A ' || chr(34) || p_name || chr(34) || ', ' || chr(10) || 'x' as p_name, p_brand, p_size::bigint as p_size,
          p_retailprice from part""")
def scan_csv_with_declared_schema(spark, d):
    """Names with quotes, commas and line breaks are written and read back."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    parts = load_table(spark, d, "part").drop("p_type").withColumn("p_name", F.concat(F.lit('A "'), "p_name", F.lit('", \nx')))
    parts.write.option("header", True).option("escape", '"').csv(path)
    return tables.read_sheet(
        spark, path,
        {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_size": "bigint", "p_retailprice": "double"},
    )


@query("""select o_orderkey, name as priority_name from orders
          left join (values ('1-URGENT', 'now'), ('2-HIGH', 'soon'), ('5-LOW', 'later')) s(code, name)
          on code = o_orderpriority""")
def seed_lookup(spark, d):
    seed = tables.load_seed(
        spark, [("1-URGENT", "now"), ("2-HIGH", "soon"), ("5-LOW", "later")], ["o_orderpriority", "priority_name"]
    )
    orders = load_table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return joins.left_lookup(orders, seed, ["o_orderpriority"]).select("o_orderkey", "priority_name")


@query("select s_suppkey, s_name, s_nationkey::bigint as s_nationkey, s_acctbal from supplier")
def table_sink(spark, d):
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    return portable(tables.write_table(load_table(spark, d, "supplier"), path))


@query("select c_mktsegment, count(*) as n from customer group by 1")
def view_sink(spark, d):
    tables.publish_view(load_table(spark, d, "customer"), "published_customer")
    return spark.sql("select c_mktsegment, count(*) as n from published_customer group by c_mktsegment")


# ---------------------------------------------------------------- projections, predicates


@query("""select event_id, ts::date::varchar as day, user_id::varchar as user_text, event_id::double as id_number,
                 round(value)::bigint as whole_value from events""")
def typed_projection(spark, d):
    return load_table(spark, d, "events").select(
        "event_id", day("ts").cast("string").alias("day"), D("user_id").cast("string").alias("user_text"),
        D("event_id").cast("double").alias("id_number"), nm.round_to_long(D("value")).alias("whole_value"),
    )


@query("""select o_orderkey, o_orderdate::date::varchar as order_day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as order_time
          from orders""")
def date_and_datetime(spark, d):
    return load_table(spark, d, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").cast("string").alias("order_day"),
        F.date_format(D("o_orderdate").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("order_time"),
    )


@query("select r_regionkey::bigint as \"region key\", r_name as \"region name\" from region")
def rename_columns(spark, d):
    return tables.rename_cast(
        load_table(spark, d, "region"), {"region key": ("r_regionkey", "bigint"), "region name": ("r_name", "string")}
    )


@query("select p_partkey, p_brand, p_type, p_size::bigint as p_size, p_retailprice, upper(p_name) as p_name from part")
def replace_one_column(spark, d):
    return portable(sets.replace_column(load_table(spark, d, "part"), "p_name", F.upper("p_name")))


@query("""select o_orderkey, case when o_totalprice >= 400000 then 'large' when o_totalprice >= 200000 then 'medium'
                 when o_orderstatus = 'F' then 'small and done' end as size_band, 'orders' as source_tag from orders""")
def searched_case(spark, d):
    band = F.when(D("o_totalprice") >= 400000, "large").when(D("o_totalprice") >= 200000, "medium").when(
        D("o_orderstatus") == "F", "small and done"
    )
    return load_table(spark, d, "orders").select("o_orderkey", band.alias("size_band"), F.lit("orders").alias("source_tag"))


@query("""select doc_id, case when nullif(lang, 'de') = 'en' then n_chars else 0 end as english_chars from documents""")
def zero_guarded_count(spark, d):
    return load_table(spark, d, "documents").select(
        "doc_id", nm.zero_unless(F.nullif(D("lang"), F.lit("de")) == "en", D("n_chars")).alias("english_chars")
    )


@query("""select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW'), 'none') as mark
          from orders""")
def coalesce_by_priority(spark, d):
    return load_table(spark, d, "orders").select(
        "o_orderkey",
        F.coalesce(
            F.nullif(D("o_orderstatus"), F.lit("P")), F.nullif(D("o_orderpriority"), F.lit("5-LOW")), F.lit("none")
        ).alias("mark"),
    )


@query("""select l_orderkey, l_partkey, l_linenumber::bigint as l_linenumber, l_tax / nullif(l_discount, 0) as tax_per_discount
          from lineitem""")
def nullif_denominator(spark, d):
    return portable(load_table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.try_divide(D("l_tax"), F.nullif(D("l_discount"), F.lit(0.0))).alias("tax_per_discount"),
    ))


@query("""select p_partkey, p_size >= 25 as is_big, p_type in ('SMALL', 'LARGE') and lower(p_name) like '%red%' as is_sized_red,
                 p_retailprice > 1000 as is_dear from part""")
def predicate_columns(spark, d):
    return load_table(spark, d, "part").select(
        "p_partkey", (D("p_size") >= 25).alias("is_big"),
        (D("p_type").isin("SMALL", "LARGE") & F.lower("p_name").contains("red")).alias("is_sized_red"),
        (D("p_retailprice") > 1000).alias("is_dear"),
    )


@query("""select l_returnflag, l_linestatus, count(*) as n from lineitem
          where l_returnflag in ('A', 'N') and not l_linestatus in ('O') group by 1, 2""")
def in_and_not_in_list(spark, d):
    lines = load_table(spark, d, "lineitem").filter(D("l_returnflag").isin("A", "N") & ~D("l_linestatus").isin("O"))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("select p_partkey, p_type from part where p_type like '%M%' and p_type not like 'E%'")
def like_and_not_like(spark, d):
    return load_table(spark, d, "part").select("p_partkey", "p_type").filter(D("p_type").like("%M%") & ~D("p_type").like("E%"))


@query("""select doc_id, lower(text) like '%there%' or lower(text) like '%licen%e%' or lower(text) like '%und%' as hit
          from documents""")
def like_any_of(spark, d):
    return dealt(load_table(spark, d, "documents")).select(
        "doc_id", tx.like_any(F.lower("text"), ["%there%", "%licen%e%", "%und%"]).alias("hit")
    )


@query("""select o_orderkey, nullif(o_orderstatus, 'P') as status, nullif(o_orderpriority, '5-LOW') as priority from orders
          where not (nullif(o_orderstatus, 'P') is null and nullif(o_orderpriority, '5-LOW') is null)
            and not (nullif(o_orderstatus, 'P') = 'F')""")
def three_valued_filter(spark, d):
    marked = load_table(spark, d, "orders").select(
        "o_orderkey", F.nullif(D("o_orderstatus"), F.lit("P")).alias("status"),
        F.nullif(D("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
    )
    return marked.filter(~(D("status").isNull() & D("priority").isNull()) & ~(D("status") == "F"))


@query("""select l_shipdate::date::varchar as ship_day, count(*) as n from lineitem
          where l_shipdate between timestamp '1997-03-01' and timestamp '1998-02-28' group by 1""")
def between_dates(spark, d):
    lines = load_table(spark, d, "lineitem").filter(
        D("l_shipdate").between(F.lit("1997-03-01").cast("timestamp"), F.lit("1998-02-28").cast("timestamp"))
    )
    return lines.groupBy(day("l_shipdate").cast("string").alias("ship_day")).agg(F.count("*").alias("n"))


@query("""select o_orderkey, o_custkey from orders
          where not (o_orderdate between timestamp '1996-01-01' and timestamp '1999-06-30' and o_custkey = 7)""")
def exclusion_rule(spark, d):
    barred = D("o_orderdate").between(F.lit("1996-01-01").cast("timestamp"), F.lit("1999-06-30").cast("timestamp"))
    return load_table(spark, d, "orders").filter(~(barred & (D("o_custkey") == 7))).select("o_orderkey", "o_custkey")


@query("""select c_custkey from customer where not exists (
            select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')""")
def array_membership(spark, d):
    held = load_table(spark, d, "orders").groupBy(D("o_custkey").alias("c_custkey")).agg(
        F.collect_set("o_orderpriority").alias("priorities")
    )
    customers = joins.left_lookup(load_table(spark, d, "customer").select("c_custkey"), held, ["c_custkey"])
    has = F.coalesce(F.array_contains("priorities", "1-URGENT"), F.lit(False))
    return customers.filter(~has).select("c_custkey")


# ---------------------------------------------------------------- joins


@query("""select o_orderpriority, count(*) as n, round(sum(l_extendedprice), 2) as price
          from lineitem join orders on l_orderkey = o_orderkey group by 1""")
def inner_join(spark, d):
    lines = load_table(spark, d, "lineitem").groupBy(D("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n"), F.sum("l_extendedprice").alias("price")
    )
    orders = load_table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return lines.join(orders, "o_orderkey").groupBy("o_orderpriority").agg(
        F.sum("n").alias("n"), F.round(F.sum("price"), 2).alias("price")
    )


@query("""select c_custkey, n_name, r_name from customer left join nation on c_nationkey = n_nationkey
          left join region on n_regionkey = r_regionkey and n_nationkey > 4""")
def left_lookups(spark, d):
    nations = load_table(spark, d, "nation").withColumnsRenamed({"n_nationkey": "c_nationkey"})
    regions = load_table(spark, d, "region").withColumnRenamed("r_regionkey", "near_region")
    known = joins.left_lookup(load_table(spark, d, "customer"), nations, ["c_nationkey"])
    near = known.withColumn("near_region", F.when(D("c_nationkey") > 4, D("n_regionkey")))
    return joins.left_lookup(near, regions, ["near_region"]).select("c_custkey", "n_name", "r_name")


@query("""select coalesce(o.m, e.m) as month_no, coalesce(o.n_orders, 0) as n_orders, e.n_events, coalesce(e.mark, o.mark) as mark
          from (select month(o_orderdate) as m, count(*) as n_orders, 'orders' as mark from orders group by 1) o
          full join (select day(ts) as m, count(*) as n_events, 'events' as mark from events group by 1) e on o.m = e.m""")
def full_join_using(spark, d):
    orders = load_table(spark, d, "orders").groupBy(F.month("o_orderdate").alias("month_no")).agg(
        F.count("*").alias("n_orders"), F.lit("orders").alias("mark")
    )
    events = load_table(spark, d, "events").groupBy(F.day("ts").alias("month_no")).agg(
        F.count("*").alias("n_events"), F.lit("events").alias("mark")
    )
    both = joins.reconcile_full(events, orders, ["month_no"], fill=["mark"])
    return portable(both.withColumn("n_orders", F.coalesce("n_orders", F.lit(0))).select("month_no", "n_orders", "n_events", "mark"))


@query("""select coalesce(k, okey) as order_key, o_custkey, coalesce(price, total) as price, n_lines
          from (select nullif(o_orderkey, 3) as okey, o_custkey, o_totalprice as price from orders where o_orderstatus = 'P') o
          full join (select nullif(l_orderkey, 5) as k, round(sum(l_extendedprice), 2) as total, count(*) as n_lines
                     from lineitem group by 1) l on okey = k""")
def full_join_reconcile(spark, d):
    orders = load_table(spark, d, "orders").filter("o_orderstatus = 'P'").select(
        F.nullif(D("o_orderkey"), F.lit(3)).alias("order_key"), "o_custkey", D("o_totalprice").alias("price")
    )
    lines = load_table(spark, d, "lineitem").groupBy(F.nullif(D("l_orderkey"), F.lit(5)).alias("order_key")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("price"), F.count("*").alias("n_lines")
    )
    return joins.reconcile_full(orders, lines, ["order_key"], fill=["price"])


def _recent_customers(spark, d):
    recent = D("o_orderdate") >= F.lit("2001-06-01").cast("timestamp")
    return load_table(spark, d, "orders").filter(recent).select("o_custkey")


@query("""select c_custkey from customer where c_custkey not in
          (select o_custkey from orders where o_orderdate >= timestamp '2001-06-01')""")
def null_aware_not_in(spark, d):
    return joins.not_in(load_table(spark, d, "customer").select("c_custkey"), "c_custkey", _recent_customers(spark, d))


@query("""select c_custkey, nullif(c_mktsegment, 'BUILDING') in
                 (select nullif(c_mktsegment, 'FURNITURE') from customer where c_acctbal > 9000) as listed from customer""")
def membership_flag(spark, d):
    customers = load_table(spark, d, "customer")
    listed = customers.filter("c_acctbal > 9000").select(F.nullif(D("c_mktsegment"), F.lit("FURNITURE")).alias("s"))
    marked = customers.select("c_custkey", F.nullif(D("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    return joins.membership(marked, "segment", listed, "listed").select("c_custkey", "listed")


@query("""select c_custkey from customer where c_custkey in
          (select o_custkey from orders where o_orderdate >= timestamp '2001-06-01')""")
def semi_join(spark, d):
    customers = load_table(spark, d, "customer").select("c_custkey")
    return customers.join(_recent_customers(spark, d).withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left_semi")


@query("""with spans as (
            select o_custkey as cust, o_orderpriority as priority, o_orderdate::date as f,
                   lead(o_orderdate::date) over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as t from orders),
          shipped as (select l_shipdate::date as s, o_custkey as cust, count(*) as n
                      from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)
          select shipped.cust as customer, s::varchar as ship_day, n, priority
          from shipped left join spans on spans.cust = shipped.cust and s between f and coalesce(t, date '2002-01-01')""")
def interval_join(spark, d):
    orders = load_table(spark, d, "orders")
    dated = orders.select(
        D("o_custkey").alias("customer"), "o_orderkey", D("o_orderpriority").alias("priority"), day("o_orderdate").alias("f")
    )
    spans = temporal.neighbour(
        dated, ["customer"], ["f", "o_orderkey"], ["f"], F.trunc("f", "month"), offset=1, prefix="next_"
    ).select("customer", "priority", "f", F.date_sub("next_f", 1).alias("t"))
    lines = load_table(spark, d, "lineitem").select(D("l_orderkey").alias("o_orderkey"), day("l_shipdate").alias("ship_day"))
    shipped = (
        lines.join(orders.select("o_orderkey", D("o_custkey").alias("customer")), "o_orderkey")
        .groupBy("customer", "ship_day").agg(F.count("*").alias("n"))
    )
    return portable(temporal.interval_left_join(
        shipped, spans, ["customer"], "ship_day", "f", "t", F.to_date(F.lit("2002-01-01")), bucket="month"
    ))


def _supplier_spans(spark, d):
    lines = load_table(spark, d, "lineitem").filter("l_returnflag = 'R'")
    return lines.groupBy("l_suppkey", F.year("l_shipdate").alias("y")).agg(
        F.min(day("l_shipdate")).alias("f"), F.max(day("l_shipdate")).alias("t")
    )


_SPANS = """select l_suppkey, year(l_shipdate) as y, min(l_shipdate::date) as f, max(l_shipdate::date) as t
            from lineitem where l_returnflag = 'R' group by 1, 2"""


@query(f"""select day::varchar as day, l_suppkey from (select distinct o_orderdate::date as day from orders)
           join ({_SPANS}) on day between f and t""")
def range_join_calendar(spark, d):
    calendar = load_table(spark, d, "orders").select(day("o_orderdate").alias("day"))
    return portable(temporal.expand_intervals(calendar, _supplier_spans(spark, d), "day", "f", "t").select("day", "l_suppkey"))


@query(f"""select day::varchar as day, count(f) as count_open from (select distinct o_orderdate::date as day from orders)
           left join ({_SPANS}) on day between f and t group by 1""")
def open_intervals_by_date(spark, d):
    calendar = load_table(spark, d, "orders").select(day("o_orderdate").alias("day"))
    return portable(temporal.open_count_by_date(calendar, _supplier_spans(spark, d), "day", "f", "t"))


@query("""with y as (select c_nationkey as nation, year(o_orderdate) as yr, round(sum(o_totalprice), 2) as revenue
                     from orders join customer on o_custkey = c_custkey group by 1, 2)
          select a.nation::bigint as nation, a.yr, a.revenue, b.revenue as next_revenue
          from y a left join y b on b.nation = a.nation and b.yr = a.yr + 1""")
def next_year_self_join(spark, d):
    yearly = (
        load_table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(F.sum("o_totalprice").alias("s"))
        .join(load_table(spark, d, "customer").select(D("c_custkey").alias("o_custkey"), D("c_nationkey").alias("nation")), "o_custkey")
        .groupBy("nation", "yr").agg(F.round(F.sum("s"), 2).alias("revenue"))
    )
    return portable(joins.next_step(yearly, ["nation"], "yr", ["revenue"], "next_"))


@query("""select o_orderkey, n_name, c_mktsegment from orders left join
          (customer left join nation on c_nationkey = n_nationkey and n_regionkey < 3) on c_custkey = o_custkey""")
def nested_left_join(spark, d):
    nations = load_table(spark, d, "nation").filter("n_regionkey < 3").withColumnRenamed("n_nationkey", "c_nationkey")
    inner = joins.left_lookup(load_table(spark, d, "customer"), nations, ["c_nationkey"]).withColumnRenamed("c_custkey", "o_custkey")
    return joins.left_lookup(load_table(spark, d, "orders"), inner, ["o_custkey"]).select("o_orderkey", "n_name", "c_mktsegment")


@query("""select p_partkey, case p_brand when 'Brand#1' then 'House brand' when 'Brand#2' then 'House brand' else p_brand end
                 as p_brand from part""")
def canonical_names(spark, d):
    mapping = tables.load_seed(spark, [("Brand#1", "House brand"), ("Brand#2", "House brand")], ["variant", "brand"])
    parts = load_table(spark, d, "part").select("p_partkey", "p_brand")
    return joins.canonical_lookup(parts, "p_brand", mapping, "variant", "brand")


_YEARLY = """select o_custkey as c_custkey, year(o_orderdate) as yr, round(sum(o_totalprice), 2) as total
             from orders where o_orderstatus = 'F' group by 1, 2"""


@query(f"select c_custkey, c_mktsegment, yr, total from customer left join ({_YEARLY}) using (c_custkey)")
def fan_out_join(spark, d):
    yearly = load_table(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy(
        D("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("yr")
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    customers = load_table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return portable(joins.left_lookup(customers, yearly, ["c_custkey"]))


@query("""select c_mktsegment, l_returnflag, count(*) as n from lineitem join orders on l_orderkey = o_orderkey
          left join customer on c_custkey = case when l_returnflag = 'R' then 11 else o_custkey end group by 1, 2""")
def hot_key_lookup(spark, d):
    lines = load_table(spark, d, "lineitem").select(D("l_orderkey").alias("o_orderkey"), "l_returnflag")
    keyed = lines.join(load_table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey").select(
        "l_returnflag", F.when(D("l_returnflag") == "R", 11).otherwise(D("o_custkey")).alias("c_custkey")
    )
    customers = load_table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return joins.left_lookup(keyed, customers, ["c_custkey"]).groupBy("c_mktsegment", "l_returnflag").agg(
        F.count("*").alias("n")
    )


# ---------------------------------------------------------------- aggregation


@query("""select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, round(sum(l_extendedprice), 2) as sum_base_price,
                 round(avg(l_quantity), 6) as avg_qty, min(l_tax) as min_tax, max(l_tax) as max_tax, count(*) as count_order,
                 count(*) filter (where l_discount = 0) as undiscounted from lineitem group by 1, 2""")
def pricing_summary(spark, d):
    return load_table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.min("l_tax").alias("min_tax"), F.max("l_tax").alias("max_tax"),
        F.count("*").alias("count_order"), F.count_if(D("l_discount") == 0).alias("undiscounted"),
    )


@query("select l_suppkey, count(distinct l_partkey) as n_parts from lineitem group by all")
def count_distinct(spark, d):
    return load_table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("n_parts"))


@query("""select l_suppkey, count(distinct case when not l_returnflag in ('R') then l_shipdate end) as n_kept_days,
                 count(distinct l_shipdate) as n_days from lineitem group by 1""")
def conditional_count_distinct(spark, d):
    return load_table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.countDistinct(F.when(~D("l_returnflag").isin("R"), D("l_shipdate"))).alias("n_kept_days"),
        F.countDistinct("l_shipdate").alias("n_days"),
    )


@query("select o_custkey, count(*) filter (where o_orderstatus = 'F') as n_done from orders group by 1")
def count_if(spark, d):
    return load_table(spark, d, "orders").groupBy("o_custkey").agg(F.count_if(D("o_orderstatus") == "F").alias("n_done"))


@query("""select o_custkey, string_agg(distinct o_orderpriority, '|' order by o_orderpriority) as priorities
          from orders group by 1""")
def collected_list(spark, d):
    held = load_table(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    return portable(held.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderpriority")).alias("priorities")))


@query("""select o_custkey, string_agg(concat_ws('/', yr, n, last_day), '|' order by yr) as history
          from (select o_custkey, year(o_orderdate) as yr, count(*) as n, max(o_orderdate)::date as last_day
                from orders group by 1, 2) group by 1""")
def nested_history(spark, d):
    yearly = load_table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(
        F.count("*").alias("n"), F.max(day("o_orderdate")).alias("last_day")
    )
    return portable(aggregate.nested_history(yearly, ["o_custkey"], ["yr", "n", "last_day"], "history"))


@query("""select o_orderkey, o_orderdate::date::varchar as o_orderdate from orders
          where o_orderdate = (select max(o_orderdate) from orders)""")
def rows_at_latest_date(spark, d):
    orders = load_table(spark, d, "orders").select("o_orderkey", day("o_orderdate").alias("o_orderdate"))
    latest = orders.agg(F.max("o_orderdate").alias("latest")).scalar()
    return portable(orders.filter(D("o_orderdate") == latest))


_REGIONAL = """from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
               join region on n_regionkey = r_regionkey"""


@query(f"""select r_name, n_name, round(sum(o_totalprice), 2) as revenue, count(*) as n_orders {_REGIONAL} group by 1, 2
           union all select r_name, 'All', round(sum(o_totalprice), 2), count(*) {_REGIONAL} group by 1""")
def revenue_with_all_level(spark, d):
    nations = load_table(spark, d, "nation").join(
        load_table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    ).withColumnRenamed("n_nationkey", "c_nationkey")
    customers = load_table(spark, d, "customer").select(D("c_custkey").alias("o_custkey"), "c_nationkey")
    sales = load_table(spark, d, "orders").groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("total"), F.count("*").alias("n")
    )
    rows = sales.join(customers, "o_custkey").join(nations, "c_nationkey")
    return aggregate.with_all_level(
        rows, ["r_name", "n_name"], ["n_name"],
        {"revenue": F.round(F.sum("total"), 2), "n_orders": F.sum("n")},
    )


@query("select l_orderkey, bool_or(l_returnflag = 'R') as any_returned from lineitem group by 1")
def boolean_or(spark, d):
    return load_table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.bool_or(D("l_returnflag") == "R").alias("any_returned"))


@query("""select o_custkey, max(o_totalprice) filter (where o_orderstatus = 'F') as max_done,
                 min(o_totalprice) filter (where o_orderstatus = 'O') as min_open from orders group by 1""")
def conditional_pivot(spark, d):
    return load_table(spark, d, "orders").groupBy("o_custkey").agg(
        F.max(F.when(D("o_orderstatus") == "F", D("o_totalprice"))).alias("max_done"),
        F.min(F.when(D("o_orderstatus") == "O", D("o_totalprice"))).alias("min_open"),
    )


@query("""select o_custkey, (select o_orderkey from orders i where i.o_custkey = o.o_custkey and o_orderstatus = 'F'
                             order by o_orderdate, o_orderkey limit 1) as first_done,
                 (select o_orderkey from orders i where i.o_custkey = o.o_custkey and o_orderstatus = 'O'
                  order by o_orderdate desc, o_orderkey desc limit 1) as last_open from orders o group by o_custkey""")
def min_by_and_max_by(spark, d):
    order = F.struct("o_orderdate", "o_orderkey")
    return load_table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min_by("o_orderkey", F.when(D("o_orderstatus") == "F", order)).alias("first_done"),
        F.max_by("o_orderkey", F.when(D("o_orderstatus") == "O", order)).alias("last_open"),
    )


@query("select distinct c_mktsegment, c_nationkey::bigint as c_nationkey from customer")
def distinct_rows(spark, d):
    return portable(load_table(spark, d, "customer").select("c_mktsegment", "c_nationkey").distinct())


@query("""select o_orderpriority, count(*) as n, min(o_totalprice) as min,
                 round(quantile_cont(o_totalprice, 0.25), 4) as q1, round(quantile_cont(o_totalprice, 0.5), 4) as median,
                 round(quantile_cont(o_totalprice, 0.75), 4) as q3, max(o_totalprice) as max from orders group by 1""")
def price_quartiles(spark, d):
    out = aggregate.quartiles(load_table(spark, d, "orders"), ["o_orderpriority"], "o_totalprice")
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


# ---------------------------------------------------------------- windows


@query("""select o_custkey, o_orderkey, o_orderdate::date::varchar as o_orderdate, o_orderpriority from orders
          qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""")
def latest_per_key(spark, d):
    orders = load_table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", day("o_orderdate").alias("o_orderdate"), "o_orderpriority"
    )
    return portable(dedupe.latest_per_key(orders, ["o_custkey"], "o_orderdate", "o_orderkey"))


@query("""select user_id, event_type, count(*) as category_count,
                 rank() over (partition by user_id order by count(*) desc) as category_rank,
                 count(*) / sum(count(*)) over (partition by user_id) as category_share
          from events group by 1, 2""")
def ranked_categories(spark, d):
    return ranking.rank_categories(load_table(spark, d, "events"), ["user_id"], "event_type")


@query(f"""select r_name, n_name, n, n / sum(n) over (partition by r_name) as share
           from (select r_name, n_name, count(*) as n {_REGIONAL} group by 1, 2)""")
def share_of_region(spark, d):
    nations = load_table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey").join(
        load_table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    )
    per_customer = load_table(spark, d, "orders").groupBy(D("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    per_nation = (
        per_customer.join(load_table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
        .join(nations, "c_nationkey").groupBy("r_name", "n_name").agg(F.sum("n").alias("n"))
    )
    return ranking.share_of_partition(per_nation, ["r_name"], "n", "share")


@query("""with spans as (select o_custkey, o_orderkey,
                 case when o_orderstatus <> 'P' or o_orderpriority <> '1-URGENT' then o_orderdate::date end as closed from orders)
          select o_custkey, o_orderkey,
                 case sum((closed is null)::int) over w when 1 then closed is null when 0 then closed = max(closed) over w end
                 as is_current from spans window w as (partition by o_custkey)""")
def flag_current(spark, d):
    closed = F.when((D("o_orderstatus") != "P") | (D("o_orderpriority") != "1-URGENT"), day("o_orderdate"))
    spans = load_table(spark, d, "orders").select("o_custkey", "o_orderkey", closed.alias("closed"))
    return dedupe.flag_current(spans, ["o_custkey"], "closed", "is_current").drop("closed")


@query("""select o_custkey, o_orderkey, before from (
            select *, lag(o_orderstatus) over (partition by o_custkey order by o_orderdate, o_orderkey) as before from orders)
          where not before = o_orderstatus""")
def previous_row(spark, d):
    orders = load_table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    out = temporal.neighbour(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus"], F.trunc("o_orderdate", "month")
    )
    changed = out.filter(~(D("prev_o_orderstatus") == D("o_orderstatus")))
    return changed.select("o_custkey", "o_orderkey", D("prev_o_orderstatus").alias("before"))


@query("""with c as (select user_id, event_type, count(*) as n from events group by 1, 2),
               r as (select *, rank() over (partition by user_id order by n desc) as place,
                            n / sum(n) over (partition by user_id) as share from c)
          select event_id, e.user_id, max(r.event_type) filter (where place = 1) as primary_type,
                 max(share) filter (where place = 1) as primary_share,
                 max(r.event_type) filter (where place = 2) as secondary_type,
                 max(share) filter (where place = 2) as secondary_share
          from events e join r using (user_id) group by 1, 2""")
def primary_and_secondary(spark, d):
    events = load_table(spark, d, "events").select("event_id", "user_id", "event_type")
    top = ranking.primary_secondary(ranking.rank_categories(events, ["user_id"], "event_type"), ["user_id"], "event_type")
    named = top.withColumnsRenamed({"primary": "primary_type", "secondary": "secondary_type"})
    return joins.left_lookup(events.drop("event_type"), named, ["user_id"])


# ---------------------------------------------------------------- sorts, unions


@query("select n_name, n_regionkey::bigint as n_regionkey from nation order by n_regionkey, n_name")
def ordered_by_keys(spark, d):
    return portable(load_table(spark, d, "nation").select("n_name", "n_regionkey").orderBy("n_regionkey", "n_name"))


@query("""select event_id, value from events where event_type = 'click' union all
          select event_id, value from events where value > 20""")
def union_all_rows(spark, d):
    events = load_table(spark, d, "events")
    clicks, large = events.filter("event_type = 'click'"), events.filter("value > 20")
    return clicks.select("event_id", "value").unionByName(large.select("event_id", "value"))


@query("""select c_name as name, c_acctbal as balance, c_mktsegment as segment, 'customer' as type from customer union all
          select s_name, s_acctbal, null, 'supplier' from supplier""")
def union_of_different_tables(spark, d):
    customers = load_table(spark, d, "customer").select(
        D("c_name").alias("name"), D("c_acctbal").alias("balance"), D("c_mktsegment").alias("segment")
    )
    suppliers = load_table(spark, d, "supplier").select(D("s_name").alias("name"), D("s_acctbal").alias("balance"))
    return sets.union_tagged({"customer": customers, "supplier": suppliers})


# ---------------------------------------------------------------- scalar functions


@query("""select p_partkey, lower(p_type) as low, p_name as trimmed, 'part ' || p_partkey as unspaced,
                 replace(p_brand, '#', ' ') as unhashed, left(p_name, 3) as prefix, substring(p_type, 1, 2) as sub from part""")
def string_cleaning(spark, d):
    dirty = F.concat(F.lit(" \t "), D("p_name"), F.lit("  \t\n"))
    spaced = F.concat(F.lit("part "), D("p_partkey").cast("string"))
    return load_table(spark, d, "part").select(
        "p_partkey", F.lower("p_type").alias("low"), tx.trim_ws(dirty).alias("trimmed"),
        tx.replace_nbsp(spaced).alias("unspaced"), F.replace(D("p_brand"), F.lit("#"), F.lit(" ")).alias("unhashed"),
        F.left(D("p_name"), F.lit(3)).alias("prefix"), F.substring("p_type", 1, 2).alias("sub"),
    )


@query(r"""select doc_id, contains(lower(text), 'tion of') as has_phrase, regexp_matches(text, '[A-Z][a-z]+ly\b') as has_pattern,
                  nullif(regexp_extract(text, '(\w+)@\w+', 1), '') as mailbox,
                  length(regexp_replace(text, '([0-9])([0-9])', '\2\1', 'g')) as swapped_length from documents""")
def pattern_functions(spark, d):
    text = D("text")
    return portable(dealt(load_table(spark, d, "documents")).select(
        "doc_id", tx.contains_ci(text, "Tion Of").alias("has_phrase"), text.rlike(r"[A-Z][a-z]+ly\b").alias("has_pattern"),
        tx.extract_or_null(text, r"(\w+)@\w+").alias("mailbox"),
        F.length(F.regexp_replace(text, "([0-9])([0-9])", "$2$1")).alias("swapped_length"),
    ))


@query(r"""select page_id, nullif(regexp_extract(url, '^https?://([^/]+)/', 1), '') as host,
                  regexp_replace(url, '^(https?)://(www\.|m\.)?', '\1:', 'g') as short_url,
                  case when regexp_matches(url, '\?page=([0-9]*)') then regexp_extract(url, '\?page=([0-9]*)', 1) end as page
           from pages""")
def url_patterns(spark, d):
    url = D("url")
    return load_table(spark, d, "pages").select(
        "page_id", tx.extract_or_null(url, "^https?://([^/]+)/").alias("host"),
        F.regexp_replace(url, r"^(https?)://(www\.|m\.)?", "$1:").alias("short_url"),
        tx.extract_or_null(url, r"\?page=([0-9]*)", may_be_empty=True).alias("page"),
    )


@query("""select l_orderkey, year(l_shipdate) as yr, month(l_shipdate) as mo, date_diff('day', o_orderdate, l_shipdate) as lag_days,
                 date_diff('day', l_shipdate, date '2002-01-01') as open_days,
                 count(*) as n, round(round(avg(l_quantity) * 8) / 8, 1) as avg_qty, round(avg(l_quantity))::bigint as whole_qty
          from lineitem join orders on l_orderkey = o_orderkey group by 1, 2, 3, 4, 5""")
def dates_and_rounding(spark, d):
    orders = load_table(spark, d, "orders").select(D("o_orderkey").alias("l_orderkey"), day("o_orderdate").alias("od"))
    lines = dealt(load_table(spark, d, "lineitem"), "l_orderkey")  # the join and the groups below stay within these parts
    rows = lines.select("l_orderkey", day("l_shipdate").alias("sd"), "l_quantity").join(orders, "l_orderkey")
    end = temporal.open_end(F.lit(None).cast("date"), F.to_date(F.lit("2002-01-01")))
    return portable(rows.groupBy(
        "l_orderkey", F.year("sd").alias("yr"), F.month("sd").alias("mo"), F.datediff("sd", "od").alias("lag_days"),
        F.datediff(end, "sd").alias("open_days"),
    ).agg(
        F.count("*").alias("n"), F.round(F.round(F.avg("l_quantity") * 8) / 8, 1).alias("avg_qty"),
        nm.round_to_long(F.avg("l_quantity")).alias("whole_qty"),
    ))


@query("""select user_id, count(*) as n, sum(event_id) * 2 - min(event_id) as mixed, max(event_id) / count(*) as ratio
          from events group by 1""")
def float_arithmetic(spark, d):
    return load_table(spark, d, "events").groupBy("user_id").agg(
        F.count("*").alias("n"), (F.sum("event_id") * 2 - F.min("event_id")).alias("mixed"),
        (F.max("event_id") / F.count("*")).alias("ratio"),
    )


# ---------------------------------------------------------------- domain operators


@query("""select l_orderkey, case when sum(case when l_discount > 0.05 then 1 else 0 end) = 0 then 0
                 else count(*) filter (where l_returnflag = 'R')
                      / sum(case when l_discount > 0.05 then 1 else 0 end) end::double as returns_per_discount
          from lineitem group by 1""")
def guarded_ratio(spark, d):
    return load_table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        nm.guarded_ratio(F.count_if(D("l_returnflag") == "R"), F.count_if(D("l_discount") > 0.05)).alias("returns_per_discount")
    )


@query("""select l_suppkey, cast(round(cast(100 * count(*) filter (where l_returnflag = 'R')
                   / nullif(count(*) filter (where l_linestatus = 'F'), 0) as decimal(24, 9)), 1) as double) as pct_returned
          from lineitem group by 1""")
def percent(spark, d):
    return load_table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        nm.percent(F.count_if(D("l_returnflag") == "R"), F.count_if(D("l_linestatus") == "F")).alias("pct_returned")
    )


_COUNTS = r"""length(regexp_replace(text, '\P{L}+', '', 'g')) as characters,
              len(regexp_extract_all(text, '[^\s]+')) as words,
              len(regexp_extract_all(text, '[^.?!]+[.?!]+')) as sentences,
              len(regexp_extract_all(lower(text), '[aeiouy]+')) as syllables"""


def _counts(df):
    text = D("text")
    return df.withColumns(
        {
            "characters": tx.count_characters(text), "words": tx.count_words(text),
            "sentences": tx.count_sentences(text), "syllables": tx.count_syllables(text),
        }
    )


@query(f"select doc_id, {_COUNTS} from documents")
def text_counts(spark, d):
    return _counts(dealt(load_table(spark, d, "documents")).select("doc_id", "text")).drop("text")


@query(f"""select lang, count(*) as n, round(avg(206.835::double - 1.015::double * (words / nullif(sentences, 0))
                  - 84.6::double * (syllables / nullif(words, 0))), 4) as readability
           from (select lang, {_COUNTS} from documents) group by 1""")
def readability_by_language(spark, d):
    score = tx.readability(D("words"), D("sentences"), D("syllables"))
    return _counts(dealt(load_table(spark, d, "documents")).select("lang", "text")).groupBy("lang").agg(
        F.count("*").alias("n"), F.round(F.avg(score), 4).alias("readability")
    )


_SPOKEN = """(select conv_id, turn, case role when 'user' then 'OA' when 'system' then 'WA' else 'BP' end as kind,
                     case turn % 3 when 0 then 'To ask the Minister for Law, ' when 1 then 'Mr B asked, ' else '' end
                     || case when conv_id % 7 = 3 then 'the following question stood in the name of C. ' else '' end
                     || text as said from conversations)"""


def _spoken(spark, d):
    opening = F.when(D("turn") % 3 == 0, "To ask the Minister for Law, ").when(D("turn") % 3 == 1, "Mr B asked, ").otherwise("")
    formal = F.when(D("conv_id") % 7 == 3, "the following question stood in the name of C. ").otherwise("")
    kind = F.when(D("role") == "user", "OA").when(D("role") == "system", "WA").otherwise("BP")
    return load_table(spark, d, "conversations").select(
        "conv_id", "turn", kind.alias("kind"), F.concat(opening, formal, D("text")).alias("said")
    )


@query(f"""select conv_id, turn, contains(lower(left(said, 100)), 'following question stood in the name')
                  or (kind in ('OA', 'WA', 'WANA') and regexp_matches(lower(left(said, 20)), 'asked|to ask|as ked')
                      and regexp_matches(lower(left(said, 100)), 'minister|parliamentary secretary')) as is_question
           from {_SPOKEN}""")
def primary_question_flag(spark, d):
    return _spoken(spark, d).select("conv_id", "turn", tx.is_primary_question(D("kind"), D("said")).alias("is_question"))


@query(rf"""select conv_id, turn, case when contains(said, 'Prime Minister') and not contains(said, 'Deputy Prime Minister')
                   then 'Prime Minister' else nullif(regexp_extract(regexp_replace(said, '[,();]+', '', 'g'),
                   'Minister for (\S+(?: \S+){{0,6}})', 1), '') end as office from {_SPOKEN}""")
def addressed_office(spark, d):
    return _spoken(spark, d).select("conv_id", "turn", tx.extract_minister_for(D("said")).alias("office"))


_RULES = [("Finance", "money"), ("[Ww]hether", "question"), ("tion", "noun"), ("und", "german"), ("é", "french")]


@query("""select doc_id, (select arg_min(label, i) from (values (1, 'Finance', 'money'), (2, '[Ww]hether', 'question'),
                 (3, 'tion', 'noun'), (4, 'und', 'german'), (5, 'é', 'french')) r(i, p, label)
                 where regexp_matches(text, p)) as label from documents""")
def classify_first_match(spark, d):
    return dealt(load_table(spark, d, "documents")).select("doc_id", tx.classify_first_match(D("text"), _RULES).alias("label"))


@query("""select p_partkey, case when p_type = 'ECONOMY' then 'Economy' when p_type = 'PROMO' then 'Promotion'
                 when p_type like 'S%' then 'S class' else p_type end as p_type from part""")
def canonicalise_values(spark, d):
    padded = F.concat(D("p_type"), F.when(D("p_type") != "ECONOMY", " \t").otherwise(""))
    clean = tx.canonicalise(padded, {"ECONOMY": "Economy"}, {"PROMO": "Promotion"}, {"S": "S class"})
    return load_table(spark, d, "part").select("p_partkey", clean.alias("p_type"))


@query("""select conv_id, turn, case when conv_id % 5 = 0 then 'Speaker' when role = 'system' then 'Deputy Speaker'
                 when role = 'assistant' then 'Speaker' else role end as role from conversations""")
def normalise_roles(spark, d):
    name = F.when(D("role") == "system", "Mr Deputy Speaker").when(D("role") == "assistant", "Madam Speaker").otherwise(
        F.concat(F.lit(" "), D("role"), F.lit(" "))
    )
    original = F.when(D("conv_id") % 5 == 0, "The Chairman").otherwise(D("role"))
    return load_table(spark, d, "conversations").select("conv_id", "turn", tx.normalise_role(name, original).alias("role"))


_STAGES = """select o_orderkey, '1 placed' as stage, o_orderdate::date as on_day from orders union all
             select o_orderkey, '2 shipped', o_orderdate::date from orders
             where o_orderkey in (select l_orderkey from lineitem where l_linestatus = 'F') union all
             select o_orderkey, '3 returned', o_orderdate::date from orders
             where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R' and l_linestatus = 'O')"""


def _stages(spark, d):
    orders = load_table(spark, d, "orders").select("o_orderkey", "o_custkey", day("o_orderdate").alias("on_day"))
    lines = load_table(spark, d, "lineitem").select(
        D("l_orderkey").alias("o_orderkey"), (D("l_linestatus") == "F").alias("shipped"),
        ((D("l_returnflag") == "R") & (D("l_linestatus") == "O")).alias("returned"),
    )
    flagged = lifecycle.flagged_events(
        lines, ["o_orderkey"], {"2 shipped": D("shipped"), "3 returned": D("returned")}, "stage"
    )
    placed = orders.select("o_orderkey", F.lit("1 placed").alias("stage"))
    return placed.unionByName(flagged).join(orders, "o_orderkey")


@query(f"select o_orderkey, stage, on_day::varchar as on_day from ({_STAGES})")
def lifecycle_events(spark, d):
    return portable(_stages(spark, d).select("o_orderkey", "stage", "on_day"))


_SUMMARY = f"""select o_custkey, year(on_day) as yr,
                      min(on_day || '#' || lpad(o_orderkey::varchar, 12, '0')) filter (where stage = '1 placed') as one,
                      min(on_day || '#' || lpad(o_orderkey::varchar, 12, '0')) filter (where stage = '2 shipped') as two,
                      max(on_day || '#' || lpad(o_orderkey::varchar, 12, '0')) filter (where stage = '3 returned') as three
               from ({_STAGES}) join (select o_orderkey, o_custkey from orders) using (o_orderkey) group by 1, 2"""


def _lifecycles(spark, d, events):
    stages = {"placed": ("1", "first"), "shipped": ("2", "first"), "returned": ("3", "last")}
    dated = events.withColumns({"yr": F.year("on_day"), "who": F.lpad(D("o_orderkey").cast("string"), 12, "0")})
    return lifecycle.lifecycle_summary(dated, ["o_custkey", "yr"], "stage", "on_day", "who", stages)


@query(f"""select o_custkey, yr, split_part(one, '#', 1) as placed_date, split_part(one, '#', 2) as placed_topic,
                  split_part(two, '#', 1) as shipped_date, split_part(two, '#', 2) as shipped_topic,
                  split_part(three, '#', 1) as returned_date, split_part(three, '#', 2) as returned_topic from ({_SUMMARY})""")
def lifecycle_summary(spark, d):
    return portable(_lifecycles(spark, d, _stages(spark, d)))


@query(f"""with s as (select o_custkey, yr, case when one like '%-01-%' or one like '%-02-%' then null else one end as one,
                             two, three from ({_SUMMARY})),
                gaps as (select *, lag(one) over (partition by o_custkey order by yr) as earlier from s
                         where one is null or two is null)
           select o_custkey, yr, one, two, three from s where one is not null and two is not null
           union all
           select g.o_custkey, g.yr, coalesce(g.one, n.one), coalesce(g.two, n.two), coalesce(g.three, n.three)
           from gaps g left join gaps n on n.o_custkey = g.o_custkey and n.yr = g.yr + 1 where g.earlier is null""")
def stitch_across_years(spark, d):
    summary = _lifecycles(spark, d, _stages(spark, d))
    early = F.month("placed_date") <= 2
    gappy = summary.withColumns(
        {c: F.when(~early, D(c)) for c in ("placed_date", "placed_topic")}
    )
    out = lifecycle.stitch_across_years(
        gappy, "o_custkey", "yr", ["placed", "shipped", "returned"], "placed", ["placed", "shipped"]
    )

    def point(prefix):
        return F.concat(D(f"{prefix}_date").cast("string"), F.lit("#"), D(f"{prefix}_topic"))

    return portable(out.select(
        "o_custkey", "yr", point("placed").alias("one"), point("shipped").alias("two"), point("returned").alias("three")
    ))


@query("""select yr, half, case when yr = 1995 and half = 1 then '1990-10-10' else f::varchar end as effective_from_date,
                 case when t < (select max(o_orderdate)::date from orders) then t::varchar end as effective_to_date
          from (select year(o_orderdate) as yr, (month(o_orderdate) + 5) // 6 as half, min(o_orderdate)::date as f,
                       max(o_orderdate)::date as t from orders group by 1, 2)""")
def session_dates(spark, d):
    sittings = load_table(spark, d, "orders").select(
        F.year("o_orderdate").alias("yr"), F.floor((F.month("o_orderdate") + 5) / 6).alias("half"), day("o_orderdate").alias("date")
    )
    return portable(temporal.session_dates(sittings, ["yr", "half"], "date", {"yr": 1995, "half": 1}, "1990-10-10"))


@query("""with h as (select o_custkey, o_orderkey, year(o_orderdate) as snap,
                            case when o_orderstatus <> 'P' then o_orderdate::date end as ended from orders),
               w as (select *, max(snap) over (partition by o_custkey) as own, max(snap) over () as newest from h)
          select o_custkey, o_orderkey, snap,
                 case when own < newest then coalesce(ended, date '2005-01-01') else ended end::varchar as ended
          from w where own < newest or snap = newest""")
def close_stale_intervals(spark, d):
    history = load_table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", F.year("o_orderdate").alias("snap"),
        F.when(D("o_orderstatus") != "P", day("o_orderdate")).alias("ended"),
    )
    return portable(temporal.close_stale_intervals(history, "o_custkey", "ended", "snap", F.to_date(F.lit("2005-01-01"))))


@query(f"""select day::varchar as day, l_suppkey, count(*) as count_positions,
                  string_agg('seat ' || n, '|' order by 'seat ' || n) as positions
           from (select distinct o_orderdate::date as day from orders)
           join (select l_suppkey, l_linenumber as n, min(l_shipdate::date) as f, max(l_shipdate::date) as t
                 from lineitem where l_returnflag = 'R' group by l_suppkey, l_linenumber, year(l_shipdate))
             on day between f and t group by 1, 2""")
def concurrent_positions_by_date(spark, d):
    calendar = load_table(spark, d, "orders").select(day("o_orderdate").alias("day"))
    seats = (
        load_table(spark, d, "lineitem").filter("l_returnflag = 'R'")
        .groupBy("l_suppkey", F.concat(F.lit("seat "), D("l_linenumber").cast("string")).alias("seat"), F.year("l_shipdate").alias("y"))
        .agg(F.min(day("l_shipdate")).alias("f"), F.max(day("l_shipdate")).alias("t"))
    )
    return portable(temporal.concurrent_positions_by_date(calendar, seats, "day", ["l_suppkey"], "seat", "f", "t"))


@query("""select c_custkey, year(since) - (1950 + c_custkey % 40) as age from customer
          left join (select o_custkey, min(o_orderdate) as since from orders group by 1) on o_custkey = c_custkey""")
def age_at_first_order(spark, d):
    first = load_table(spark, d, "orders").groupBy(D("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("since"))
    people = joins.left_lookup(load_table(spark, d, "customer").select("c_custkey"), first, ["c_custkey"])
    return portable(people.select("c_custkey", age_at_entry(D("since"), 1950 + D("c_custkey") % 40).alias("age")))


# ---------------------------------------------------------------- data quality


@query("select * from (select o_orderkey, nullif(o_custkey, 7) as o_custkey from orders) where o_custkey is null")
def check_not_null(spark, d):
    orders = load_table(spark, d, "orders").select("o_orderkey", F.nullif(D("o_custkey"), F.lit(7)).alias("o_custkey"))
    return quality.violations(orders, quality.not_null("o_custkey"))


@query("""select k as l_orderkey, count(*) as n_rows from (select nullif(l_orderkey, 9) as k from lineitem) where k is not null
          group by 1 having count(*) > 1""")
def check_unique(spark, d):
    lines = load_table(spark, d, "lineitem").select(F.nullif(D("l_orderkey"), F.lit(9)).alias("l_orderkey"))
    return quality.violations(lines, quality.unique("l_orderkey"))


@query("""select l_orderkey, l_linenumber::bigint as l_linenumber, count(*) as n_rows from lineitem where l_tax > 0
          group by 1, 2 having count(*) > 1""")
def check_unique_combination(spark, d):
    check = quality.unique_combination("l_orderkey", "l_linenumber", where="l_tax > 0")
    return portable(quality.violations(load_table(spark, d, "lineitem"), check))


@query("""select l_orderkey, l_partkey, l_discount from lineitem where l_linestatus = 'F' and not l_discount > 0""")
def check_accepted_range(spark, d):
    check = quality.accepted_range("l_discount", minimum=0, inclusive=False, where="l_linestatus = 'F'")
    return quality.violations(load_table(spark, d, "lineitem"), check).select("l_orderkey", "l_partkey", "l_discount")


@query("select doc_id, n_chars from documents where lang <> 'de' and not (n_chars >= length(text) and n_chars < 3000)")
def check_expression(spark, d):
    check = quality.expression_is_true("n_chars >= length(text) and n_chars < 3000", where="lang <> 'de'")
    return quality.violations(dealt(load_table(spark, d, "documents")), check).select("doc_id", "n_chars")


@query("""select 'lineitem' as table_name, * , case failures when 0 then 'pass' else severity end as status from (
            select 'not_null(l_orderkey)' as check_name, 'error' as severity, count(*) filter (where l_orderkey is null) as failures
            from lineitem
            union all select 'accepted_range(l_discount)', 'warn', count(*) filter (where l_discount <= 0) from lineitem
            union all select 'expression_is_true(l_extendedprice >= l_quantity)', 'error',
                             count(*) filter (where l_extendedprice < l_quantity) from lineitem
            union all select 'unique_combination(l_orderkey, l_linenumber)', 'error', count(*)
                      from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
            union all select 'unique(l_orderkey)', 'warn', count(*)
                      from (select 1 from lineitem group by l_orderkey having count(*) > 1))""")
def quality_report(spark, d):
    return quality.report(
        load_table(spark, d, "lineitem"),
        [
            quality.not_null("l_orderkey"),
            quality.accepted_range("l_discount", minimum=0, inclusive=False, severity="warn"),
            quality.expression_is_true("l_extendedprice >= l_quantity"),
            quality.unique_combination("l_orderkey", "l_linenumber"),
            quality.unique("l_orderkey", severity="warn"),
        ],
        "lineitem",
    )
