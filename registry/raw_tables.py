"""Raw legislative tables derived from the given commerce tables.

Customers play the members, orders the speeches and topics, line items the attendance,
documents the spoken texts. The statements are written in SQL that both Spark and the
checking engine understand, so both sides start from the same raw rows; names in braces
are the tables a statement reads. The dirt the staging models must clean (variants of
names, padding, stale snapshots, missing values) is made here.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from rostrum import fixed_values as fv
from registry.catalog import dealt
from rostrum.sources.tables import load_table

AS_OF = "2019-08-01"

_VARIANTS = [*fv.BILL_TITLE_EXACT, *fv.BILL_TITLE_TRIMMED, *fv.BILL_TITLE_PREFIX]


def _values(names: list[str]) -> str:
    return ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))


_MEMBER_RAW = """case when o_custkey % 50 = 3 then upper(member_name) else member_name end"""

STATEMENTS: dict[str, str] = {
    "sat": """
        select o_orderkey, o_custkey, o_orderstatus, substr(o_orderpriority, 1, 1) as pri, d,
               cast(extract(year from d) as bigint) as yr, cast(extract(day from d) as bigint) as dy,
               cast(extract(month from d) as bigint) as mo,
               cast(d as string) || '-' || substr(o_orderpriority, 1, 1) as topic_id,
               case when d < date '2016-01-15' then 12 when d < date '2018-06-01' then 13 else 14 end as parl,
               case when d < date '2014-07-01' then 1 when d < date '2016-01-15' then 2
                    when d < date '2017-04-01' then 1 when d < date '2018-06-01' then 2
                    when d < date '2019-02-01' then 1 else 2 end as sess
        from (select *, cast(cast(o_orderdate as date) + interval '18' year as date) as d from {orders}) shifted""",
    "people": """
        select c_custkey, c_mktsegment, c_acctbal, n_name, n_regionkey,
               case when c_custkey = 5 then 'Lee Li Lian' else replace(c_name, '#', ' ') end as member_name
        from {customer} join {nation} on c_nationkey = n_nationkey""",
    "sittings": """
        select distinct cast(parl as string) as parliament, cast(sess as string) as session,
               cast(yr - 1924 as string) as volume, cast(mo * 100 + dy as string) as sittings,
               cast(d as string) as date, cast(d as string) || ' 13:30:00' as datetime
        from {sat} where o_orderstatus = 'F'""",
    "topic_days": """
        select distinct topic_id, d, yr, mo, dy, pri,
               case when pri = '1' then (dy * 12 + mo) % 300 else (dy * 12 + mo + 150) % 300 end as idx
        from {sat}""",
    "topics": f"""
        select topic_id, pri as topic_order, cast(d as string) as date,
               case pri when '1' then 'BI' when '2' then 'BP' when '3' then 'OA' when '5' then 'WANA'
                    else case dy % 3 when 0 then 'OS' when 1 then 'WA' else 'WS' end end as section_type,
               case when pri > '2' then 'Matters of ' || cast(d as string)
                    when v.i < 16 then v.title
                    when v.i < 18 then v.title || chr(9)
                    when v.i = 18 then v.title || ' (continued)'
                    when idx % 10 = 0 then 'Constitution of Area ' || cast(idx as string) || ' (Amendment) Bill'
                    else 'Statutes ' || cast(idx as string) || ' (Amendment No 2) Bill'
                         || case idx % 7 when 0 then '.' when 1 then ' ' || chr(9) else '' end end as title
        from {{topic_days}} left join (values {_values(_VARIANTS)}) as v(i, title) on v.i = idx""",
    "spoken": f"""
        select s.*, p.member_name, t.text as document,
               replace(replace(replace(coalesce(v.ministry, 'Gardens'), 'Culture ', 'Culture, '), 'Information Comm',
                       'Information, Comm'), 'Development Youth', 'Development, Youth') as office
        from {{sat}} s join {{people}} p on s.o_custkey = p.c_custkey
             left join (values {_values(fv.MINISTRIES)}) as v(i, ministry) on v.i = (s.o_orderkey + s.dy) % 22
             left join {{documents}} t on t.doc_id = s.o_orderkey""",
    "worded": """
        select *, case
              when pri in ('3', '5') then case o_orderkey % 6
                when 0 then 'Mr A asked the Minister for ' || office || ' (a) whether the scheme works; and (b) why.'
                when 1 then 'The following question stood in the name of ' || member_name
                            || ' - 1. To ask the Minister for ' || office || ' how many.'
                when 2 then 'To ask the Deputy Prime Minister and Minister for Finance whether taxes rise.'
                when 3 then 'To ask the Prime Minister whether he will agree.'
                when 4 then 'as ked the Parliamentary Secretary to the Minister for ' || office || ', when.'
                else 'Sir, the Minister for ' || office || ' has replied' end
              when pri = '2' then case o_orderkey % 4
                when 0 then 'I beg to move, That the Bill be now read a SECOND TIME.'
                when 1 then 'Order for Third Reading read.'
                when 2 then 'After its second reading the Bill was read the third time and passed.'
                else 'Clause 1 stands part of the Bill.' end
              when pri = '4' then case o_orderkey % 4
                when 0 then 'The following question stood in the name of ' || member_name || ' to ask the Minister for '
                            || office || '.'
                when 1 then '(In Mandarin): [Vernacular Speech] Thank you.'
                when 2 then '(In Tamil) [A vernacular speech was made here.] (In Malay)'
                else 'Vernacular speech.' end
              else 'Bill read the first time' end || coalesce(' ' || document, '') as text
        from {spoken}""",
    "speeches": """
        select 'S' || cast(o_orderkey as string) as speech_id, topic_id, cast(o_orderkey % 50 as string) as speech_order,
               case when o_custkey % 101 = 7 then 'Mr Deputy Speaker' when o_custkey % 101 = 11 then 'Mr Speaker'
                    when o_custkey % 101 = 13 then '' when o_custkey % 50 = 3 then upper(member_name)
                    when o_custkey % 50 = 4 then ' ' || replace(member_name, ' ', chr(160)) || chr(9)
                    else member_name end as member_name,
               case when o_orderkey % 97 = 5 then 'The Chairman' else member_name end as member_name_original,
               text, cast(length(text) - length(replace(text, ' ', '')) + 1 as string) as num_words,
               case when o_orderkey % 89 = 5 then '0' else cast(length(replace(text, ' ', '')) as string) end
                 as num_characters,
               cast(length(text) - length(replace(text, '.', '')) as string) as num_sentences,
               cast(length(text) - length(translate(lower(text), 'aeiou', '')) as string) as num_syllables,
               cast(d as string) as date
        from {worded}""",
    "attendance": f"""
        select cast(d as string) as date,
               case when o_custkey % 101 = 13 then cast(null as string) when o_custkey % 101 = 17 then ''
                    else {_MEMBER_RAW} end as member_name,
               case when max(case when l_returnflag = 'R' then 0 else 1 end) = 1 then 'true' else 'false' end as is_present
        from (select l_returnflag, o_custkey, cast(cast(l_shipdate as date) + interval '18' year as date) as d
              from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey) shipped
             join {{people}} on o_custkey = c_custkey
        group by d, o_custkey, member_name""",
    "members_full_name": """
        select member_name as original,
               case when c_mktsegment <> 'BUILDING' then lower(member_name) || '-web' end as converted from {people}""",
    "members_image": """
        select member_name, 'http://img/a/' || cast(c_custkey as string) as image_link, '2023-01-01' as accessed_at
        from {people} union all
        select member_name, case when c_mktsegment <> 'MACHINERY' then 'http://img/b/' || cast(c_custkey as string) end,
               '2024-01-01' from {people} where c_acctbal > 0""",
    "members_year_of_birth": """
        select member_name, cast(1940 + c_custkey % 50 as string) as year_of_birth, '2023-01-01' as accessed_at
        from {people} union all
        select member_name, case when c_mktsegment <> 'BUILDING' then cast(1941 + c_custkey % 50 as string) end,
               '2024-01-01' from {people} where c_acctbal > 5000""",
    "terms": """
        select c_mktsegment, member_name, n_name || chr(160) || 'GRC' as constituency, '2011-05-07' as from_date,
               '2015-08-25' as to_date, '07 May 2011 - 25 August 2015' as date_range from {people}
        union all
        select c_mktsegment, member_name, n_name || ' SMC', '2015-09-11',
               case when c_acctbal <= 1000 then '2018-12-31' end,
               case when c_acctbal <= 1000 then '11 September 2015 - 31 December 2018'
                    else '11 September 2015 - Current' end from {people}
        union all
        select c_mktsegment, member_name, 'Region ' || cast(n_regionkey as string), '2017-01-01', '2017-12-31',
               '01 January 2017 - 31 December 2017' from {people} where c_mktsegment = 'MACHINERY'""",
    "members_member_of_parliament": """
        select member_name, constituency, from_date, to_date, date_range, '2024-01-01' as accessed_at from {terms}
        union all
        select member_name, constituency, from_date, to_date, date_range, '2024-06-01' from {terms}
        where c_mktsegment <> 'FURNITURE'""",
    "offices": """
        select c_mktsegment, member_name, min(o_orderkey) as k, min(d) as f, max(o_orderstatus) as st
        from {sat} join {people} on o_custkey = c_custkey where pri = '1' group by c_mktsegment, member_name, yr""",
    "office_terms": """
        select c_mktsegment, member_name,
               case when k % 5 = 0 then 'Speaker' else 'Minister ' || cast(k % 9 as string) end as position,
               cast(f as string) as from_date,
               case when st <> 'P' or f < date '2018-06-01' then cast(cast(f + interval '200' day as date) as string) end
                 as to_date,
               case when st <> 'P' or f < date '2018-06-01' then 'closed' else 'since then - Current' end as date_range
        from {offices}""",
    "members_office_holding": """
        select member_name, position, from_date, to_date, date_range, '2024-01-01' as accessed_at from {office_terms}
        union all
        select member_name, position, from_date, to_date, date_range, '2024-06-01' from {office_terms}
        where c_mktsegment <> 'FURNITURE'""",
    "committee_years": """
        select member_name, case when yr = 2019 then '15' else cast(min(parl) as string) end as parliament,
               cast(min(sess) as string) as session, 'Committee ' || cast(min(o_orderkey) % 6 as string) as committee,
               max(o_orderstatus) as st
        from {sat} join {people} on o_custkey = c_custkey where pri = '5' group by member_name, yr""",
    "members_select_committee": """
        select member_name, parliament, session, committee, 'Member' as position, '2024-01-01' as accessed_at
        from {committee_years} union all
        select member_name, parliament, session, committee, 'Member', '2024-06-01' from {committee_years} union all
        select member_name, parliament, session, committee, 'Chairman', '2024-06-01' from {committee_years}
        where st = 'P'""",
    "highest_topic": """
        select topic_id, cast(dy % 12 as string) as highest_topic,
               '0.' || lpad(cast(dy * 25 as string), 3, '0') as highest_topic_distribution
        from {topic_days} where pri <> '4'""",
    "topic_names": """
        select cast(p_size % 10 as string) as topic, 'Group ' || cast(p_size % 10 as string) as topic_summary,
               min(p_name) || ' ' || max(p_name) as top_n_words from {part} group by p_size % 10""",
    "bills_introduced": """
        select case when d = date '2014-05-04' then '22/2023' else t.topic_id end as number,
               case dy when 1 then 'Monetary Authority of  Singapore (Amendment) Bill'
                       when 2 then 'Foreign Interference (countermeasures) Bill' when 3 then title
                       else replace(replace(rtrim(replace(title, chr(9), '')), '.', ''), 'No 2', 'No. 2') end as title,
               'http://bills/' || t.topic_id as pdf_link, case when dy <> 4 then cast(d as string) end as date_introduced,
               case when dy > 6 then cast(cast(d + interval '30' day as date) as string) end as date_2nd_reading,
               case when dy > 9 then cast(cast(d + interval '60' day as date) as string) end as date_passed
        from {topics} t join {topic_days} using (topic_id) where section_type = 'BI'""",
    "speech_positions": """
        select 'S' || cast(o_orderkey as string) as speech_id, 'Topic ' || cast(o_orderkey % 7 as string) as topic_assigned
        from {orders} where o_orderstatus <> 'O'""",
    "sheet_member_of_parliament": """
        select member_name, 'Sheet' || chr(160) || 'Ward ' as constituency, '2012-01-01' as from_date,
               '2012-12-31' as to_date, '2024-03-01' as accessed_at from {people} where c_mktsegment = 'AUTOMOBILE'""",
    "sheet_ethnicity": """
        select member_name, 'Group ' || cast(n_regionkey as string) as ethnicity, 'yes' as is_ethnicity_certain
        from {people}""",
    "sheet_year_of_birth": """
        select member_name, '1960' as year_of_birth, '2024-02-01' as accessed_at from {people}
        where c_mktsegment = 'AUTOMOBILE'""",
    "sheet_office_holding": """
        select member_name, 'Mayor' as position, '2014-01-01' as from_date, '2016-01-01' as to_date,
               '2024-03-01' as accessed_at from {people} where c_mktsegment = 'BUILDING' and c_acctbal > 5000""",
    "sheet_member_name_mapping": """
        select member_name, upper(member_name) as possible_variation from {people} where c_custkey % 50 = 3""",
    "sheet_member_image_link": """
        select member_name, 'http://sheet/' || cast(c_custkey as string) as member_image_link,
               case when c_mktsegment = 'FURNITURE' then '2024-01-01' else '2023-06-01' end as accessed_at
        from {people} where c_mktsegment in ('FURNITURE', 'HOUSEHOLD')""",
    "sheet_member_name_link": """
        select member_name, 'sheet-name' as member_link_name, '2024-06-01' as accessed_at from {people}
        where c_mktsegment = 'HOUSEHOLD'""",
    "sheet_gender": """
        select member_name, case when c_custkey % 2 = 0 then 'F' else 'M' end as gender from {people}""",
    "parties": """
        select member_name, c_acctbal, case c_mktsegment when 'FURNITURE' then 'NMP' when 'BUILDING' then 'WP'
               else 'PAP' end as party from {people}""",
    "sheet_party": """
        select member_name, party, cast(12 as bigint) as parliament from {parties} union all
        select member_name, party, cast(13 as bigint) from {parties} union all
        select member_name, party, cast(14 as bigint) from {parties} where c_acctbal >= 0""",
}


# tables dealt to tasks first, and by which keys: line items meet orders on theirs, in parts that don't grow. Orders and customers
# are read many times and only pass through to joins and groups; dealing them would shuffle them once more each time.
_DEALT = {"lineitem": ["l_orderkey"]}


def reads(name: str) -> list[str]:
    """Tables a statement reads, in order."""
    found = [field for _, field, _, _ in Formatter().parse(STATEMENTS[name]) if field]
    return list(dict.fromkeys(found))


class RawTables(dict):
    """Raw tables by name, each derived when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        if name in STATEMENTS:
            tables = {t: self[t] for t in reads(name)}
            if name == "attendance":  # line items are sorted and grouped by customer, in parts that don't grow
                tables["people"] = dealt(tables["people"], "c_custkey", beside=tables["lineitem"])
            df = self.spark.sql(STATEMENTS[name], **tables)
        else:
            df = load_table(self.spark, self.folder, name)
            df = dealt(df, *_DEALT[name]) if name in _DEALT else df
        self[name] = df
        return df


def cte(name: str) -> str:
    """The name under which the checking SQL knows a raw table."""
    return f"raw_{name}" if name in STATEMENTS else name


def as_ctes(names: list[str], seen: dict[str, str]) -> None:
    """Add the statements behind ``names`` to ``seen``, each after what it reads."""
    for name in names:
        if name in STATEMENTS and cte(name) not in seen:
            as_ctes(reads(name), seen)
            seen[cte(name)] = STATEMENTS[name].format(**{t: cte(t) for t in reads(name)})
