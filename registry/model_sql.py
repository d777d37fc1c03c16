"""SQL for the checking engine: every model over the same derived raw tables.

Formulated on its own terms (set operations, DISTINCT ON, list aggregates, lookups in
VALUES lists), so that agreement with the Spark plans means something. Names in braces
are other models or raw tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from string import Formatter

from registry.raw_tables import AS_OF, as_ctes, cte
from rostrum import fixed_values as fv
from rostrum.operators.quality import Check
from rostrum.sources.schemas import STAGED_SHEETS

_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(160)"


def pairs(mapping) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in dict(mapping).items())


def rounded(expression: str, digits: int) -> str:
    return f"cast(round(cast({expression} as decimal(24, 9)), {digits}) as double)"


def _trim(column: str) -> str:
    return f"trim({column}, {_WS})"


_LABELS = ", ".join(f"({i}, '{m}')" for i, m in enumerate(fv.MINISTRIES))


def _snapshot(raw: str) -> str:
    """Rows of the newest snapshot, and all rows of members who are not in it."""
    return f"""(select *, not present and to_date is null as stale from (
        select *, max(accessed_at) over (partition by member_name) = max(accessed_at) over () as present,
               max(accessed_at) over () as newest from {raw}) where accessed_at = newest or not present)"""


def _latest(value: str, both: str, where: str = "true") -> str:
    return f"""select distinct on (member_name) member_name, {value} from ({both}) where {where}
        order by member_name, accessed_at desc nulls last, {value} desc nulls last"""


def _staged(sheet: str, spec: dict) -> str:
    kinds = {"string": "varchar"}
    cols = ", ".join(f"cast({src} as {kinds.get(t, t)}) as {new}" for new, (src, t) in spec.items())
    return f"select {cols} from {{sheet_{sheet}}}"


def _history(kind: str) -> str:
    return f"""string_agg(concat_ws('/', member_position, effective_from_date, effective_to_date), '|'
        order by effective_from_date nulls first, member_position, effective_to_date nulls first)
        filter (where type = '{kind}')"""


def _now(kind: str) -> str:
    return f"list(member_position order by member_position) filter (where type = '{kind}' and is_latest_position)"


def model_sql(compat: bool = False) -> dict[str, str]:
    sql = {name: _staged(sheet, spec) for name, (sheet, spec) in STAGED_SHEETS.items()}

    sql["stg_attendance"] = """
        select * from (
            select cast(a.date as date) as date, a.is_present = 'true' as is_present,
                   coalesce(v.member_name, a.member_name) as member_name
            from {attendance} a left join {sheet_member_name_mapping} v on a.member_name = v.possible_variation)
        where length(member_name) > 0
          and (lower(member_name) <> 'lee li lian' or date < date '2016-01-15' or date > date '2020-06-23')"""
    sql["stg_sittings"] = """
        select parliament::bigint as parliament, session::bigint as session, volume::bigint as volume,
               sittings::bigint as sittings, date::date as date, datetime::timestamp as datetime from {sittings}"""
    sql["stg_speeches"] = f"""
        select speech_id, topic_id, speech_order::bigint as speech_order, text,
               num_words::bigint * speaks as count_words, num_characters::bigint as count_characters,
               num_sentences::bigint * speaks as count_sentences, num_syllables::bigint * speaks as count_syllables,
               date::date as date, coalesce(v.member_name, who) as member_name
        from (select *, case when num_characters = '0' then 0 else 1 end as speaks,
                     case when contains(member_name_original, 'Chairman') then 'Speaker'
                          when contains(member_name, 'Deputy') then 'Deputy Speaker'
                          when contains(member_name, 'Speaker') then 'Speaker'
                          else {_trim("replace(member_name, chr(160), ' ')")} end as who from {{speeches}}) s
        left join {{sheet_member_name_mapping}} v on who = v.possible_variation"""
    sql["stg_topics"] = """
        select topic_id, topic_order::bigint as topic_order, title, section_type, date::date as date from {topics}"""
    sql["stg_topic_group"] = """
        select topic_id, highest_topic::bigint as topic_group_id,
               highest_topic_distribution::double as topic_group_distribution from {highest_topic}"""
    sql["stg_topic_names"] = """
        select topic::bigint as topic_group_id, topic_summary as topic_group_name,
               top_n_words as topic_group_top_n_words from {topic_names}"""
    sql["stg_bills_introduced"] = f"""
        select number as bill_number, pdf_link as bill_pdf_link, date_introduced::date as first_reading_date,
               date_2nd_reading::date as second_reading_date, date_passed::date as passed_date,
               coalesce(e.fixed, n.fixed, title) as title
        from {{bills_introduced}} left join (values {pairs(fv.INTRODUCED_TITLE_EXACT)}) e(k, fixed) on e.k = title
        left join (values {pairs(fv.INTRODUCED_TITLE_BY_NUMBER)}) n(k, fixed) on n.k = number"""
    sql["stg_members_full_name"] = _latest(
        "member_name_website",
        """select original as member_name, converted as member_name_website, date '2024-05-16' as accessed_at
           from {members_full_name} union all
           select member_name, member_link_name, accessed_at::date from {sheet_member_name_link}""",
        "member_name_website is not null",
    )
    sql["stg_members_image"] = _latest(
        "member_image_link",
        """select member_name, image_link as member_image_link, accessed_at from {members_image} union all
           select member_name, member_image_link, accessed_at from {sheet_member_image_link}""",
    )
    sql["stg_members_year_of_birth"] = _latest(
        "member_birth_year",
        """select member_name, year_of_birth::bigint as member_birth_year, accessed_at from {members_year_of_birth}
           union all select member_name, year_of_birth::bigint, accessed_at from {sheet_year_of_birth}""",
        "member_birth_year is not null",
    )
    terms = (
        "(select *, false as stale from {members_member_of_parliament})"
        if compat
        else _snapshot("{members_member_of_parliament}")
    )
    sql["stg_members_member_of_parliament"] = f"""
        select member_name, member_constituency, effective_from_date, effective_to_date,
               case sum((effective_to_date is null)::int) over (partition by member_name)
                    when 1 then effective_to_date is null
                    when 0 then effective_to_date = max(effective_to_date) over (partition by member_name) end
               as is_latest_constituency
        from (select member_name, {_trim("replace(constituency, chr(160), ' ')")} as member_constituency, from_date::date as effective_from_date,
                     case when stale then date '2025-04-14' when not contains(date_range, 'Current') then to_date::date end
                     as effective_to_date
              from {terms}
              union select member_name, {_trim("replace(constituency, chr(160), ' ')")}, from_date::date, to_date::date
              from {{sheet_member_of_parliament}})"""
    sql["stg_members_office_holding"] = f"""
        select *, effective_to_date is null as is_latest_appointment
        from (select member_name, position as member_appointment, from_date::date as effective_from_date,
                     case when stale then date '2025-04-14' else to_date::date end as effective_to_date
              from {_snapshot("{members_office_holding}")}
              union select member_name, position, from_date::date, to_date::date from {{sheet_office_holding}})"""
    sql["stg_members_select_committee"] = """
        select member_name, c.parliament, c.session, committee as member_committee, roles as member_committee_position,
               case when c.parliament = '12' and c.session = '1' and first is not null then date '2010-10-10' else first
               end as effective_from_date,
               case when last < newest then last end as effective_to_date,
               first is not null and last = newest as is_latest_committee
        from (select member_name, parliament, session, committee, list(distinct position order by position) as roles
              from {members_select_committee} group by all) c
        left join (select parliament, session, min(date)::date as first, max(date)::date as last,
                          (select max(date)::date from {sittings}) as newest
                   from {sittings} group by all) s on s.parliament = c.parliament and s.session = c.session"""
    sql["dim_prep_member_positions"] = """
        select * from (
            select member_name, 'constituency' as type, member_constituency as member_position, effective_from_date,
                   effective_to_date, is_latest_constituency as is_latest_position
            from {stg_members_member_of_parliament}
            union all by name
            select member_name, 'appointment' as type, member_appointment as member_position, effective_from_date,
                   effective_to_date, is_latest_appointment as is_latest_position from {stg_members_office_holding}
            union all by name
            select member_name, 'select_committee' as type, member_committee as member_position, effective_from_date,
                   effective_to_date, is_latest_committee as is_latest_position from {stg_members_select_committee})
        where coalesce(effective_from_date, effective_to_date) is not null"""
    sql["dim_members"] = f"""
        select a.member_name, b.member_birth_year, e.ethnicity as member_ethnicity, g.gender, p.party,
               h.member_constituencies, seat as latest_member_constituency, h.member_appointments,
               array_to_string(h.offices, '|') as latest_member_appointments, h.member_committees,
               array_to_string(h.committees, '|') as latest_member_committees, a.earliest_sitting, a.latest_sitting,
               a.count_sittings_present, a.count_sittings_total, f.member_name_website, i.member_image_link
        from (select member_name, min(date) as earliest_sitting, max(date) as latest_sitting,
                     count(distinct date) filter (where is_present) as count_sittings_present,
                     count(distinct date) as count_sittings_total from {{stg_attendance}} group by 1) a
        left join {{sheet_gender}} g using (member_name) left join {{sheet_ethnicity}} e using (member_name)
        left join {{stg_members_year_of_birth}} b using (member_name)
        left join {{stg_members_full_name}} f using (member_name) left join {{stg_members_image}} i using (member_name)
        left join (select member_name, string_agg(party || '/' || parliament, '|' order by party, parliament) as party
                   from {{sheet_party}} group by 1) p using (member_name)
        left join (select member_name, {_history("constituency")} as member_constituencies,
                          {_history("appointment")} as member_appointments,
                          {_history("select_committee")} as member_committees, {_now("appointment")} as offices,
                          {_now("select_committee")} as committees
                   from {{dim_prep_member_positions}} group by 1) h using (member_name)
        left join (select member_name, member_position as seat from {{dim_prep_member_positions}}
                   where type = 'constituency' and is_latest_position) n using (member_name)"""
    sql["dim_topics"] = f"""
        select t.topic_id, t.date, t.topic_order, t.title, t.section_type, k.name as section_type_name, g.topic_group_id,
               n.topic_group_name, g.topic_group_distribution,
               t.section_type[1] = 'B' and contains(lower(t.title), 'constitution') as is_topic_constitutional,
               t.section_type = 'BI' or t.section_type = 'WS' as is_topic_procedural
        from {{stg_topics}} t left join (values {pairs(fv.TOPIC_TYPES)}) k(code, name) on k.code = t.section_type
        left join {{stg_topic_group}} g using (topic_id) left join {{stg_topic_names}} n using (topic_group_id)"""
    sql["fact_attendance"] = "select date, member_name, is_present from {stg_attendance}"
    sql["fact_sittings"] = "from {stg_sittings}"
    sql["fact_speeches"] = r"""
        select * exclude (said), contains(said, 'vernacular speech') as is_vernacular_speech,
               case when contains(said, 'vernacular speech')
                    then nullif(regexp_extract(said, '\(in (mandarin|malay|tamil)\)', 1), '') end
               as vernacular_speech_language
        from (select *, lower(text) as said from {stg_speeches})"""
    sql["fact_bills_introduced"] = "from {stg_bills_introduced}"
    sql["reading_events"] = """
        select topic_id, '1 First' as reading from {dim_topics} where section_type = 'BI'
        union select topic_id, '2 Second' from {dim_topics} join {fact_speeches} using (topic_id)
        where section_type = 'BP' and regexp_matches(lower(text), 'second (reading|time)')
        union select topic_id, '3 Third' from {dim_topics} join {fact_speeches} using (topic_id)
        where section_type = 'BP' and regexp_matches(lower(text), 'third (reading|time)')"""
    sql["fact_bill_activity"] = f"""
        select t.date, topic_id, reading, coalesce(e.fixed, r.fixed, s.fixed, {_trim("t.title")}) as title
        from {{reading_events}} join {{dim_topics}} t using (topic_id)
        left join (values {pairs(fv.BILL_TITLE_EXACT)}) e(k, fixed) on e.k = t.title
        left join (values {pairs(fv.BILL_TITLE_TRIMMED)}) r(k, fixed) on r.k = {_trim("t.title")}
        left join (values {pairs(fv.BILL_TITLE_PREFIX)}) s(k, fixed) on starts_with(t.title, s.k)"""
    sql["mart_prep_appointment_by_date"] = f"""
        select s.date, member_name, list(member_position order by member_position) as appointments,
               count(*) as count_concurrent_appointments
        from {{fact_sittings}} s, {{dim_prep_member_positions}}
        where type = 'appointment' and s.date between effective_from_date and ifnull(effective_to_date, date '{AS_OF}')
        group by all"""
    sql["bill_years"] = f"""
        select year(date) as year, replace({_trim("title")}, '.', '') as title,
               min(date || '#' || topic_id) filter (where reading = '1 First') as one,
               min(date || '#' || topic_id) filter (where reading = '2 Second') as two,
               max(date || '#' || topic_id) filter (where reading = '3 Third') as three
        from {{fact_bill_activity}} group by 1, 2"""
    sql["mart_prep_bill_activity"] = r"""
        select year, split_part(one, '#', 1)::date as first_reading_date, split_part(one, '#', 2) as first_reading_topic,
               split_part(two, '#', 1)::date as second_reading_date, split_part(two, '#', 2) as second_reading_topic,
               split_part(three, '#', 1)::date as third_reading_date, split_part(three, '#', 2) as third_reading_topic,
               regexp_replace(title, '(No)\s(\d)', '\1. \2', 'g') as title
        from (select year, title, one, two, three from {bill_years} where one is not null and two is not null
              union all
              select year, title, ifnull(one, next_one), ifnull(two, next_two), ifnull(three, next_three)
              from (select *, lag(one) over by_year as earlier, case when after = year + 1 then lead(one) over by_year end
                           as next_one, case when after = year + 1 then lead(two) over by_year end as next_two,
                           case when after = year + 1 then lead(three) over by_year end as next_three
                    from (select *, lead(year) over (partition by title order by year) as after from {bill_years}
                          where one is null or two is null)
                    window by_year as (partition by title order by year)) where earlier is null)"""
    sql["mart_attendance"] = f"""
        select a.date, s.parliament, s.session, a.member_name, m.gender as member_gender, m.member_ethnicity,
               c.member_position as member_constituency, p.party, a.is_present
        from {{fact_attendance}} a left join {{fact_sittings}} s using (date)
        left join {{dim_members}} m on m.member_name = a.member_name
        left join {{sheet_party}} p on p.member_name = a.member_name and p.parliament = s.parliament
        left join {{dim_prep_member_positions}} c on c.type = 'constituency' and c.member_name = a.member_name
             and a.date >= c.effective_from_date and a.date <= ifnull(c.effective_to_date, date '{AS_OF}')"""
    sql["questions"] = rf"""
        select *, (select arg_min(label, i) from (values {_LABELS}) l(i, label) where contains(words, label))
               as ministry_addressed
        from (select *, case when not is_primary_question then null
                        when contains(text, 'Prime Minister') and not contains(text, 'Deputy Prime Minister')
                        then 'Prime Minister'
                        else nullif(regexp_extract(regexp_replace(text, '[,();]+', '', 'g'),
                                                   'Minister for (\S+(?: \S+){{{{0,6}}}})', 1), '') end as words
              from (select speech_id, topic_id, text,
                           contains(lower(left(text, 100)), 'following question stood in the name')
                           or ifnull(section_type in ('OA', 'WA', 'WANA'), false)
                              and regexp_matches(lower(left(text, 20)), 'asked|to ask|as ked')
                              and regexp_matches(lower(left(text, 100)), 'minister|parliamentary secretary')
                           as is_primary_question
                    from {{fact_speeches}} left join {{dim_topics}} using (topic_id)))"""
    sql["spoken_by"] = f"""
        select s.*, t.parliament, t.session, t.volume, t.sittings, m.gender as member_gender, m.member_ethnicity,
               p.party as member_party,
               case when p.party = 'NMP' then 'Nominated Member of Parliament' else c.member_position end
               as member_constituency, o.appointments, o.count_concurrent_appointments
        from {{fact_speeches}} s left join {{fact_sittings}} t using (date)
        left join {{dim_members}} m on m.member_name = s.member_name
        left join {{sheet_party}} p on p.member_name = s.member_name and p.parliament = t.parliament
        left join {{dim_prep_member_positions}} c on c.type = 'constituency' and c.member_name = s.member_name
             and s.date >= c.effective_from_date and s.date <= ifnull(c.effective_to_date, date '{AS_OF}')
        left join {{mart_prep_appointment_by_date}} o on o.member_name = s.member_name and o.date = s.date"""
    sql["asked_by_topic"] = f"""
        select topic_id, ministry_addressed, n, n / sum(n) over (partition by topic_id) as share,
               1 + count(*) over (partition by topic_id order by n desc range between unbounded preceding and current row)
                 - count(*) over (partition by topic_id, n) as place
        from (select q.topic_id, ministry_addressed, count(*) as n
              from {{questions}} q join {{spoken_by}} using (speech_id)
              where ministry_addressed is not null group by all)"""
    procedural = "is_topic_constitutional" if compat else "is_topic_procedural"
    sql["mart_speeches"] = f"""
        select b.date, speech_id, b.topic_id, b.parliament, b.session, b.volume, b.sittings, b.member_name,
               b.member_gender, b.member_ethnicity, b.member_party, b.member_constituency,
               b.appointments as member_appointments,
               b.count_concurrent_appointments as member_count_concurrent_appointments, t.title as topic_title,
               t.section_type as topic_type, t.section_type_name as topic_type_name, t.is_topic_constitutional,
               t.{procedural} as is_topic_procedural, b.text as speech_text, b.count_words as count_speeches_words,
               b.count_characters as count_speeches_characters, b.count_sentences as count_speeches_sentences,
               b.count_syllables as count_speeches_syllables, b.is_vernacular_speech, b.vernacular_speech_language,
               q.is_primary_question, q.ministry_addressed, one.name as ministry_addressed_primary,
               one.share as ministry_proportion_primary, two.name as ministry_addressed_secondary,
               two.share as ministry_proportion_secondary
        from {{spoken_by}} b join {{questions}} q using (speech_id) left join {{dim_topics}} t on t.topic_id = b.topic_id
        left join (select topic_id, max(ministry_addressed) as name, max(share) as share from {{asked_by_topic}}
                   where place = 1 group by 1) one on one.topic_id = b.topic_id
        left join (select topic_id, max(ministry_addressed) as name, max(share) as share from {{asked_by_topic}}
                   where place = 2 group by 1) two on two.topic_id = b.topic_id"""
    sql["mart_bills"] = f"""
        select bill_number, {"a.year" if compat else "ifnull(a.year, i.year)"} as year, ifnull(i.title, a.title) as title,
               ifnull(i.first_reading_date, a.first_reading_date) as first_reading_date, first_reading_topic,
               ifnull(i.second_reading_date, a.second_reading_date) as second_reading_date, second_reading_topic,
               third_reading_date, third_reading_topic, passed_date,
               ifnull(i.second_reading_date, a.second_reading_date)
                 - ifnull(i.first_reading_date, a.first_reading_date) as day_diff_first_second_reading,
               third_reading_date - ifnull(i.second_reading_date, a.second_reading_date)
                 as day_diff_second_third_reading,
               {"third_reading_date - ifnull(i.second_reading_date, a.second_reading_date)" if compat
                else "passed_date - third_reading_date"} as day_diff_third_reading_passed, bill_pdf_link
        from (select *, year(first_reading_date) as year from {{fact_bills_introduced}}) i
        full join {{mart_prep_bill_activity}} a on a.title = i.title and a.year = i.year"""
    sql["agg_speech_metrics_by_member"] = """
        select k.parliament, k.year, k.month, k.member_name, p.party as member_party,
               ifnull(a.seat, s.seat) as member_constituency, a.total as count_sittings_total,
               a.present as count_sittings_present, ifnull(s.days, 0) as count_sittings_spoken,
               ifnull(s.topics, 0) as count_topics, ifnull(s.questions, 0) as count_pri_questions,
               ifnull(s.n, 0) as count_speeches, ifnull(s.words, 0) as count_words,
               ifnull(s.sentences, 0) as count_sentences, ifnull(s.syllables, 0) as count_syllables
        from (select parliament, year(date) as year, month(date) as month, member_name from {mart_attendance}
              union
              select parliament, year(date), month(date), member_name from {mart_speeches}
              where not is_topic_procedural and length(member_name) > 0
                    and not regexp_matches(lower(member_name), 'deputy|speaker|chairman')) k
        left join (select parliament, year(date) as year, month(date) as month, member_name, member_constituency as seat,
                          count(*) filter (where is_present) as present, count(*) as total
                   from {mart_attendance} group by all) a
          on a.parliament = k.parliament and a.year = k.year and a.month = k.month and a.member_name = k.member_name
        left join (select parliament, year(date) as year, month(date) as month, member_name, member_constituency as seat,
                          count(distinct date) filter (where topic_type not in ('WA', 'WANA')) as days,
                          count(distinct topic_id) as topics, count(*) as n, sum(count_speeches_words)::bigint as words,
                          count(*) filter (where is_primary_question) as questions,
                          sum(count_speeches_sentences)::bigint as sentences,
                          sum(count_speeches_syllables)::bigint as syllables
                   from {mart_speeches}
                   where not is_topic_procedural and length(member_name) > 0
                         and not regexp_matches(lower(member_name), 'deputy|speaker|chairman') group by all) s
          on s.parliament = k.parliament and s.year = k.year and s.month = k.month and s.member_name = k.member_name
        left join {sheet_party} p on p.member_name = k.member_name and p.parliament = k.parliament
        where k.parliament is not null
        union all
        select null, year(date), month(date), member_name, null, member_constituency, count(*),
               count(*) filter (where is_present), 0, 0, 0, 0, 0, 0, 0
        from {mart_attendance} where parliament is null group by all
        union all
        select null, year(date), month(date), member_name, null, member_constituency, null, null,
               count(distinct date) filter (where topic_type not in ('WA', 'WANA')), count(distinct topic_id),
               count(*) filter (where is_primary_question), count(*), sum(count_speeches_words)::bigint,
               sum(count_speeches_sentences)::bigint, sum(count_speeches_syllables)::bigint
        from {mart_speeches}
        where parliament is null and not is_topic_procedural and length(member_name) > 0
              and not regexp_matches(lower(member_name), 'deputy|speaker|chairman')
        group by year(date), month(date), member_name, member_constituency"""
    sql["agg_pri_questions_topics_by_member"] = """
        select parliament, year(date) as year, month(date) as month, member_name, member_constituency,
               ministry_addressed, count(*) as count_pri_questions
        from {mart_speeches} where ministry_addressed is not null and is_primary_question and length(member_name) > 0
        group by all"""
    metrics = f"""
        select member_name, member_party, member_constituency, parliament,
               {rounded("case questions_in when 0 then 0 else questions / questions_in::double end", 2)}
                 as questions_per_sitting,
               round(case speeches when 0 then 0 else words / speeches end)::bigint as words_per_speech,
               {rounded("case questions_in when 0 then 0 else speeches / questions_in::double end", 2)}
                 as speeches_per_sitting,
               {rounded("score", 1)} as readability_score,
               case when member_party is not null and parliament is not null
                    then {rounded("100 * present / nullif(total, 0)", 1)} end as attendance,
               case when member_party is not null and parliament is not null
                    then {rounded("100 * spoken / nullif(present, 0)", 1)} end as participation
        from ("""
    level = """
        select a.member_name, a.member_party, {seat} as member_constituency, {parl} as parliament,
               sum(count_pri_questions) filter (where a.member_constituency is not null) as questions,
               sum(count_sittings_present) filter (where a.member_constituency is not null) as questions_in,
               sum(count_words) filter (where a.member_constituency is not null) as words,
               sum(count_speeches - count_pri_questions) filter (where a.member_constituency is not null) as speeches,
               sum(count_sittings_present) as present, sum(count_sittings_total) as total,
               sum(count_sittings_spoken) as spoken,
               (select avg(score) from {{readable_speeches}} r where r.member_name = a.member_name {match}) as score
        from {{agg_speech_metrics_by_member}} a group by {group} having count(a.member_constituency) > 0"""
    sql["readable_speeches"] = """
        select member_name, parliament,
               206.835::double - 1.015::double * (count_speeches_words / nullif(count_speeches_sentences, 0))
               - 84.6::double * (count_speeches_syllables / count_speeches_words) as score
        from {mart_speeches}
        where not (is_vernacular_speech or is_primary_question) and count_speeches_words > 0
              and member_constituency is not null and not ifnull(list_contains(member_appointments, 'Speaker'), false)"""
    sql["dash_by_member_metrics"] = (
        metrics
        + level.format(
            seat="a.member_constituency", parl="a.parliament::varchar", match="and r.parliament = a.parliament",
            group="a.member_name, a.member_party, a.member_constituency, a.parliament",
        )
        + " union all "
        + level.format(seat="'All'", parl="'All'", match="", group="a.member_name, a.member_party")
        + ")"
    )
    sql["dash_demographics"] = """
        select m.member_name, c.parliament, p.party, c.member_constituency, m.member_ethnicity, m.gender,
               m.member_birth_year, year(c.since) - m.member_birth_year as year_age_entered
        from {dim_members} m
        left join (select member_name, parliament, member_constituency, min(date) as since from {mart_attendance}
                   group by all having member_constituency is not null) c on c.member_name = m.member_name
        left join {sheet_party} p on p.member_name = m.member_name and p.parliament = c.parliament"""
    sql["dash_questions"] = """
        with asked as (select * from {mart_speeches} where is_primary_question
                       and not (member_party is null or ministry_addressed is null))
        select member_name, parliament::varchar as parliament, member_constituency, member_party, ministry_addressed,
               count(*) as count_questions_ministry from asked group by all
        union all
        select member_name, 'All', 'All', member_party, ministry_addressed, count(*) from asked
        group by member_name, member_party, ministry_addressed"""
    sql["dash_speech_lengths"] = """
        select count_speeches_words from {mart_speeches}
        where topic_type not in ('WS', 'BI') and not is_primary_question and member_name not in ('', 'Speaker')
              and member_constituency is not null"""
    sql["dash_topics"] = """
        with told as (
            select s.member_name, s.member_party, s.parliament, k.seat, d.topic_assigned
            from {speech_positions} d join {mart_speeches} s using (speech_id)
            join (select distinct member_name, member_party, parliament, member_constituency as seat
                  from {agg_speech_metrics_by_member} where member_constituency is not null) k
              on k.member_name = s.member_name and k.member_party = s.member_party and k.parliament = s.parliament)
        select parliament::varchar as parliament, member_party, seat as member_constituency, member_name, topic_assigned,
               count(*) as count_topic_speeches from told group by all
        union all
        select 'All', member_party, 'All', member_name, topic_assigned, count(*) from told
        group by member_party, member_name, topic_assigned"""
    return sql


def resolve(name: str, sql: dict[str, str], seen: dict[str, str]) -> None:
    """Add the CTEs behind a model, each after what it reads."""
    if name not in sql:
        as_ctes([name], seen)
        return
    if name in seen:
        return
    needs = [f for _, f, _, _ in Formatter().parse(sql[name]) if f]
    for need in dict.fromkeys(needs):
        resolve(need, sql, seen)
    seen[name] = sql[name].format(**{n: n if n in sql else cte(n) for n in needs})


def query_for(name: str, columns: str = "*", compat: bool = False) -> str:
    sql = model_sql(compat)
    seen: dict[str, str] = {}
    resolve(name, sql, seen)
    ctes = ",\n".join(f"{k} as materialized ({v})" for k, v in seen.items())
    return f"with {ctes}\nselect {columns} from {name}"


def _failures(check: Check, table: str) -> str:
    scope = f"({check.where})" if check.where else "true"
    listed = ", ".join(check.columns)
    if not check.is_row_local:
        known = f" and {listed} is not null" if check.kind == "unique" else ""
        return f"select count(*) from (select 1 from {table} where {scope}{known} group by {listed} having count(*) > 1)"
    if check.kind == "not_null":
        holds = f"{listed} is not null"
    elif check.kind == "expression_is_true":
        holds = check.expression
    else:
        limits = ((">", check.minimum), ("<", check.maximum))
        equal = "=" if check.inclusive else ""
        holds = " and ".join(f"{listed} {sign}{equal} {limit}" for sign, limit in limits if limit is not None)
    return f"select count(*) from {table} where {scope} and not ({holds})"


def report_for(checks: Mapping[str, Sequence[Check]]) -> str:
    """All checks of all tables: how many rows or keys fail each."""
    sql = model_sql(False)
    seen: dict[str, str] = {}
    lines = []
    for table, rules in checks.items():
        resolve(table, sql, seen)
        for rule in rules:
            name = rule.name.replace("'", "''")
            at = table if table in sql else cte(table)
            lines.append(f"select '{table}' as table_name, '{name}' as check_name, '{rule.severity}' as severity, ({_failures(rule, at)}) as failures")
    ctes = ",\n".join(f"{k} as materialized ({v})" for k, v in seen.items())
    union = "\nunion all ".join(lines)
    return f"with {ctes}\nselect *, case when failures = 0 then 'pass' else severity end as status from ({union})"
