"""Every warehouse model, run over raw tables derived from the given ones."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry.catalog import QUERIES, SQL, portable
from registry.model_sql import model_sql, query_for, report_for
from registry.raw_tables import AS_OF, RawTables
from rostrum.plans.dashboards import speech_length_spread
from rostrum.plans.marts import speeches_on_date
from rostrum.plans.warehouse import CHECKS, MODELS, RAW_TABLES, SHEET_CHECKS, Warehouse
from rostrum.sources.schemas import SHEETS, STAGED_SHEETS
from rostrum.sources.tables import kept_aside, shared_folder

_INTERVAL = ["effective_from_date", "effective_to_date"]
_BILL = ["first_reading_date", "second_reading_date", "passed_date"]
_DATES = {
    "stg_attendance": ["date"], "stg_sittings": ["date", "datetime"], "stg_speeches": ["date"], "stg_topics": ["date"],
    "stg_bills_introduced": _BILL, "stg_members_member_of_parliament": _INTERVAL,
    "stg_members_office_holding": _INTERVAL, "stg_members_select_committee": _INTERVAL,
    "dim_prep_member_positions": _INTERVAL, "dim_members": ["earliest_sitting", "latest_sitting"],
    "dim_topics": ["date"], "fact_attendance": ["date"], "fact_sittings": ["date", "datetime"],
    "fact_speeches": ["date"], "fact_bills_introduced": _BILL, "fact_bill_activity": ["date"],
    "mart_prep_appointment_by_date": ["date"],
    "mart_prep_bill_activity": ["first_reading_date", "second_reading_date", "third_reading_date"],
    "mart_attendance": ["date"], "mart_speeches": ["date"], "mart_bills": [*_BILL, "third_reading_date"],
    "stg_gsheet_member_image_link": ["accessed_at"], "stg_gsheet_member_name_link": ["accessed_at"],
    "stg_gsheet_member_of_parliament": [*_INTERVAL, "accessed_at"],
    "stg_gsheet_office_holding": [*_INTERVAL, "accessed_at"], "stg_gsheet_year_of_birth": ["accessed_at"],
}
_LISTS = {
    "stg_members_select_committee": ["member_committee_position"],
    "mart_prep_appointment_by_date": ["appointments"], "mart_speeches": ["member_appointments"],
}
# models in which a reading of the rules is switched by ``compat``
_SWITCHED = [
    "stg_members_member_of_parliament", "dim_prep_member_positions", "dim_members", "mart_attendance", "mart_speeches",
    "mart_bills", "agg_speech_metrics_by_member", "dash_by_member_metrics", "dash_topics", "dash_demographics",
]


_WAREHOUSES: dict[tuple, Warehouse] = {}
_RAW: dict[tuple, dict] = {}


def store_raw_tables(spark, folder) -> None:
    """Write the derived raw tables once; warehouses of this session and folder read them from then on."""
    derived = RawTables(spark, folder)
    names = [*RAW_TABLES, *(f"sheet_{s}" for s in SHEETS)]
    _RAW[spark.sparkContext.applicationId, folder] = {name: kept_aside(derived[name]) for name in names}


def warehouse(spark, folder, compat=False) -> Warehouse:
    """One warehouse per session, data folder and reading; its tables are built once."""
    key = (spark.sparkContext.applicationId, folder, compat)
    if key not in _WAREHOUSES:
        kept = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        raw = _RAW.get(key[:2]) or RawTables(spark, folder)
        _WAREHOUSES[key] = Warehouse(raw, F.to_date(F.lit(AS_OF)), compat, kept)
    return _WAREHOUSES[key]


def forget_warehouses() -> None:
    """Build everything anew from here on."""
    _WAREHOUSES.clear()


def _shown(model: str) -> str:
    texts = [f"{c}::varchar as {c}" for c in _DATES.get(model, [])]
    texts += [f"array_to_string({c}, '|') as {c}" for c in _LISTS.get(model, [])]
    return f"* replace ({', '.join(texts)})" if texts else "*"


def _register(model: str, compat: bool = False) -> None:
    key = f"{model}_compat" if compat else model
    QUERIES[key] = lambda spark, d: portable(warehouse(spark, d, compat).plan(model))
    SQL[key] = query_for(model, _shown(model), compat)


for _sheet in STAGED_SHEETS:
    QUERIES[_sheet] = lambda spark, d, s=_sheet: portable(warehouse(spark, d).sheet(s))
    SQL[_sheet] = query_for(_sheet, _shown(_sheet))
for _name in MODELS:
    _register(_name)
for _name in _SWITCHED:
    _register(_name, compat=True)

QUERIES["extract_speeches_on_date"] = lambda spark, d: speeches_on_date(
    warehouse(spark, d).laid_out("mart_speeches"), "2016-03-04"
)
SQL["extract_speeches_on_date"] = query_for(
    "mart_speeches",
    "speech_id, member_name, member_party, speech_text, count_speeches_words, topic_title",
) + " where date = date '2016-03-04'"

QUERIES["spread_of_speech_lengths"] = lambda spark, d: speech_length_spread(warehouse(spark, d).mart_speeches)
SQL["spread_of_speech_lengths"] = query_for(
    "mart_speeches",
    "member_party, count(*) as n, min(count_speeches_words)::double as min, "
    "quantile_cont(count_speeches_words::double, 0.25) as q1, quantile_cont(count_speeches_words::double, 0.5) as median, "
    "quantile_cont(count_speeches_words::double, 0.75) as q3, max(count_speeches_words)::double as max",
) + " where member_party is not null group by member_party"

QUERIES["quality_report_of_all_models"] = lambda spark, d: warehouse(spark, d).quality_report()
SQL["quality_report_of_all_models"] = report_for(CHECKS | {f"sheet_{s}": c for s, c in SHEET_CHECKS.items()})
