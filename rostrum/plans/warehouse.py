"""All models of the warehouse, composed from one another.

Each model is a property that builds its DataFrame on first use. Without a folder
everything stays lazy; with one, tables are stored as they are built and read back, so
that later models neither recompute them nor depend on executors that held them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.operators import quality as q
from rostrum.plans import aggregates, dashboards, dimensions, facts, marts, staging
from rostrum.sources.schemas import SHEETS, STAGED_SHEETS
from rostrum.sources.tables import by_month, load_table, materialise, part_count, read_sheet, topic_type_seed

RAW_TABLES = (
    "attendance", "sittings", "speeches", "topics", "members_full_name", "members_image",
    "members_member_of_parliament", "members_office_holding", "members_select_committee",
    "members_year_of_birth", "highest_topic", "topic_names", "bills_introduced", "speech_positions",
)

# layer -> how its models are kept; positions are stored because four models read them
LAYERS = {
    "stg": "view", "dim_prep": "table", "dim": "table", "fact": "table", "mart_prep": "table", "mart": "table",
    "agg": "table", "dash": "table",
}

# tables laid out by month of a date, how rows stand within their files, and whether the model itself brings months together
LAYOUTS = {"mart_speeches": ("date", ["date", "speech_id"], True)}

ROWS = 250_000  # of a large stored table, in a part that its rows are brought together in, or more (part_count)


def read_sources(spark: SparkSession, table_folder: str, sheet_folder: str) -> dict[str, DataFrame]:
    """Stored raw tables and exported sheets (``sheet_folder/<sheet>.csv``)."""
    raw = {t: load_table(spark, table_folder, t) for t in RAW_TABLES}
    return raw | {f"sheet_{s}": read_sheet(spark, f"{sheet_folder}/{s}.csv", c) for s, c in SHEETS.items()}


def _model(build: Callable[["Warehouse"], DataFrame]) -> property:
    name = build.__name__

    @wraps(build)
    def once(self: Warehouse) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._keep(name, build(self))
        return self._built[name]

    return property(once)


class Warehouse:
    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        as_of: Column | None = None,
        compat: bool = False,
        folder: str | None = None,
    ):
        self.raw, self.as_of, self.compat, self.folder = raw, as_of, compat, folder
        self._built: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}  # as they lie in their folders, with columns of their own

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        if self.folder is None:
            return df
        columns = df.columns
        if name == "fact_speeches":  # what is told of texts, and a row id, are stored beside them
            df = facts.worded_speeches(df).withColumn("row_id", F.monotonically_increasing_id())
        layer = max((x for x in LAYERS if name.startswith(x)), key=len)
        date, cluster, together = LAYOUTS.get(name, (None, [], False))
        layout = by_month(date) if date else None
        self._stored[name] = materialise(df, name, LAYERS[layer], self.folder, layout, cluster, together)
        return self._stored[name].select(*columns)

    def _kept(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that several models read, which is no model itself."""
        if name not in self._built:
            self._built[name] = self._keep(name, build())
        return self._built[name]

    def _parts(self, stored: DataFrame) -> int | None:
        """So many parts that none outgrows a task; counting a stored one reads no values."""
        return None if self.folder is None else part_count(stored.sparkSession, stored.count(), ROWS)

    def _by_month(self, stored: DataFrame) -> tuple[int, int]:
        """So many parts for the rows of a stored table by month, and so many shares of a month that parts come out alike."""
        most = stored.groupBy(F.year("date"), F.month("date")).count().agg(F.max("count")).first()[0] or 1
        return self._parts(stored), -(-most // max(1, ROWS // 8))

    @property
    def histories(self) -> DataFrame:
        return self._kept(
            "mart_prep_member_histories",
            lambda: marts.member_histories(self.dim_members, self.party, self.dim_prep_member_positions, self.as_of),
        )

    def laid_out(self, name: str) -> DataFrame:
        """A stored model with the columns of its layout, for filters that skip files."""
        model = getattr(self, name)
        return self._stored.get(name, model)

    def sheet(self, staged: str) -> DataFrame:
        return staging.stg_sheet(staged, self.raw[f"sheet_{STAGED_SHEETS[staged][0]}"])

    @property
    def name_map(self) -> DataFrame:
        return self.raw["sheet_member_name_mapping"]

    @property
    def party(self) -> DataFrame:
        return self.sheet("stg_gsheet_member_party")

    @_model
    def stg_attendance(self):
        return staging.stg_attendance(self.raw["attendance"], self.name_map)

    @_model
    def stg_sittings(self):
        return staging.stg_sittings(self.raw["sittings"])

    @_model
    def stg_speeches(self):
        return staging.stg_speeches(self.raw["speeches"], self.name_map)

    @_model
    def stg_topics(self):
        return staging.stg_topics(self.raw["topics"])

    @_model
    def stg_topic_group(self):
        return staging.stg_topic_group(self.raw["highest_topic"])

    @_model
    def stg_topic_names(self):
        return staging.stg_topic_names(self.raw["topic_names"])

    @_model
    def stg_bills_introduced(self):
        return staging.stg_bills_introduced(self.raw["bills_introduced"])

    @_model
    def stg_members_full_name(self):
        return staging.stg_members_full_name(
            self.raw["members_full_name"], self.sheet("stg_gsheet_member_name_link")
        )

    @_model
    def stg_members_image(self):
        return staging.stg_members_image(self.raw["members_image"], self.sheet("stg_gsheet_member_image_link"))

    @_model
    def stg_members_year_of_birth(self):
        return staging.stg_members_year_of_birth(
            self.raw["members_year_of_birth"], self.sheet("stg_gsheet_year_of_birth")
        )

    @_model
    def stg_members_member_of_parliament(self):
        return staging.stg_members_member_of_parliament(
            self.raw["members_member_of_parliament"], self.sheet("stg_gsheet_member_of_parliament"), self.compat
        )

    @_model
    def stg_members_office_holding(self):
        return staging.stg_members_office_holding(
            self.raw["members_office_holding"], self.sheet("stg_gsheet_office_holding")
        )

    @_model
    def stg_members_select_committee(self):
        return staging.stg_members_select_committee(self.raw["members_select_committee"], self.stg_sittings)

    @_model
    def dim_prep_member_positions(self):
        return dimensions.dim_prep_member_positions(
            self.stg_members_member_of_parliament, self.stg_members_office_holding, self.stg_members_select_committee
        )

    @_model
    def dim_members(self):
        # the stored fact has the staged rows, which need not be cleaned again
        return dimensions.dim_members(
            self.fact_attendance,
            self.sheet("stg_gsheet_member_gender"),
            self.stg_members_year_of_birth,
            self.sheet("stg_gsheet_member_ethnicity"),
            self.party,
            self.stg_members_full_name,
            self.stg_members_image,
            self.dim_prep_member_positions,
            self._parts(self.fact_attendance),
        )

    @_model
    def dim_topics(self):
        seed = topic_type_seed(self.stg_topics.sparkSession)
        return dimensions.dim_topics(self.stg_topics, seed, self.stg_topic_group, self.stg_topic_names)

    @_model
    def fact_attendance(self):
        return facts.fact_attendance(self.stg_attendance)

    @_model
    def fact_sittings(self):
        return facts.fact_sittings(self.stg_sittings)

    @_model
    def fact_speeches(self):
        return facts.fact_speeches(self.stg_speeches)

    @_model
    def fact_bills_introduced(self):
        return facts.fact_bills_introduced(self.stg_bills_introduced)

    @_model
    def fact_bill_activity(self):
        return facts.fact_bill_activity(self.dim_topics, self.fact_speeches)

    @_model
    def mart_prep_appointment_by_date(self):
        return marts.mart_prep_appointment_by_date(self.fact_sittings, self.dim_prep_member_positions, self.as_of)

    @_model
    def mart_prep_bill_activity(self):
        return marts.mart_prep_bill_activity(self.fact_bill_activity)

    @_model
    def mart_attendance(self):
        return marts.mart_attendance(
            self.fact_attendance, self.fact_sittings, self.dim_members, self.party, self.dim_prep_member_positions,
            self.as_of, self.histories, self._parts(self.fact_attendance),
        )

    @_model
    def mart_speeches(self):
        speeches, stored = self.fact_speeches, {}
        if self.folder is not None:
            rows = self._stored["fact_speeches"]
            speeches = rows.drop("text")
            told = lambda: marts.topics_told(speeches, self.dim_topics, self.fact_sittings, self.histories)
            about = self._kept("mart_prep_topics_told", told)
            stored = dict(texts=rows, histories=self.histories, about=about, by_month=self._by_month(rows))
        return marts.mart_speeches(
            speeches, self.dim_topics, self.fact_sittings, self.dim_members, self.party,
            self.dim_prep_member_positions, as_of=self.as_of, compat=self.compat, **stored,
        )

    @_model
    def mart_bills(self):
        return marts.mart_bills(self.fact_bills_introduced, self.mart_prep_bill_activity, self.compat)

    @_model
    def agg_speech_metrics_by_member(self):
        return aggregates.agg_speech_metrics_by_member(
            self.mart_speeches, self.mart_attendance, self.party, parts=self._parts(self.mart_attendance)
        )

    @_model
    def agg_pri_questions_topics_by_member(self):
        return aggregates.agg_pri_questions_topics_by_member(self.mart_speeches)

    @_model
    def dash_by_member_metrics(self):
        return dashboards.dash_by_member_metrics(self.agg_speech_metrics_by_member, self.mart_speeches)

    @_model
    def dash_demographics(self):
        return dashboards.dash_demographics(self.dim_members, self.mart_attendance, self.party)

    @_model
    def dash_questions(self):
        return dashboards.dash_questions(self.mart_speeches)

    @_model
    def dash_speech_lengths(self):
        return dashboards.dash_speech_lengths(self.mart_speeches)

    @_model
    def dash_topics(self):
        return dashboards.dash_topics(
            self.raw["speech_positions"], self.mart_speeches, self.agg_speech_metrics_by_member
        )

    def plan(self, name: str) -> DataFrame:
        """A model itself left lazy, on top of kept upstream models."""
        return vars(type(self))[name].fget.__wrapped__(self)

    def build_all(self) -> dict[str, DataFrame]:
        """Every model; with a folder this stores all tables."""
        return {name: getattr(self, name) for name in MODELS}

    def quality_report(self) -> DataFrame:
        """Failures of all checks declared for models and spreadsheets."""
        parts = [q.report(getattr(self, model), checks, model) for model, checks in CHECKS.items()]
        parts += [q.report(self.raw[f"sheet_{s}"], checks, f"sheet_{s}") for s, checks in SHEET_CHECKS.items()]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


MODELS = [n for n in vars(Warehouse) if n.startswith(tuple(f"{x}_" for x in LAYERS))]


def _key(column: str) -> list[q.Check]:
    return [q.not_null(column), q.unique(column)]


_POSITIVE = dict(minimum=0, inclusive=False, severity="warn", where="count_characters != 0")

# The checks declared for each model.
CHECKS: dict[str, list[q.Check]] = {
    "stg_attendance": [q.unique_combination("date", "member_name")],
    "stg_sittings": _key("date"),
    "stg_speeches": _key("speech_id"),
    "stg_topics": _key("topic_id"),
    "stg_topic_group": _key("topic_id"),
    "stg_topic_names": _key("topic_group_id"),
    "stg_bills_introduced": _key("bill_number"),
    "stg_members_full_name": _key("member_name"),
    "stg_members_image": _key("member_name"),
    "stg_members_year_of_birth": _key("member_name"),
    "stg_members_member_of_parliament": [
        q.unique_combination("member_name", "member_constituency", "effective_from_date")
    ],
    "stg_members_office_holding": [q.unique_combination("member_name", "member_appointment", "effective_from_date")],
    "stg_members_select_committee": [q.unique_combination("member_name", "member_committee", "parliament", "session")],
    "dim_members": _key("member_name"),
    "dim_topics": _key("topic_id")
    + [q.not_null("section_type"), q.not_null("section_type_name"), q.not_null("topic_group_id", severity="warn")],
    "fact_attendance": [q.unique_combination("date", "member_name")],
    "fact_bill_activity": [q.unique_combination("date", "topic_id", "reading")],
    "fact_bills_introduced": _key("bill_number"),
    "fact_sittings": _key("date"),
    "fact_speeches": _key("speech_id")
    + [
        q.expression_is_true("count_characters >= count_words", severity="warn", where="count_characters != 0"),
        q.accepted_range("count_words", **_POSITIVE),
        q.accepted_range("count_sentences", **_POSITIVE),
        q.accepted_range("count_syllables", **_POSITIVE),
    ],
    "mart_attendance": [q.unique_combination("date", "member_name")],
    "mart_speeches": _key("speech_id"),
    "mart_bills": [q.unique_combination("year", "title", where="bill_number is null"), q.unique("bill_number")],
}

# The checks declared for the spreadsheets.
SHEET_CHECKS: dict[str, list[q.Check]] = {
    "member_name_mapping": [q.unique("possible_variation")],
    "member_image_link": [q.unique("member_name")],
    "party": [q.unique_combination("member_name", "party", "parliament")],
    "member_name_link": [q.unique("member_name")],
    "gender": [q.unique("member_name")],
}
