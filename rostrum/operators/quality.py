"""Data-quality checks as Spark jobs.

A check list is plain data. ``violations`` gives the offending rows of one check and
``report`` the number of failures of many: all checks of a table share one pass and one
grouped count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One rule. ``severity`` is 'error' or 'warn'; ``where`` limits the rows it covers."""

    kind: str
    columns: tuple[str, ...] = ()
    expression: str | None = None
    minimum: float | None = None
    maximum: float | None = None
    inclusive: bool = True
    where: str | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.kind}({self.expression or ', '.join(self.columns)})"

    @property
    def is_row_local(self) -> bool:
        return self.kind not in ("unique", "unique_combination")

    def scope(self) -> Column:
        return F.expr(self.where) if self.where else F.lit(True)

    def fails(self) -> Column:
        """The failure condition of a row-local check; an undecided rule does not fail."""
        if self.kind == "not_null":
            return F.col(self.columns[0]).isNull()
        if self.kind == "expression_is_true":
            return ~F.expr(self.expression)
        value, inside = F.col(self.columns[0]), F.lit(True)
        if self.minimum is not None:
            inside &= value >= self.minimum if self.inclusive else value > self.minimum
        if self.maximum is not None:
            inside &= value <= self.maximum if self.inclusive else value < self.maximum
        return ~inside


def not_null(column: str, **kw) -> Check:
    return Check("not_null", (column,), **kw)


def unique(column: str, **kw) -> Check:
    return Check("unique", (column,), **kw)


def unique_combination(*columns: str, **kw) -> Check:
    return Check("unique_combination", columns, **kw)


def accepted_range(column: str, **kw) -> Check:
    return Check("accepted_range", (column,), **kw)


def expression_is_true(expression: str, **kw) -> Check:
    return Check("expression_is_true", expression=expression, **kw)


def violations(df: DataFrame, check: Check) -> DataFrame:
    """Failing rows, or for uniqueness the repeated keys with their number of rows.

    A single unique column ignores NULLs; a combination counts them as equal.
    """
    rows = df.filter(check.scope())
    if check.is_row_local:
        return rows.filter(check.fails())
    if check.kind == "unique":
        rows = rows.filter(F.col(check.columns[0]).isNotNull())
    return rows.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def _entry(number: int, check: Check) -> Column:
    """What a row adds to the count of a check: its key's hash if that must be unique, nothing but the number if it fails."""
    if check.is_row_local:
        entered, keys = check.fails(), [F.lit(0).cast("bigint")] * 2
    else:
        entered = F.col(check.columns[0]).isNotNull() if check.kind == "unique" else F.lit(True)
        # the hash passes over NULL, so that is told apart by a column of its own
        columns = [c for name in check.columns for c in (F.col(name).isNull(), F.col(name))]
        keys = [F.xxhash64(F.lit(seed), *columns) for seed in (0, 1)]
    entry = F.struct(F.lit(number).alias("check"), keys[0].alias("key"), keys[1].alias("also"))
    return F.when(check.scope() & entered, entry)


def report(df: DataFrame, checks: Sequence[Check], table: str = "") -> DataFrame:
    """One row per check: table, name, severity, failures and status.

    Rows are read once. Each lists the keys that must be unique and the checks it fails; these are counted together, combined
    before the shuffle, so that neither a repeated key nor a check that all rows fail is a hot one. Keys are told apart by
    two 64-bit hashes.
    """
    entries = F.filter(F.array(*[_entry(i, c) for i, c in enumerate(checks)]), lambda e: e.isNotNull())
    counted = df.select(F.inline(entries)).groupBy("check", "key", "also").agg(F.count(F.lit(1)).alias("n"))
    local = F.col("check").isin([i for i, c in enumerate(checks) if c.is_row_local])
    failures = F.sum(F.when(local, F.col("n")).otherwise((F.col("n") > 1).cast("bigint"))).alias("failures")
    found = counted.groupBy("check").agg(failures)
    lines = df.sparkSession.createDataFrame([(i, c.name, c.severity) for i, c in enumerate(checks)], "no int, check_name string, severity string")
    failed = F.coalesce("failures", F.lit(0)).cast("bigint")
    return lines.join(found, lines["no"] == found["check"], "left").select(
        F.lit(table).alias("table_name"), "check_name", "severity", failed.alias("failures"),
        F.when(failed == 0, "pass").otherwise(F.col("severity")).alias("status"),
    )
