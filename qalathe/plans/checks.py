"""Building blocks of check tables: aggregates of many suites in one pass, then one row per check."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import beside, literal_rows


@dataclass
class Suite:
    """A group of checks over one table.

    ``measures`` are aggregates over all rows; ``sides`` are one-row tables that need a grouping
    of their own; ``checks`` turn both into rows and leave status null where nothing is to report.
    """

    measures: dict[str, Column] = field(default_factory=dict)
    sides: list[DataFrame] = field(default_factory=list)
    checks: list[Column] = field(default_factory=list)
    facts: list[tuple] = field(default_factory=list)


def check_row(ordinal, check, column, status, value, threshold, message) -> Column:
    """One check. ``status`` is pass, warn, fail or null; a failure has severity error."""
    values = {
        "check": F.lit(check), "column": F.lit(column).cast("string"), "status": status,
        "severity": F.when(status == "fail", "error").when(status == "warn", "warning")
        .when(status == "pass", "info"),
        "value": value, "threshold": F.lit(threshold).cast("double"), "message": message,
    }
    kinds = {f.name: f.dataType for f in S.CHECKS.fields}
    return F.struct(
        F.lit(ordinal).cast("int").alias("ordinal"),
        *[v.cast(kinds[k]).alias(k) for k, v in values.items()],
    )


def measured(df: DataFrame, suites: list[Suite]) -> DataFrame:
    """One row with every measure of the suites, from one pass over the table plus the sides."""
    measures: dict[str, Column] = {}
    sides: list[DataFrame] = []
    for suite in suites:
        measures.update(suite.measures)
        sides += suite.sides
    total = {"total_rows": F.count(F.lit(1))}
    row = df.agg(*[c.alias(name) for name, c in {**total, **measures}.items()])
    return reduce(beside, sides, row)


def run_suites(df: DataFrame, suites: list[Suite]) -> DataFrame:
    """The check table of all suites."""
    facts = [fact for suite in suites for fact in suite.facts]
    checks = [c for suite in suites for c in suite.checks]
    parts = []
    if facts:
        parts.append(literal_rows(df.sparkSession, facts, S.CHECKS))
    if checks:
        rows = measured(df, suites).select(F.inline(F.array(*checks)))
        parts.append(rows.where(F.col("status").isNotNull()))
    return reduce(DataFrame.unionByName, parts)


def percent(ratio: Column) -> Column:
    """A ratio as text with one decimal, as ``{:.1%}``."""
    return F.concat(F.replace(F.format_number(ratio * 100, 1), F.lit(","), F.lit("")), F.lit("%"))


def share(part: Column, whole: Column) -> Column:
    """Ratio, null over an empty table: comparisons with it then hold for neither side."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def verdict(checks: DataFrame) -> DataFrame:
    """One row: valid unless a check of severity error failed, and the counts per status."""
    def n(condition):
        return F.count_if(condition)

    failed = F.col("status") == "fail"
    return checks.agg(
        (n(failed & (F.col("severity") == "error")) == 0).alias("is_valid"),
        n(F.col("status").isin("pass", "fail")).alias("total_checks"),
        n(F.col("status") == "pass").alias("passed_count"),
        n(failed).alias("failed_count"),
        n(F.col("status") == "warn").alias("warning_count"),
    )
