"""Data-quality rules: all rules of a table in one aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named check: what it measures and the condition on the measured value."""

    name: str
    kind: str
    column: str | None = None
    bound: float = 0.0

    def measure(self) -> Column:
        if self.kind == "rows":
            return F.count("*")
        if self.kind == "missing":
            return F.count_if(F.col(self.column).isNull())
        if self.kind == "nan":
            return F.count_if(F.isnan(self.column))
        if self.kind in ("min", "max"):
            return (F.min if self.kind == "min" else F.max)(self.column)
        raise ValueError(f"rule {self.name}: cannot measure {self.kind!r}")

    def passed(self, value: Column) -> Column:
        if self.kind == "rows":
            return value > self.bound
        if self.kind == "min":
            return value >= self.bound
        if self.kind == "max":
            return value <= self.bound
        return value == 0


def has_rows() -> Rule:
    return Rule("row_count > 0", "rows")


def no_missing(column: str) -> Rule:
    return Rule(f"missing_count({column}) = 0", "missing", column)


def no_nan(column: str) -> Rule:
    """NaN counts as present; the models' decimals cannot hold it."""
    return Rule(f"nan_count({column}) = 0", "nan", column)


def not_null(column: str) -> Rule:
    return Rule(f"not_null({column})", "missing", column)


def at_least(column: str, bound: float) -> Rule:
    return Rule(f"min({column}) >= {bound:g}", "min", column, bound)


def at_most(column: str, bound: float) -> Rule:
    return Rule(f"max({column}) <= {bound:g}", "max", column, bound)


def unique(column: str) -> Rule:
    """Counts values that occur more than once; NULLs are ignored."""
    return Rule(f"unique({column})", "unique", column)


def _result(table: str, rule: Rule, value: Column) -> Column:
    value = value.cast("double")
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(rule.name).alias("check_name"),
        value.alias("value"),
        rule.passed(value).alias("passed"),
    )


def _duplicates(df: DataFrame, table: str, rule: Rule) -> DataFrame:
    repeated = (
        df.filter(F.col(rule.column).isNotNull())
        .groupBy(rule.column)
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .agg(F.count("*").alias("value"))
    )
    return repeated.select(F.inline(F.array(_result(table, rule, F.col("value")))))


def check(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: ``table_name, check_name, value, passed``.

    ``passed`` is NULL where there is nothing to measure (min of no rows). Rules on
    single rows share one aggregate; each ``unique`` rule adds a grouping by its
    column, whose partial counts leave at most one row per value and task.
    """
    if not rules:
        raise ValueError(f"{table}: no rules to check")
    plain = [r for r in rules if r.kind != "unique"]
    results = []
    if plain:
        measured = df.agg(*[r.measure().alias(f"v{i}") for i, r in enumerate(plain)])
        rows = F.array(*[_result(table, r, F.col(f"v{i}")) for i, r in enumerate(plain)])
        results.append(measured.select(F.inline(rows)))
    results += [_duplicates(df, table, r) for r in rules if r.kind == "unique"]
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def check_while_writing(df: DataFrame, table: str, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """Measure the rules during whatever action is run on the returned frame.

    No extra pass. After the action, ``observed_results`` turns the observation
    into result rows. ``unique`` needs a grouping and is not possible here.
    """
    if any(r.kind == "unique" for r in rules):
        raise ValueError("unique rules need their own pass: use check()")
    seen = Observation(table)
    return df.observe(seen, *[r.measure().cast("double").alias(r.name) for r in rules]), seen


def observed_results(seen: Observation, df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """Result rows of a finished ``check_while_writing``, one per rule."""
    values = seen.get
    one = df.sparkSession.range(1)
    rows = [_result(table, r, F.lit(values[r.name])) for r in rules]
    return one.select(F.inline(F.array(*rows)))
