"""Each rule with a passing, a failing and an empty frame."""

import pytest

from sensorloom.operators import quality as q
from sensorloom.plans.suites import MODEL_CHECKS, RAW_CHECKS, run_suite

GOOD, BAD, EMPTY = [("a", 1.0), ("b", 500.0)], [("a", -0.1), (None, 500.1), ("a", None)], []


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v double")


@pytest.mark.parametrize(
    "rule, good, bad, empty",
    [
        (q.has_rows(), (2.0, True), (3.0, True), (0.0, False)),
        (q.no_missing("v"), (0.0, True), (1.0, False), (0.0, True)),
        (q.not_null("k"), (0.0, True), (1.0, False), (0.0, True)),
        (q.at_least("v", 0), (1.0, True), (-0.1, False), (None, None)),
        (q.at_most("v", 500), (500.0, True), (500.1, False), (None, None)),
        (q.unique("k"), (0.0, True), (1.0, False), (0.0, True)),
    ],
)
def test_rule(spark, rule, good, bad, empty):
    for rows, want in ((GOOD, good), (BAD, bad), (EMPTY, empty)):
        row = q.check(frame(spark, rows), "t", [rule]).head()
        assert (row.table_name, row.check_name, (row.value, row.passed)) == ("t", rule.name, want)


def test_unique_ignores_nulls(spark):
    assert q.check(frame(spark, [(None, 1.0), (None, 2.0)]), "t", [q.unique("k")]).head().passed


def test_suites_are_complete():
    # Eleven, and two on NaN, which a decimal cannot hold.
    assert sum(len(rules) for rules in RAW_CHECKS.values()) == 13
    kinds = [r.kind for rules in MODEL_CHECKS.values() for r in rules]
    assert (kinds.count("missing"), kinds.count("unique")) == (12, 2)


def test_suite_reports_every_rule(spark):
    suite = {"t": [q.has_rows(), q.unique("k"), q.at_least("v", 0)]}
    got = {r.check_name: r.passed for r in run_suite({"t": frame(spark, BAD)}, suite).collect()}
    assert got == {"row_count > 0": True, "unique(k)": False, "min(v) >= 0": False}


def test_checks_during_a_write_need_no_extra_pass(spark, tmp_path):
    rules = [q.has_rows(), q.no_missing("k"), q.at_least("v", 0)]
    df, seen = q.check_while_writing(frame(spark, BAD), "t", rules)
    df.write.parquet(str(tmp_path / "out"))
    rows = q.observed_results(seen, df, "t", rules).collect()
    assert rows == q.check(frame(spark, BAD), "t", rules).collect()
    with pytest.raises(ValueError):
        q.check_while_writing(df, "t", [q.unique("k")])


def test_rules_that_make_no_sense_are_refused(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="no rules"):
        q.check(df, "t", [])
    with pytest.raises(ValueError, match="cannot measure"):
        q.check(df, "t", [q.Rule("r", "median", "id")])


def test_nan_is_counted(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    row = q.check(df, "t", [q.no_nan("x")]).head()
    assert (row.value, row.passed) == (1.0, False)
