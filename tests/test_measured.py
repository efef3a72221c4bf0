"""Rules counted while a table is written."""

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import quality
from taxaloom.plans import checklist as plans

ROWS = [(i, None if i % 10 == 0 else f"n{i % 7}", "a" if i % 3 else "b") for i in range(200)]


def rules():
    return [
        quality.not_null("name", "id"),
        quality.in_values("kind", ["a"], "id"),
        quality.predicate(F.col("id") < 0, "below_zero", "id"),
    ]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(ROWS, "id long, name string, kind string").repartition(6)


def test_counts_equal_the_rules_on_the_rows(frame):
    found = quality.write_measured(frame, rules())
    assert found.broken == [20, 67, 0]
    assert sorted(map(tuple, found.rows.collect()), key=str) == sorted(ROWS, key=str)
    want = quality.row_rules(frame, rules())
    assert sorted(map(tuple, found.violations().collect())) == sorted(map(tuple, want.collect()))
    counted = {tuple(r) for r in found.counts().collect()}
    assert counted == {tuple(r) for r in quality.count_violations(want).collect()}


def test_unbroken_rules_read_nothing(frame):
    found = quality.write_measured(frame.where("name is not null and kind = 'a'"), rules())
    assert found.broken == [0, 0, 0]
    plan = found.violations()._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and found.violations().count() == 0 and found.counts().count() == 0
    one = quality.write_measured(frame.where("name is not null"), rules())
    assert {r.rule for r in one.violations().collect()} == {"kind_in_values"}


def test_empty_table(frame):
    found = quality.write_measured(frame.where("false"), rules())
    assert found.broken == [0, 0, 0] and found.violations().count() == 0 and found.rows.count() == 0


def test_keys_that_repeat(frame):
    found = quality.write_measured_keys(frame, ["name", "kind"])
    want = quality.rule_cardinality(frame, ["name", "kind"])
    assert sorted(map(tuple, found.violations().collect())) == sorted(map(tuple, want.collect()))
    first = {}
    for i, name, kind in ROWS:
        if name is not None:
            first.setdefault((name, kind), i)
    assert {(r.name, r.kind): r.id for r in found.rows.collect()} == first
    alone = quality.write_measured_keys(frame.select("name"), ["name"])
    assert alone.broken == [len({n for _, n, _ in ROWS} - {None})] and alone.rows.columns == ["name", "_times"]


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parquet")


def test_violations_of_a_clean_checklist_need_no_scan_for_row_rules(spark, mini):
    """One scan less per table written on the way, and the same rows."""
    written = plans.write_checklist(mini)
    result = plans.checklist_to_taxa(written)
    assert [sum(m.broken) for m in result.measured] == [0, 0, 0]
    fewer = plans.taxa_violations(result)
    every = plans.taxa_violations(result._replace(measured=[]))
    row_rules = [
        (result.checklist, plans.checklist_row_rules()),
        (result.assigned, [plans.parents.parent_missing()]),
        (result.taxa, plans.taxa_row_rules(result.taxa.columns)),
    ]
    for df, own in row_rules:
        every = every.unionByName(quality.row_rules(df, own))
    assert fewer.count() == every.count() == 0
    assert scans(every) - scans(fewer) == 4  # the checklist is listed twice, once by taxa_violations itself
