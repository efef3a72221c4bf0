import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from taxaloom.operators import windows


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(1)
    # user 0 holds a third of all rows, and one key is null
    rows = [
        (i, 0 if rng.random() < 1 / 3 else rng.choice([1, 2, 3, None]), rng.choice([None, None, None, i * 10]))
        for i in range(1, 401)
    ]
    return spark.createDataFrame(rows, "pos long, user int, v long").repartition(5).cache()


def ordered(df, *columns):
    return [tuple(r) for r in df.orderBy("pos").select(*columns).collect()]


@pytest.mark.parametrize("bucket", [1, 3, 7, 50, 10_000])
@pytest.mark.parametrize("keys", [[], ["user"]])
def test_carry_forward_equals_single_window(events, bucket, keys):
    w = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = events.withColumn("v", F.last("v", True).over(w))
    got = windows.carry_forward(events, ["v"], "pos", keys, bucket)
    assert ordered(got, "pos", "user", "v") == ordered(want, "pos", "user", "v")


@pytest.mark.parametrize("bucket", [1, 3, 7, 10_000])
@pytest.mark.parametrize("keys", [[], ["user"]])
def test_next_value_equals_lead(events, bucket, keys):
    w = Window.partitionBy(*keys).orderBy("pos")
    want = events.withColumn("n", F.lead("v").over(w))
    got = windows.next_value(events, "v", "pos", "n", keys, bucket)
    assert ordered(got, "pos", "n") == ordered(want, "pos", "n")


def test_next_start_interval_is_open_at_the_end_also_for_one_row(spark):
    df = spark.createDataFrame([(1,), (4,), (9,)], "start long")
    got = windows.next_start_interval(df, "start", "start").orderBy("start").collect()
    assert [r["end"] for r in got] == [3.0, 8.0, float("inf")]
    one = windows.next_start_interval(df.filter("start = 4"), "start", "start")
    assert one.first()["end"] == float("inf")


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_number_rows_does_not_depend_on_partitions(spark, parts):
    df = spark.range(500).select(((F.col("id") * 7919) % 500).alias("id")).repartition(parts)
    got = windows.number_rows(df, [F.col("id").desc()], "n").collect()
    assert {(r["id"], r["n"]) for r in got} == {(i, 500 - i) for i in range(500)}


def test_add_count_counts_nulls_as_a_group(events):
    want = {(r["user"], r["n"]) for r in events.groupBy("user").agg(F.count(F.lit(1)).alias("n")).collect()}
    got = windows.add_count(events, ["user"])
    assert got.count() == 400
    assert {(r["user"], r["n"]) for r in got.select("user", "n").distinct().collect()} == want


def test_status_by_multiplicity(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "name string, id int")
    got = {(r["id"], r["taxonomicStatus"]) for r in windows.status_by_multiplicity(df, ["name"]).collect()}
    assert got == {(1, "ambiguous synonym"), (2, "ambiguous synonym"), (3, "synonym")}


def test_unique_only_lookup_and_first_hit(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, id int")
    assert [tuple(r) for r in windows.unique_only_lookup(df, ["k"]).collect()] == [("b", 3)]
    assert sorted(tuple(r) for r in windows.first_hit(df, ["k"], ["id"]).collect()) == [("a", 1), ("b", 3)]


def test_no_unpartitioned_window_over_the_rows(spark, events):
    """The window without partition reads the second bucket level only."""
    plan = windows.carry_forward(events, ["v"], "pos")._jdf.queryExecution().optimizedPlan().toString()
    lines = [x for x in plan.splitlines() if "Window [" in x]
    assert any("_b1" in x for x in lines) and len(lines) == 3
