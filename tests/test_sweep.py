"""Points and tiling bands in one sorted stream."""

import bisect
import random

import pytest

from taxaloom.operators.sweep import last_start_join


def plain(points, bands):
    starts = {}
    for key, start, name in bands:
        if key is not None and start is not None and start == start:
            best = starts.setdefault(key, {})
            best[start] = min(name, best.get(start, name))
    order = {k: sorted(v) for k, v in starts.items()}
    out = []
    for i, key, at in points:
        found = (None, None)
        if key in order and at is not None and at == at:
            k = bisect.bisect_right(order[key], at)
            if k:
                start = order[key][k - 1]
                found = (start, starts[key][start])
        out.append((i, key, at, *found))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [0.0, 0.95])
def test_sweep_equals_search(spark, hot):
    rng = random.Random(int(hot * 10))
    keys = ["a", "b", "c|d", None, ""]
    pick = lambda: "a" if rng.random() < hot else rng.choice(keys)
    points = [(i % 900, pick(), rng.choice([None, float("nan"), rng.randint(-50, 2000) / 2, rng.uniform(0, 900)])) for i in range(1000)]
    bands = [(pick(), rng.choice([None, rng.randint(0, 1500) / 2]), f"n{i}") for i in range(80)]
    p = spark.createDataFrame(points, "id long, k string, x double").repartition(5)
    b = spark.createDataFrame(bands, "grp string, start double, name string").repartition(3)
    out = last_start_join(p, b, "x", on=[("k", "grp")])
    assert out.columns == ["id", "k", "x", "start", "name"]
    found = sorted((tuple(r) for r in out.collect()), key=str)
    assert [str(r) for r in found] == [str(r) for r in plain(points, bands)]


def test_one_band_reaches_over_all_ranges(spark):
    p = spark.range(5000).selectExpr("id", "id % 2 AS k")
    b = spark.createDataFrame([(0, 10, "first"), (1, 4900, "late")], "k long, start long, name string")
    rows = {r.id: r.name for r in last_start_join(p, b, "id", on=["k"]).collect()}
    assert len(rows) == 5000
    assert all(rows[i] == ("first" if i >= 10 else None) for i in range(0, 5000, 2))
    assert all(rows[i] == ("late" if i >= 4900 else None) for i in range(1, 5000, 2))


def test_without_keys_and_empty_sides(spark):
    p = spark.createDataFrame([(1, 5), (2, 1), (3, None)], "id long, x long")
    b = spark.createDataFrame([(2, "two"), (5, "five")], "start long, name string")
    assert {r.id: r.name for r in last_start_join(p, b, "x").collect()} == {1: "five", 2: None, 3: None}
    assert [r.name for r in last_start_join(p, b.limit(0), "x").collect()] == [None] * 3
    assert last_start_join(p.limit(0), b, "x").count() == 0


def test_points_are_exchanged_once(spark):
    p = spark.range(1000).selectExpr("id", "id % 7 AS k")
    b = spark.range(10).selectExpr("id % 7 AS k", "id * 9 AS start")
    plan = last_start_join(p, b, "id", on=["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (0, 1000" not in plan  # what is left reads the swept stream only
