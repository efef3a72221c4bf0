import random

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import joins, parents


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(2)
    left = [(i, 7 if rng.random() < 0.34 else rng.choice([None, *range(200)])) for i in range(3000)]
    return spark.createDataFrame(left, "id int, k int").repartition(6).cache()


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(k, f"v{k}") for k in range(0, 150)], "key long, v string").cache()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_lookup_join_equals_plain_join(spark, skewed, target, how, broadcast, monkeypatch):
    monkeypatch.setattr(joins, "SMALL_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        # the key types differ on purpose
        got = joins.lookup_join(skewed, target, [("k", "key")], how, keys_from=skewed)
        want = skewed.join(target, skewed.k == target.key, how).drop("key")
        assert got.columns == want.columns
        assert rows(got, *got.columns) == rows(want, *want.columns)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_hot_key_is_found_and_spread(spark, skewed, target, monkeypatch):
    monkeypatch.setattr(joins, "SMALL_BYTES", 0)
    hot = joins.hot_hashes(skewed, "xxhash64(k)")
    assert skewed.filter(F.col("k") == 7).select(F.xxhash64("k")).first()[0] in hot
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = joins.lookup_join(skewed, target, [("k", "key")], keys_from=skewed).filter("k = 7")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        total = sum(r["count"] for r in sizes)
        assert total > 900 and max(r["count"] for r in sizes) < total / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_double_keys_match_over_both_zeros(spark):
    left = spark.createDataFrame([(0.0,), (-0.0,), (1.5,)], "k double")
    right = spark.createDataFrame([(0.0, "zero"), (1.5, "x")], "k double, v string")
    assert sorted(r["v"] for r in joins.lookup_join(left, right, "k").collect()) == ["x", "zero", "zero"]


def test_null_safe_lookup(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, id int")
    right = spark.createDataFrame([(None, "n"), ("a", "x")], "k string, v string")
    assert rows(joins.lookup_join(left, right, "k", null_safe=True), "id", "v") == [(1, "n"), (2, "x")]
    assert rows(joins.lookup_join(left, right, "k"), "id", "v") == [(1, None), (2, "x")]


def test_cardinality_is_reported_and_rows_are_not_multiplied(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, id int")
    right = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", "z")], "k string, v string")
    joined, found = joins.many_to_one(left, right, "k")
    assert rows(joined, "id", "v") == [(1, "x"), (2, "x"), (3, "z")]
    assert rows(found, "rule", "key", "detail") == [("right_key_repeats", "a", "2")]
    _, found = joins.one_to_one(left, right, "k")
    assert {r["rule"] for r in found.collect()} == {"right_key_repeats", "left_key_repeats"}


@pytest.mark.parametrize("closed", [True, False])
def test_interval_join_equals_nested_loop(spark, closed):
    rng = random.Random(3)
    inf = float("inf")
    bands = []
    for b in range(60):
        start = rng.uniform(-50, 500)
        width = rng.choice([0.0, 1e-9, 0.01, 0.5, 1.0, 7.0, 8.0, 99.0, 999.0, 9.99e99, inf])
        bands.append((b, rng.choice(["a", "b"]), start, start + width))
    bands += [(98, "a", None, 3.0), (99, "a", 9.0, 2.0)]
    points = [(i, rng.choice(["a", "b", "c"]), rng.choice([None, float(rng.randrange(-60, 700))])) for i in range(300)]
    points += [(1000 + i, b[1], b[2]) for i, b in enumerate(bands[:20])]
    points += [(2000 + i, b[1], b[3]) for i, b in enumerate(bands[:20])]
    left = spark.createDataFrame(points, "id int, k string, x double")
    right = spark.createDataFrame(bands, "band int, k string, start double, end double")
    got = joins.interval_join(left, right, "x", "id", on=["k"], closed=closed)
    want = []
    for pid, k, x in points:
        hits = [
            b
            for b, bk, s, e in bands
            if x is not None and s is not None and bk == k and s <= x and (x <= e if closed else x < e)
        ]
        want += [(pid, b) for b in hits or [None]]
    assert rows(got, "id", "band") == sorted(want, key=str)


def test_cascade_equals_anti_join_form(spark):
    rng = random.Random(4)
    child = spark.createDataFrame([(i, rng.randrange(3), rng.uniform(0, 300)) for i in range(300)], "id int, k int, x double")

    def level(tag, width, starts):
        data = [(k, float(s), float(s + width), f"{tag}{k}:{s}") for k in range(3) for s in starts]
        return spark.createDataFrame(data, "k int, start double, end double, parent string")

    levels = [level("t", 9, (0, 40)), level("s", 99, (0, 100)), level("f", 250, (0,))]
    got = parents.cascade_parent(child, levels, ["k"], "x", "id", "parent")
    left, done = child, None
    for bands in levels:
        hit = left.join(bands, "k").filter("x >= start and x < end").select("id", "parent")
        done = hit if done is None else done.union(hit)
        left = left.join(hit, "id", "left_anti")
    want = done.union(left.select("id", F.lit(None).cast("string")))
    assert rows(got, "id", "parent") == rows(want, "id", "parent")


def test_repeated_points_keep_their_matches(spark):
    left = spark.createDataFrame([(1, 5.0), (1, 5.0), (1, 40.0), (2, 90.0)], "id int, x double")
    right = spark.createDataFrame([("a", 0.0, 10.0), ("b", 4.0, 70.0)], "band string, start double, end double")
    got = joins.interval_join(left, right, "x", "id")
    assert rows(got, "id", "x", "band") == [
        (1, 40.0, "b"), (1, 5.0, "a"), (1, 5.0, "a"), (1, 5.0, "b"), (1, 5.0, "b"), (2, 90.0, None),
    ]


def test_narrow_bands_share_no_cells(spark):
    """Bands far narrower than one are told apart by their cells, like wide ones."""
    bands = spark.range(2000).select((F.col("id") / 2000).alias("start"), ((F.col("id") + 0.5) / 2000).alias("end"))
    level = joins._level(F.col("start"), F.col("end"))
    filed = bands.withColumn("_l", level).select(
        "_l", F.explode(F.sequence(joins._cell(F.col("start"), F.col("_l")), joins._cell(F.col("end"), F.col("_l")))).alias("c")
    )
    assert filed.groupBy("_l", "c").count().agg(F.max("count")).first()[0] <= 3


def test_cascade_over_overlapping_bands(spark):
    child = spark.createDataFrame([(1, 0, 6.0), (2, 0, 50.0), (3, 0, 500.0)], "id int, k int, x double")
    level = "k int, start double, end double, parent string"
    first = spark.createDataFrame([(0, 0.0, 10.0, "b"), (0, 5.0, 9.0, "a")], level)
    second = spark.createDataFrame([(0, 0.0, 100.0, "d"), (0, 40.0, 400.0, "c")], level)
    got = parents.cascade_parent(child, [first, second], ["k"], "x", "id", "parent")
    assert rows(got, "id", "parent", "n_matches") == [(1, "a", 2), (2, "c", 2), (3, None, None)]


def test_exclusions(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), (None, "x")], "taxonID string, s string")
    listed = spark.createDataFrame([("a", "to delete"), ("b", "keep")], "taxonID string, comments_mh string")
    assert rows(joins.remove_listed(df, listed, "taxonID"), "taxonID") == [("b",), (None,)]
    pairs = spark.createDataFrame([("a", "x"), ("b", "y")], "taxonID string, s string")
    assert rows(joins.exclude_pairs(df, pairs, ["taxonID", "s"]), "taxonID") == [("b",), (None,)]


def test_lookup_fill(spark):
    df = spark.createDataFrame(
        [("1", "A", None, "x"), ("2", "B", "1", None), ("3", "C", "1", "own"), ("4", "D", "9", None)],
        "id string, name string, up string, up_name string",
    )
    filled = joins.lookup_fill(df, "up_name", "name", "id", "up")
    assert rows(filled, "id", "up_name") == [("1", "x"), ("2", "A"), ("3", "own"), ("4", None)]
    over = joins.lookup_fill(df, "up_name", "name", "id", "up", overwrite=True)
    assert rows(over, "id", "up_name") == [("1", "x"), ("2", "A"), ("3", "A"), ("4", None)]


def test_stated_widths_of_bands_change_nothing(spark):
    bands = spark.createDataFrame([(k % 3, float(k * 7), float(k * 7 + w)) for k in range(60) for w in (5, 99, 1000)], "k int, start double, end double")
    points = spark.createDataFrame([(i, i % 3, i * 0.75) for i in range(700)], "id long, k int, x double")
    want = sorted(map(tuple, joins.interval_join(points, bands, "x", "id", on=["k"]).collect()), key=str)
    for widths in ([99.0, 1000.0], [5.0], [1000.0]):
        found = joins.interval_join(points, bands, "x", "id", on=["k"], widths=widths)
        assert sorted(map(tuple, found.collect()), key=str) == want


@pytest.mark.parametrize("few", [10, 20])
def test_cells_of_many_bands_are_not_broadcast(spark, monkeypatch, few):
    """Spark's estimate doesn't see that points and bands are copied per size and cell."""
    monkeypatch.setattr(joins, "FEW_BANDS", few)
    bands = spark.range(20).selectExpr("id % 3 AS k", "double(id * 7) AS start", "double(id * 7 + id + 1) AS end", "id AS band")
    points = spark.range(150).selectExpr("id", "id % 3 AS k", "double(id) AS x")
    joined = joins.interval_join(points, bands, "x", "id", on=["k"], how="inner")
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert ("SortMergeJoin" in plan) == (few < 20)
    want = points.join(bands, "k").where("start <= x and x < end")
    assert rows(joined, "id", "band") == rows(want, "id", "band")
