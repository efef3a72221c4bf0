"""Similar names, and uniqueness rules in one shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import quality, reconcile


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_no_similar_name_is_lost(spark):
    rng = random.Random(5)
    known = ["".join(rng.choice("abé ") for _ in range(rng.randint(1, 12))) for _ in range(150)] + ["aaaaaaaaaa", "", "aaaa"]
    asked = []
    for name in known * 2:
        text = list(name)
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "x"])
        asked.append("".join(text))
    a, k = (spark.createDataFrame([(n,) for n in [*x, None]], "name string") for x in (asked, known))
    for allowed in (None, {5: 1}, {4: 1, 8: 2, 11: 3}):
        limits = reconcile.EDITS if allowed is None else allowed
        found = {(r.name, r.match_name): r.distance for r in reconcile.similar_names(a, k, allowed).collect()}
        want = {}
        for x in set(asked):
            most = max([n for length, n in limits.items() if len(x) >= length], default=0)
            for y in set(known):
                d = edits(x, y)
                if 1 <= d <= most:
                    want[x, y] = d
        assert found == want and len(want) > 50
    with pytest.raises(ValueError, match="short name"):
        reconcile.similar_names(a, k, {4: 2})


def test_nearest_row_by_distance_then_priority(spark):
    reference = spark.createDataFrame(
        [("Beta prima", 1, 1, "x"), ("Beta prime", 2, 2, "y"), ("Beta primus", 3, 0, "z"), ("Beta prime", 9, 1, "first"), (None, 5, 0, "n")],
        "match_name string, ref_id long, priority int, authors string",
    )
    requests = spark.createDataFrame([("a", "Beta prima"), ("b", "Beta primo"), ("c", "Gamma"), ("d", None), ("e", "Beta primu")], "taxonID string, taxon string")
    rows = {r.taxonID: r for r in reconcile.match_similar(requests, reference, columns=["authors"]).collect()}
    assert sorted(rows) == ["b", "e"]
    assert (rows["b"].match_name, rows["b"].distance, rows["b"].authors) == ("Beta prima", 1, "x")
    assert (rows["e"].match_name, rows["e"].authors) == ("Beta primus", "z")


def test_names_longer_than_their_variants_allow(spark, monkeypatch):
    """Short and long names meet in different ways; neither way loses those that lie between."""
    monkeypatch.setattr(reconcile, "MOST_VARIANTS", 40)
    assert reconcile._longest(2) == 8
    rng = random.Random(8)
    known = sorted({"".join(rng.choice("ab") for _ in range(n)) for n in (6, 7, 8, 9, 10, 11, 14) for _ in range(25)})
    asked = sorted({x[:k] + rng.choice(["", "a", "c"]) + x[k + rng.randint(0, 2) :] for x in known for k in (1, 5)})
    a, k = (spark.createDataFrame([(n,) for n in x], "name string") for x in (asked, known))
    found = {(r.name, r.match_name): r.distance for r in reconcile.similar_names(a, k).collect()}
    near = {(x, y): edits(x, y) for x in asked for y in known if abs(len(x) - len(y)) <= 2}
    limit = {x: max([n for length, n in reconcile.EDITS.items() if len(x) >= length], default=0) for x in asked}
    assert found == {(x, y): d for (x, y), d in near.items() if 1 <= d <= limit[x]}
    assert len({(len(x), len(y)) for x, y in found}) > 15


def test_pairs_compared_grow_with_the_names(spark, monkeypatch):
    """Names that share most letter groups, as species of one genus do, are not compared with all others."""

    def names(n):  # genera that are more than two edits apart, with 100 codes each
        digit = lambda k: F.repeat(F.substring(F.lit("abc"), (F.col("id") / (100 * 3**k)).cast("int") % 3 + 1, F.lit(1)), 3)
        code = F.translate(F.lpad((F.col("id") % 100).cast("string"), 2, "0"), "0123456789", "defghijklm")
        known = spark.range(n).select(F.concat(*[digit(k) for k in range(4)], F.lit(" "), code).alias("name"))
        return known.select(F.concat("name", F.lit("x")).alias("name"), F.lit(2).alias("allowed")), known

    def growth(meet):
        few, many = (meet(*names(n), 2).distinct().count() for n in (500, 4000))
        assert few >= 500
        return many / few

    assert growth(reconcile._meet_by_variants) < 10 and growth(reconcile._meet_by_grams) > 30
    by_grams = []
    real = reconcile._meet_by_grams
    monkeypatch.setattr(reconcile, "_meet_by_grams", lambda a, k, most: by_grams.append(a.count() + k.count()) or real(a, k, most))
    asked, known = names(500)
    assert reconcile.similar_names(asked, known).count() >= 500 and by_grams == [0]


ROWS = [(i, f"n{i % 90}", None if i % 4 else "x", "a|b" if i % 2 else "a", "c" if i % 2 else "b|c") for i in range(100)]
RULES = [("id", ["id"], True), ("name", ["name"], True), ("mark", ["mark"], True), ("mark_known", ["mark"], False), ("pair", ["u", "v", "id"], True)]


@pytest.mark.parametrize("most", [1_000_000, 0])
@pytest.mark.parametrize("clash", [False, True])
def test_unique_rules_equal_single_rules(spark, most, clash):
    df = spark.createDataFrame(ROWS, "id long, name string, mark string, u string, v string").repartition(5)
    rules = [quality.UniqueRule(*r) for r in RULES]
    options = {"fingerprint": lambda *c: F.lit(7).cast("long")} if clash else {}
    found = quality.rules_unique(df, rules, most=most, **options)
    want = []
    for rule, columns, nulls in RULES:
        rows = df if nulls else df.dropna(subset=columns)
        want += map(tuple, quality.rule_unique_rows(rows, columns, rule).collect())
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) == 10 + 2 + 1


def test_unique_rules_tell_joined_values_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "NULL"), ("NULL", None)], "u string, v string")
    rules = [quality.UniqueRule("pair", ["u", "v"])]
    assert quality.rules_unique(df, rules).count() == 0
    assert quality.rules_unique(df, rules, fingerprint=lambda *c: F.lit(1).cast("long")).count() == 0
    assert quality.rules_unique(df.limit(0), rules).count() == 0 and quality.rules_unique(df, []).count() == 0
