"""Scores that SQL can't express, computed a second time in plain Python."""

import math
import random
import re
import struct
import time

import pytest
import xxhash

from taxaloom.llm import importance, toxicity

DOCS = "doc_id long, text string"


def plain_hash(word):
    return xxhash.xxh3_64_intdigest(word)


def plain_buckets(text, hash_of):
    """Buckets of words and of pairs of neighbours, with Python's own integers."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    hashes = [hash_of(w) for w in re.findall(rb"[^ \t-\r]+", low)]
    out = [h % 10_000 for h in hashes]
    for a, b in zip(hashes, hashes[1:]):
        pair = (a * 0x9E3779B97F4A7C15 + b * 0xD6E8FEB86659FD93) % 2**64
        out.append((pair ^ (pair >> 29)) % 10_000)
    return out


def spark_hash(doc_id, seed):
    """xxhash64(id, seed) of Spark: each value is hashed with the last one's hash as seed, nulls are left out."""
    h = 42
    if doc_id is not None:
        h = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), h)
    return xxhash.xxh64_intdigest(struct.pack("<i", seed), h)


def test_importance_weights_and_draw_equal_plain_version(spark):
    rng = random.Random(4)
    words = [f"Wörd{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(words[: 10 + i % 31]) for _ in range(rng.randint(0, 30))), i % 7 == 0) for i in range(300)]
    rows += [(300, None, True), (301, "", False), (None, "Wörd1 a", False), (302, "one\x0bTWO\tthree", True)]
    df = spark.createDataFrame(rows, DOCS + ", target boolean").repartition(5)
    out = {r.doc_id: r for r in importance.resample(df, "target", share=0.6, seed=9).collect()}

    found = {i: plain_buckets(t, plain_hash) for i, t, _ in rows}
    total, wanted = [1.0] * 10_000, [1.0] * 10_000
    for i, _, target in rows:
        for b in found[i]:
            total[b] += 1
            wanted[b] += target
    n, k = sum(total), sum(wanted)
    keys = {}
    for i, _, _ in rows:
        weight = sum(math.log(wanted[b] / k) - math.log(total[b] / n) for b in found[i])
        unit = (spark_hash(i, 9) % 2**40 + 0.5) / 2**40  # the lower bits: Python's and Spark's remainders agree
        keys[i] = weight - math.log(-math.log(unit))
        assert out[i].n_grams == len(found[i]) and out[i].log_weight == pytest.approx(weight, abs=1e-9)
        assert out[i].gumbel_key == pytest.approx(keys[i], abs=1e-9)
    chosen = sorted(keys, key=lambda i: -keys[i])[: int(0.6 * len(rows))]
    assert {i for i, r in out.items() if r.selected} == set(chosen)


def plain_features(text, lexicon):
    """The dense features, from their definitions."""
    if not text:
        return [0.0] * 13
    low = text.lower()
    tokens = re.findall(r"(?:[a-z]|[^\x00-\x7f])+", low)
    n = max(1, len(tokens))
    size = len(text.encode())
    places = [i for i, w in enumerate(tokens) if w in lexicon]
    persons = {i for i, w in enumerate(tokens) if w in toxicity.SECOND_PERSON}
    near = sum(any(abs(i - j) <= 5 for j in persons) for i in places)
    odd, at = [], 0
    while at < len(text):  # letters, then groups of one sign and letters
        e = at
        while e < len(text) and text[e].isalpha():
            e += 1
        stop, groups = e, 0
        while stop > at and stop + 1 < len(text) and text[stop] in "0123456789@$!*" and text[stop + 1].isalpha():
            stop += 1
            groups += 1
            while stop < len(text) and text[stop].isalpha():
                stop += 1
        if groups:
            odd.append(text[at:stop])
        at = max(stop, at + 1)
    plain = str.maketrans("013457@$!", "oieastasi")
    hidden = sum(w.lower().translate(plain) in lexicon or w.lower().replace("*", "") in lexicon for w in odd)
    weight = sum(lexicon[tokens[i]] for i in places)
    signs = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    return [
        math.log(1 + len(places)), len(places) / n, len({tokens[i] for i in places}), weight / n, math.log(1 + weight), near / n,
        len(persons) / n, sum("A" <= c <= "Z" for c in text) / size, sum(c in signs for c in text) / size, text.count("!") / size,
        len(odd) / n, math.log(1 + hidden), math.log(n),
    ]


def test_toxicity_features_equal_plain_version():
    rng = random.Random(6)
    parts = ["vile", "v1le", "vi*le", "V1L3", "you", "Du", "calm", "é", "a1", "1a", "@", "!!", ".", "x$y$z", "a1b", "ß", "-", "9", " ", "Foul"]
    lexicon = {"vile": 2.5, "foul": 3.0, "é": 1.0}
    for _ in range(3000):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", "  "]) for _ in range(rng.randint(0, 25)))
        assert toxicity.features(text, lexicon) == pytest.approx(plain_features(text, lexicon)), text


@pytest.mark.parametrize("text", ["a" * 1_000_000, "a1" * 500_000, "a1!" * 300_000, "é" * 500_000, "v1le" * 200_000])
def test_toxicity_features_of_one_long_word(text):
    start = time.process_time()
    found = toxicity.features(text, {"vile": 1.0})
    assert time.process_time() - start < 2 and all(math.isfinite(x) for x in found)


def pool_adjacent(points):
    """Isotonic regression of (x, y), and its value at any x between by straight lines."""
    levels = []
    for x in sorted({p[0] for p in points}):
        ys = [y for q, y in points if q == x]
        levels.append([sum(ys) / len(ys), len(ys), [x]])
        while len(levels) > 1 and levels[-2][0] >= levels[-1][0]:
            y, n, xs = levels.pop()
            level = levels[-1]
            level[0], level[1] = (level[0] * level[1] + y * n) / (level[1] + n), level[1] + n
            level[2] += xs
    knots = [(x, y) for y, _, xs in levels for x in (xs[0], xs[-1])]

    def at(x):
        if x <= knots[0][0]:
            return knots[0][1]
        for (a, p), (b, q) in zip(knots, knots[1:]):
            if x <= b:
                return q if a == b else p + (q - p) * (x - a) / (b - a)
        return knots[-1][1]

    return at


def test_isotonic_step_equals_pooling(spark):
    from pyspark.ml.regression import IsotonicRegression

    rng = random.Random(8)
    points = [(round(rng.random(), 2), float(rng.random() < 0.5)) for _ in range(400)]
    points = [(x, float(rng.random() < x)) for x, _ in points]
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(
        spark.createDataFrame(points, "raw double, label double")
    )
    asked = [(i / 200,) for i in range(-20, 220)]
    want = pool_adjacent(points)
    for r in curve.transform(spark.createDataFrame(asked, "raw double")).collect():
        assert r.score == pytest.approx(want(r.raw), abs=1e-9)
