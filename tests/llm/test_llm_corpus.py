"""Whitening, collocations and repeated passages against plain versions."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from taxaloom.llm import phrases, suffix_dedup, whitening
from taxaloom.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"


# --- whitening -----------------------------------------------------------------------------------


def plain_whitening(vectors, k=16):
    """{id: (deviation, whitened)}, n, explained of [(id, vector)] of one length."""
    x = np.floor(np.array([v for _, v in vectors], float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    white = (x - sums / n) @ axes / np.sqrt(values)
    deviation = [sum(int(a) ** 2 for a in n * row - sums) for row in x]
    return {i: (d, w) for (i, _), d, w in zip(vectors, deviation, white, strict=True)}, n, values / (centred**2).sum() * n


def compared(rows, vectors, k=16):
    want, n, explained = plain_whitening(vectors, k)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(got) == sorted(i for i, _ in vectors)
    components = sorted(next(iter(got.values())))
    assert components == list(range(1, len(components) + 1))
    mine = np.array([[got[i][c].whitened for c in components] for i, _ in vectors])
    theirs = np.array([want[i][1][: len(components)] for i, _ in vectors])
    signs = np.sign((mine * theirs).sum(0))
    assert np.abs(mine * signs - theirs).max() < 1e-8
    for i, _ in vectors:
        for c in components:
            r = got[i][c]
            assert r.n == n and r.deviation == want[i][0] and r.identity_error <= 1e-9
            assert abs(r.explained / explained[c - 1] - 1) < 1e-9
    return components


def test_whitening_equals_plain_version(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((400, 60)) @ np.diag(np.linspace(3, 0.5, 60)) + 2
    vectors = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(50)]  # equal vectors count once
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, component string")
    assert compared(whitening.whiten(df.repartition(6)).collect(), vectors) == list(range(1, 17))


def test_whitening_of_queries_table(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not there")
    vectors = [(r.vec_id, list(r.embedding)) for r in table(spark, SF, "embeddings").collect()]
    compared(QUERIES["op11_whitening"](spark, SF).collect(), vectors)


def test_whitening_of_odd_vectors(spark):
    rows = [
        (1, [1.0, 2.0, 3.0]), (2, [2.0, 1.0, 0.5]), (3, [0.25, 9.0, 1.0]), (4, [5.0, 5.0, 5.5]), (None, [1.0, 2.0, 3.0]),
        (5, None), (6, [1.0, None, 2.0]), (7, [float("nan"), 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (9, []),
        (10, [1.0, 2.0]), (11, [4.0, 3.0]), (12, [1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in whitening.whiten(df).collect():
        found.setdefault(r.vec_id, []).append(r)
    # three dimensions, two vectors on a line, a single vector without variance
    assert {i: sorted(r.component for r in x) for i, x in found.items()} == {
        **{i: [1, 2, 3] for i in (1, 2, 3, 4, None)}, 10: [1], 11: [1]
    }
    compared([r for i in (1, 2, 3, 4) for r in found[i]], [x for x in rows if x[0] in (1, 2, 3, 4)])
    assert found[10][0].n == 2 and abs(found[10][0].whitened) == pytest.approx(1)
    assert whitening.whiten(df.limit(0)).count() == 0
    equal = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(equal).count() == 0
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0])], "vec_id long, embedding array<double>")
    assert [r.deviation for r in whitening.whiten(huge).collect()] == [None, None]


# --- collocations --------------------------------------------------------------------------------


def plain_collocations(rows, longest=5, least=100, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        pieces = "".join("\n" if c in ".,;:!?\n\x0b\x0c\r" else c for c in text).split("\n")
        for piece in pieces:
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            for k in range(1, longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        frequent = [p for p, a in f.items() if a >= least and len(p) > 1]
        scored = []
        for p in frequent:
            inside = any(
                len(o) > len(p) and f[o] >= f[p] and any(o[i : i + len(p)] == p for i in range(len(o) - len(p) + 1)) for o in frequent
            )
            if not inside:
                cut = min((1000 * f[p] * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-cut[0], -f[p], " ".join(p).encode(), f[p[: cut[1]]], f[p[cut[1] :]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def random_text(rng, vocabulary, n):
    out = []
    while len(out) < n:
        out += rng.choice([["alpha", "beta", "gamma"], ["New", "York"], ["x"] * 7, [rng.choice(vocabulary)], ["e\x01", "é"]])
        out.append(rng.choice(["", "", "", ".", "\t", "!\n", "\r"]))
    return " ".join(out)


def test_collocations_equal_plain_version(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = [(rng.choice(["en", "fr", None, "und"]), random_text(rng, vocabulary, rng.randint(0, 60))) for _ in range(120)]
    rows += [("en", None), ("en", ""), (None, "...  \t"), ("xx", "alone")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "lang string, text string, rank int").repartition(5)
    found = sorted(tuple(r) for r in phrases.collocations(df, least=6).collect())
    assert found == plain_collocations(rows, least=6) and len(found) > 40
    few = sorted(tuple(r) for r in phrases.collocations(df, longest=3, least=4, top=5).collect())
    assert few == plain_collocations(rows, 3, 4, 5)
    assert phrases.collocations(df.limit(0)).count() == 0


def test_streams_hand_open_entries_on(spark):
    """All phrases begin with one word, so its entry is open over all ranges."""
    keys = [["a"]] + [["a", f"b{i:02}"] for i in range(40)] + [["a", f"b{i // 9:02}", f"c{i:03}"] for i in range(360)]
    rows = [("en", key, 1000 - i) for i, key in enumerate(keys)]
    df = spark.createDataFrame(rows, "lang string, key array<string>, f long")
    f = {tuple(k): n for _, k, n in rows}
    found = {tuple(r.key): (r.parts, r.ext) for r in phrases._lockstep(df, 5).collect()}
    for key in f:
        longer = [n for o, n in f.items() if len(o) == len(key) + 1 and o[: len(key)] == key]
        assert found[key] == ([f[key[:k]] for k in range(1, len(key) + 1) if key[:k] in f], max(longer, default=0))
    assert len(found) == len(f)


def test_scores_pass_64_bits(spark):
    """Numerators beyond 64 bits keep all digits."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(10**13, 4 * 10**13, 10**13, 3 * 10**13)], "a long, n long, l long, r long")
    cast = lambda c, k: f"cast({c} as decimal({k},0))"
    e = f"(cast(1000 as decimal(4,0)) * {cast('a', 15)} * {cast('n', 18)}) div ({cast('l', 18)} * {cast('r', 18)})"
    assert df.select(F.expr(e)).first()[0] == 1000 * 10**13 * 4 * 10**13 // (10**13 * 3 * 10**13)


# --- repeated passages ---------------------------------------------------------------------------


def plain_removal(rows, window=100):
    """{key: (spans, kept)} of [(key, bytes)]; keys are in the order in which windows are first."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        covered = np.zeros(len(text), bool)
        for i in range(len(text) - window + 1):
            w = text[i : i + window]
            if w in seen:
                covered[i : i + window] = True
            seen.add(w)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        out[key] = (spans, bytes(np.frombuffer(text, np.uint8)[~covered]))
    return out


def repeating_texts(seed):
    rng = random.Random(seed)
    letters = "abcdefgh é"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [make(rng.randint(90, 400)) for _ in range(8)]
    texts = []
    for _ in range(60):
        parts = [rng.choice([make(rng.randint(0, 200)), rng.choice(passages), rng.choice(passages)[rng.randint(0, 40) :]]) for _ in range(4)]
        texts.append("".join(parts))
    texts += [texts[3], texts[3], texts[5] + "x", "a" * 99, "a" * 100, "a" * 700, "b" * 1500, "ab" * 300, make(69) * 8, make(99) * 5, make(100) * 4, make(101) * 4, "", "é" * 80]
    rng.shuffle(texts)
    return texts


def checked_removal(df, rows, **options):
    want = plain_removal([(i, (t or "").encode()) for i, t in rows])
    out = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, **options).collect()}
    assert sorted(out) == sorted(want)
    for i, (spans, kept) in want.items():
        assert [(s.start, s.end) for s in out[i].removed] == spans and bytes(out[i].kept) == kept


@pytest.mark.parametrize("options", [{}, {"most_runs": 2, "seen": 1}, {"most_runs": 5, "seen": 1000}, {"most_runs": 0, "seen": 1}])
def test_removal_equals_plain_version(spark, options):
    rows = list(enumerate(repeating_texts(len(options)), -20)) + [(1000, None)]
    df = spark.createDataFrame([(i, t, "k", "t") for i, t in rows], "doc_id long, text string, kept string, Tie string").repartition(7)
    checked_removal(df, rows, **options)


def test_removal_from_long_texts(spark):
    rng = np.random.default_rng(2)
    long = rng.integers(97, 123, 700_000).astype(np.uint8).tobytes().decode()
    rows = [(1, long), (2, "x" * 50 + long[300_000:300_500] + "y"), (3, long[100:] + long[:200]), (4, "z" * 300_000)]
    checked_removal(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_removal_with_repeated_and_null_ids(spark):
    text, other = "".join(f"{i:03}" for i in range(100)), "".join(f"{i:03}" for i in range(30, 150))
    rows = [(5, text), (5, text), (5, other), (None, text), (None, text), (None, other), (9, text)]
    out = [(r.doc_id, r.text, len(r.kept)) for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    # null ids come first, one of their texts before the other; repeated rows are one document
    nulls = {t: k for i, t, k in out if i is None}
    assert sorted(i == len(t) for t, i in nulls.items()) == [False, True]
    assert all(nulls[t] == k for i, t, k in out if i is None)
    assert all(k == 0 for i, _, k in out if i is not None) and len(out) == 7
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_removal_query_digests(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not there")
    rows = [(r.doc_id, (r.text or "").encode()) for r in table(spark, SF, "documents").collect()]
    want = plain_removal(rows)
    for r in QUERIES["op13_suffix_dedup"](spark, SF).collect():
        spans, kept = want[r.doc_id]
        assert r.n_spans == len(spans) and r.n_removed == r.n_bytes - len(kept)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
