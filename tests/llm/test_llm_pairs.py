"""Near-duplicates, shards, components, scores and the pipeline against brute force."""

import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from taxaloom.llm import importance, minhash, pivots, sharding, toxicity  # noqa: E402
from taxaloom.llm.components import components  # noqa: E402
from taxaloom.llm.queries import QUERIES, table  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def documents(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not there")
    return {r.doc_id: r for r in table(spark, SF, "documents").collect()}


def test_components(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(1, 40)] + [(random.randint(100, 160), random.randint(100, 160)) for _ in range(40)] + [(7, 7)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute.roots({i for e in edges for i in e}, edges)
    assert all(out.get(i, i) == root for i, root in want.items()) and set(out) <= set(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def copies(seed):
    """Texts around the threshold: copies, chains of edits, short and empty texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    out = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        out += [" ".join(base)] * rng.randint(1, 3)
        for _ in range(rng.randint(0, 6)):
            base = list(base)
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(len(base))] = rng.choice(words)
            out.append((" \n" if rng.random() < 0.3 else " ").join(base).upper())
    return out + ["a b c", "A  b\tc", "a b", "one two three four five", "", "  ", None, "é à", "é à"]


def test_near_duplicates_equal_brute_force(spark):
    rows = list(enumerate(copies(3), 10))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS + ", id string").repartition(5)
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    want = brute.near_duplicates(rows)
    assert out == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_links_below_the_star_are_found(spark):
    """Documents whose common neighbour in a bucket is too far from them, but that link with each other."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = list(base)
        at = rng.randrange(0, 230)
        text[at : at + rng.choice([6, 12, 20])] = [f"x{i}"]
        rows.append((i, " ".join(text)))
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert out == {i: c for i, (_, c) in brute.near_duplicates(rows).items()}


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text), (5, text), (5, "other words entirely here now yes"), (9, "OTHER words entirely here now yes"), (None, text), (3, None)]
    df = spark.createDataFrame(rows, DOCS)
    out = sorted((r.doc_id or -1, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert out == [(-1, None, True), (3, 3, True), (5, 5, True), (5, 5, True), (5, 5, True), (9, 5, False)]
    assert sorted((r.doc_id or -1) for r in minhash.keep_one(df).collect()) == [-1, 3, 5]
    assert minhash.keep_one(df.limit(0)).count() == 0


def test_pipeline_drops_copies_from_eighty_percent(spark):
    words = [f"w{i}" for i in range(204)]  # 200 shingles; the copies share 178 and 175 of 222 and 225
    rows = [(1, " ".join(words)), (2, " ".join(words[:-22] + [f"x{i}" for i in range(22)])), (3, " ".join(words[:-25] + [f"y{i}" for i in range(25)]))]
    rows += [(i, text) for i, text in enumerate(copies(9), 10)]
    df = spark.createDataFrame(rows, DOCS)
    for percent in (80, 85):
        out = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, percent=percent).collect()}
        assert out == brute.near_duplicates(rows, percent)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()}
    assert 2 not in kept and 3 in kept
    assert (1 - 0.8**minhash.BAND_ROWS) ** minhash.bands_for(80) < 2e-5 and minhash.bands_for(85) == minhash.BANDS


def test_posterior_bounds():
    for n, fewest in minhash.fewest_matches():
        assert fewest < 0.85 * n
    assert minhash.fewest_matches()[-1][1] > 0.5 * minhash.HASHES


# --- embeddings ----------------------------------------------------------------------------------


def vectors(seed, n=300, groups=6, size=30, noise=0.02):
    rng = np.random.RandomState(seed)
    out = [rng.randn(24) for _ in range(n)]
    for _ in range(groups):
        base = rng.randn(24)
        out += [base + noise * rng.randn(24) for _ in range(size)]
    return [[float(np.float32(x)) for x in v] for v in out]


def brute_links(rows):
    units = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = sorted(units)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.9]
    count = {i: 0 for i, _ in rows}
    for a, b in edges:
        count[a] += 1
        count[b] += 1
    return count, brute.roots([i for i, _ in rows], edges)


@pytest.mark.parametrize("block", [512, 7])
def test_pivot_index_equals_brute_force(spark, block):
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0, None] + [1.0] * 22, [1.0, 2.0], [2.0, 4.0]]
    data = vectors(2)
    rows = list(enumerate(data + [data[-1]] * 5 + odd))
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rep int")
    out = pivots.near_duplicates(df, block=block).collect()
    count, root = brute_links(rows)
    assert len(out) == len(rows)
    found = sum(r.n_links for r in out)
    assert found >= 0.99 * sum(count.values()) and all(r.n_links <= count[r.vec_id] for r in out)
    assert sum(r.component_id == root[r.vec_id] for r in out) >= 0.99 * len(out)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_pivot_recall_near_the_threshold(spark):
    rng = np.random.RandomState(4)
    base = rng.randn(1500, 64)
    base /= np.linalg.norm(base, axis=1)[:, None]
    side = rng.randn(1500, 64)
    side -= (side * base).sum(1)[:, None] * base
    side /= np.linalg.norm(side, axis=1)[:, None]
    rows = list(enumerate(np.vstack([base, 0.93 * base + np.sqrt(1 - 0.93**2) * side]).tolist()))
    out = pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sum(r.n_links for r in out) >= 0.9 * 3000


@pytest.mark.parametrize("n_pivots", [1_400, 4_096])
def test_pivot_recall_at_the_threshold_with_many_pivots(spark, n_pivots):
    rng = np.random.RandomState(5)
    base, side, other = rng.randn(1_000, 64), rng.randn(1_000, 64), rng.randn(14_000, 64)
    base /= np.linalg.norm(base, axis=1)[:, None]
    side -= (side * base).sum(1)[:, None] * base
    side /= np.linalg.norm(side, axis=1)[:, None]
    rows = list(enumerate(np.vstack([base, 0.90001 * base + np.sqrt(1 - 0.90001**2) * side, other]).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = pivots.near_duplicates(df, n_pivots=n_pivots).collect()
    assert sum(r.n_links for r in out) >= 0.93 * 2_000


def test_empty_vectors(spark):
    assert pivots.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# --- shards --------------------------------------------------------------------------------------


def test_shards(spark, tmp_path):
    random.seed(3)
    rows = [(i, "x" * random.choice([0, 5, 50, 3000])) for i in range(500)] + [(500, None), (501, "é" * 10), (None, "a"), (7, "again")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], DOCS + ", size int").repartition(7)
    out = sharding.shard_by_bytes(df.drop("size").withColumn("shard", F.lit(9)), 8).collect()
    assert sorted((r["size"], r.text_crc32) for r in out) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in rows)
    total, largest = sum(r["size"] for r in out), max(r["size"] for r in out)
    ordered = sorted(out, key=lambda r: (r.shard, r.slot))
    assert [r.doc_id or -1 for r in ordered] == sorted(i or -1 for i, _ in rows)  # contiguous by id
    for shard in range(8):
        own = [r for r in ordered if r.shard == shard]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 8) <= largest
    assert {(r.law, r.grown_shard) for r in out} == {("bytes", None)}
    assert sharding.shard_by_bytes(df.limit(0)).count() == 0
    unique = df.where("doc_id <> 7")
    sharding.write_shards(unique, str(tmp_path / "shards"), 8)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == unique.count()


def test_one_heavy_id(spark):
    rows = [(1, f"t{i % 3}") for i in range(300)] + [(i, "z") for i in range(2, 300)]
    out = sharding.shard_by_bytes(spark.createDataFrame(rows, DOCS), 4).collect()
    assert len(out) == len(rows) and {r.shard for r in out} == {0, 1, 2, 3}


# --- scores --------------------------------------------------------------------------------------


def test_toxicity(spark):
    random.seed(2)
    calm = [f"word{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(900):
        bad = i % 3 == 0
        text = [random.choice(calm) for _ in range(40)] + (["you", random.choice(["vile", "rotten"]), random.choice(["foul", "nasty"])] if bad else [])
        rows.append((i, " ".join(text)))
        marks.append((i, int(bad)))
    rows += [(900, None), (901, ""), (None, "you vile rotten nasty"), (3, "you vile rotten nasty"), (902, "calm " * 50_000)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS + ", score string")
    labels = spark.createDataFrame(marks + [(0, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    out = toxicity.score(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.predicted == int(r.doc_id % 3 == 0) for r in held) / len(held) > 0.95
    none = toxicity.score(docs, labels.where("toxic = 0"))
    assert {r.score for r in none.collect()} == {0.0}
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_importance_draw(spark):
    good, junk = " ".join(f"g{i}" for i in range(20)), " ".join(f"#{i}" for i in range(20))
    rows = [(i, good if i % 4 else junk, i % 4 != 0 and i < 100) for i in range(400)] + [(400, None, False), (None, "", False)]
    df = spark.createDataFrame(rows, DOCS + ", target boolean")
    out = importance.resample(df, "target", share=0.7).collect()
    assert len(out) == 402 and sum(r.selected for r in out) == int(0.7 * 402)
    assert all(not r.selected for r in out if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 4 == 0)
    line = sorted(out, key=lambda r: (-r.gumbel_key, r.doc_id is not None, r.doc_id or 0))
    assert [r.selected for r in line] == [True] * int(0.7 * 402) + [False] * (402 - int(0.7 * 402))
    total, wanted = importance.ngram_counts(df, "text", "target")
    want = sum(len(importance.buckets((t or "").encode())) for _, t, _ in rows)
    assert total.sum() == want and wanted.sum() == 75 * len(importance.buckets(good.encode()))
    assert importance.resample(df.limit(0), "target").count() == 0


# --- queries over the given tables ---------------------------------------------------------------


@pytest.mark.parametrize("name", ["op2_importance", "op7_toxicity", "op10_shards"])
def test_queries_cover_documents(spark, documents, name):
    rows = QUERIES[name](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)


def test_pipeline_equals_brute_force(spark, documents):
    import sentencepiece
    from taxaloom.llm import langid, pii
    from taxaloom.llm.queries import model_file

    docs = table(spark, SF, "documents")
    # languages: the parser over plain Python rows; then the contracts of the other stages
    parser = langid.Parser(langid.labelled_sample(docs))
    rows = [(i, r.text) for i, r in sorted(documents.items()) if parser.predict([r.text])[0][0] != "und"]
    component = brute.near_duplicates(rows, corpus_pipeline.NEAR_PERCENT)
    rows = [(i, t) for i, t in rows if component[i][1] == i]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = []
    for i, t in rows:
        n, hit, _ = brute.contamination(t, items)
        if not hit or 20 * len(hit) < n:
            clean.append((i, t))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(out) == [i for i, _ in clean]
    library = sentencepiece.SentencePieceProcessor(model_file=model_file())
    for i, t in clean:
        assert out[i].ids == library.encode(out[i].decoded) and out[i].n_tokens == len(out[i].ids)
        spans = brute.base_spans(t)
        if not spans and "<" not in out[i].decoded:
            assert out[i].decoded == t
        assert not brute.base_spans(out[i].decoded) or spans
        for kind, a, b in spans:
            assert t[a:b] not in out[i].decoded or kind == "ip"
    assert pii.KINDS == list(brute.BASE)


def test_stages_on_odd_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans int, n_words string, score int"
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{text} tail{i % 7} {'zzz ' * i}", "en", None, None, i, "w", 1) for i in range(30)]
    rows += [(30, None, None, "s", 1, None, None, None), (31, "", "de", "s", 1, 0, "", 0), (None, "null id text", "de", None, 0, 0, "", 0), (0, "again", "de", None, 0, 0, "", 0)]
    docs = spark.createDataFrame(rows, schema)
    for start in (docs, docs.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF)
            if name != "sentencepiece":
                assert now.columns == docs.columns
            out = tmp_path / f"{name}{start is docs}"
            now.write.parquet(str(out))
            now = spark.read.parquet(str(out))
        assert bool(now.count()) == (start is docs)
