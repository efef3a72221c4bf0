"""Thin queries that apply each operator to its whole table, and their SQL for DuckDB."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom.llm import decontamination, importance, langid, licenses, minhash, phrases, pii, pivots, sentencepiece_bpe, sharding, suffix_dedup, toxicity, whitening
from taxaloom.llm.components import checked
from taxaloom.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_file() -> str:
    """The public BPE vocabulary; ``PIECE_MODEL`` names another place for it."""
    if "PIECE_MODEL" in os.environ:
        return os.environ["PIECE_MODEL"]
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query()
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    return found.select(
        "doc_id",
        *(pii.count(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


@query()
def op2_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight and draw of every document; rows labelled as good are the target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("least"))
    good = stage(labels.where("least = 1 and doc_id is not null").select("doc_id", F.lit(True).alias("target")), "good")
    marked = docs.join(checked(good), "doc_id", "left").withColumn("target", F.coalesce("target", F.lit(False)))
    return importance.resample(marked, "target")


@query()
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_bpe.digests(docs, model_file()).drop("text")


@query(
    r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x{20}\x{09}-\x{0D}]+'), lambda x: x <> '') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + least(len(w), 5) - 1], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM doc WHERE len(w) > 0)),
size_ AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
both_ AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM both_ JOIN size_ p ON p.doc_id = a JOIN size_ q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM doc UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other),
root AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT doc.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc.doc_id = component_id AS kept
FROM doc LEFT JOIN size_ USING (doc_id) JOIN root USING (doc_id)"""
)
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query(
    r"""
WITH doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), lambda x: x <> '') AS w FROM documents),
item AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), lambda x: x <> '') AS w FROM benchmark),
window_ AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, list_aggregate(w[i:i + least(len(w), 13) - 1], 'string_agg', ' ') AS run
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM item WHERE len(w) > 0)),
size_ AS (SELECT DISTINCT n FROM window_),
run AS (
  SELECT doc_id, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, size_ WHERE len(w) >= n)),
hit AS (SELECT doc_id, n, i, item_id FROM run JOIN window_ USING (n, run)),
spot AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN spot USING (doc_id) LEFT JOIN named USING (doc_id)"""
)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a benchmark window."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = decontamination.scan(docs, table(spark, sf_dir, "benchmark"))
    return scanned.select(
        "doc_id",
        "n_words",
        decontamination.n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


def _canonical(text: str) -> str:
    """SQL for a text in canonical form, lines kept."""
    sql = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = rf"regexp_replace(replace({sql}, chr(13), chr(10)), '(?m)^[ \t]*(copyright|\(c\)|\x{{00A9}})[^\n]*$', '', 'g')"
    sql = rf"regexp_replace({sql}, '[^a-z0-9\x{{0080}}-\x{{10FFFF}}\n]+', ' ', 'g')"
    for old, new in licenses.SPELLINGS:
        sql = rf"regexp_replace({sql}, '\b{old}\b', '{new}', 'g')"
    return sql


_KNOWN = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.KNOWN)


@query(
    rf"""
WITH known AS (
  SELECT md5(trim(regexp_replace({_canonical("t")}, '[ 
]+', ' ', 'g'))) AS digest, min(l) AS license
  FROM (VALUES {_KNOWN}) AS k(l, t) GROUP BY 1),
doc AS (SELECT doc_id, {_canonical("coalesce(text, '')")} AS lines FROM documents),
whole AS (SELECT doc_id, md5(trim(regexp_replace(lines, '[ 
]+', ' ', 'g'))) AS text_digest FROM doc),
line AS (
  SELECT doc_id, license FROM (
    SELECT doc_id, md5(trim(regexp_replace(unnest(string_split(lines, chr(10))), ' +', ' ', 'g'))) AS digest FROM doc)
  JOIN known USING (digest)),
lines AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS names, count(*) AS n FROM line GROUP BY 1)
SELECT whole.doc_id, text_digest, license, coalesce(names, '') AS line_licenses, CAST(coalesce(n, 0) AS BIGINT) AS n_lines
FROM whole LEFT JOIN known ON digest = text_digest LEFT JOIN lines ON lines.doc_id = whole.doc_id"""
)
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that documents, or lines of theirs, are entirely."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity score of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from labelled rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    samples = langid.labelled_sample(docs)
    return langid.identify(docs.select("doc_id", "text"), samples).select(
        "doc_id", langid.in_fold().alias("held_out"), "lang_pred", "score"
    )


@query(
    """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.9),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other),
root AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY 1)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v LEFT JOIN n USING (vec_id) JOIN root USING (vec_id)"""
)
def op9_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 contiguous shards of near-equal bytes."""
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every sound embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query(
    r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x{0A}-\x{0D}]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x{20}\x{09}]+'), lambda x: x <> '') AS w FROM piece),
gram AS (
  SELECT lang, k, w[i:i + k - 1] AS words, count(*) AS f
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, generate_series(1, 5) AS s(k) WHERE len(w) >= k)
  GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM gram WHERE k = 1 GROUP BY 1),
frequent AS (SELECT lang, k, words, list_aggregate(words, 'string_agg', ' ') AS phrase, f FROM gram WHERE f >= 100),
cut AS (
  SELECT p.lang, p.phrase, p.k, p.f AS a, x.f AS l, y.f AS r, n, x.k AS first_words,
    CAST(1000::HUGEINT * p.f * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM frequent p JOIN frequent x ON x.lang = p.lang AND x.k < p.k AND x.words = p.words[1:x.k]
  JOIN frequent y ON y.lang = p.lang AND y.k = p.k - x.k AND y.words = p.words[x.k + 1:] JOIN total ON total.lang = p.lang),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, first_words) = 1),
closed AS (
  SELECT b.* FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM frequent o WHERE o.lang = b.lang AND o.k > b.k AND 100 * o.f >= 100 * b.a
      AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM closed) WHERE rank <= 2000"""
)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest collocations of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query(
    """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
place AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS w
  FROM (SELECT doc_id, h, unnest(generate_series(0, len(h) // 2 - 100)) AS i FROM doc WHERE len(h) >= 200)),
mark AS (SELECT doc_id, i FROM place QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
step AS (SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -101) + 100 AS new FROM mark),
span AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM step) GROUP BY doc_id, s),
cut AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head, max(b) AS tail,
    sum(b - a) AS n_removed, count(*) AS n_spans
  FROM cut JOIN doc USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)"""
)
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document without the passages that occur earlier."""
    docs = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
