"""Joins, parents by code and band, exclusion lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.catalog.registry import query, table
from taxaloom.functions import text
from taxaloom.operators import joins, parents, sweep, windows

PART_KEY = ["p_name", "p_brand", "p_type"]


@query(
    """
    SELECT o_orderkey, c_custkey AS parent FROM orders
    LEFT JOIN customer ON o_orderkey BETWEEN c_custkey * 10 + 1 AND c_custkey * 10 + 9
    """
)
def range_parent(spark, sf_dir):
    bands = windows.fixed_width_interval(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("parent"), (F.col("c_custkey") * 10 + 1).alias("start")
        ),
        "start",
        8,
    )
    children = table(spark, sf_dir, "orders").select("o_orderkey")
    return parents.range_parent(children, bands, "o_orderkey", "o_orderkey").drop("start", "end")


@query(
    """
    SELECT e.event_id, e.user_id, max(s.event_id) AS parent FROM events e
    LEFT JOIN events s ON s.user_id = e.user_id AND s.event_type = 'signup' AND s.event_id <= e.event_id
    GROUP BY e.event_id, e.user_id
    """
)
def open_interval_parent(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    starts = events.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("start"))
    bands = windows.next_start_interval(starts, "start", "start", ["user_id"], dense=True)
    bands = bands.withColumn("end", F.col("end") + 1).withColumn("parent", F.col("start"))
    found = joins.interval_join(
        events.select("event_id", "user_id"), bands, "event_id", "event_id", on=["user_id"]
    )
    return found.select("event_id", "user_id", "parent")


def _bands(parts, step, width, tag):
    """Bands of ``width`` that start at the first size of each ``step`` sizes of a brand."""
    start = (F.floor((F.col("p_size") - 1) / step) * step + 1).cast("double")
    starts = parts.select("p_brand", start.alias("start")).distinct()
    named = starts.withColumn("parent", F.concat(F.lit(tag), F.lit(":"), F.col("start").cast("long")))
    return windows.fixed_width_interval(named, "start", float(width))


@query(
    """
    SELECT e.event_id, e.user_id, max(s.event_id) AS parent FROM events e
    LEFT JOIN events s ON s.user_id = e.user_id AND s.event_type = 'signup' AND s.event_id <= e.event_id
    GROUP BY e.event_id, e.user_id
    """
)
def open_interval_sweep(spark, sf_dir):
    """As ``open_interval_parent``: events and signups in one sorted stream."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    starts = events.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("start"))
    found = sweep.last_start_join(events.select("event_id", "user_id"), starts, "event_id", on=["user_id"])
    return found.withColumnRenamed("start", "parent")


@query(
    """
    WITH bands AS (SELECT DISTINCT p_brand, (p_size - 1) // 10 * 10 + 1 AS start FROM part)
    SELECT p_partkey, 'wide:' || start AS parent FROM part
    LEFT JOIN bands ON bands.p_brand = part.p_brand AND p_size >= start AND p_size < start + 9
    """
)
def banded_parent(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    bands = _bands(parts, 10, 9, "wide")
    return parents.banded_parent(parts, bands, ["p_brand"], "p_size", "p_partkey").select("p_partkey", "parent")


@query(
    """
    WITH narrow AS (SELECT DISTINCT p_brand, (p_size - 1) // 20 * 20 + 1 AS start FROM part),
    wide AS (SELECT DISTINCT p_brand, (p_size - 1) // 10 * 10 + 1 AS start FROM part)
    SELECT p_partkey, coalesce('narrow:' || narrow.start, 'wide:' || wide.start, 'all:1') AS parent FROM part
    LEFT JOIN narrow ON narrow.p_brand = part.p_brand AND p_size >= narrow.start AND p_size < narrow.start + 4
    LEFT JOIN wide ON wide.p_brand = part.p_brand AND p_size >= wide.start AND p_size < wide.start + 9
    """
)
def cascade_parent(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    levels = [_bands(parts, 20, 4, "narrow"), _bands(parts, 10, 9, "wide"), _bands(parts, 1000, 999, "all")]
    return parents.cascade_parent(parts, levels, ["p_brand"], "p_size", "p_partkey", "parent").select(
        "p_partkey", "parent"
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, o_orderpriority FROM lineitem
    LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F'
    """
)
def equi_parent(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    fulfilled = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    columns = fulfilled.select("o_orderkey", "o_custkey", "o_orderpriority")
    return parents.equi_parent(lines, columns, [("l_orderkey", "o_orderkey")], "l_partkey")


@query(
    r"""
    WITH counted AS (SELECT *, COUNT(*) OVER (PARTITION BY p_name, p_brand, p_type) AS n FROM part)
    SELECT DISTINCT md5(concat_ws(chr(31), p_name, p_brand, p_type)) AS "taxonID", p_name || ' ' || p_brand AS "scientificName",
           p_type AS "taxonRank"
    FROM counted WHERE n > 1 AND p_size > 5
    """
)
def missing_parents(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", *PART_KEY)
    known = windows.unique_only_lookup(parts.select(*PART_KEY, "p_partkey"), PART_KEY)
    made = {"scientificName": text.full_name("p_name", "p_brand"), "taxonRank": F.col("p_type")}
    return parents.synthesise_parents(
        parts, known, PART_KEY, text.content_key(*PART_KEY), made, F.col("p_size") > 5
    )


@query(
    """
    WITH firsts AS (SELECT *, min(doc_id) OVER (PARTITION BY text) AS accepted FROM documents)
    SELECT d.doc_id AS "taxonID", f.source AS "parentNameUsageID" FROM firsts d JOIN documents f ON f.doc_id = d.accepted
    """
)
def parent_for_alias(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", text.content_key("text").alias("text_key"))
    firsts = docs.groupBy("text_key").agg(F.min("doc_id").alias("first_id"))
    copy = F.col("doc_id") != F.col("first_id")
    rows = joins.lookup_join(docs, firsts, "text_key", salt_by=["doc_id"]).select(
        F.col("doc_id").alias("taxonID"),
        F.when(copy, F.col("first_id")).alias("acceptedNameUsageID"),
        F.when(~copy, F.col("source")).alias("parentNameUsageID"),
    )
    return joins.parent_for_alias(rows).drop("acceptedNameUsageID")


@query(
    """
    SELECT doc_id, lang, source FROM documents
    WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id AND toxic = 1)
    """
)
def exclude_listed(spark, sf_dir):
    comment = F.when(F.col("toxic") == 1, "please delete").otherwise("keep")
    listed = table(spark, sf_dir, "labels").select("doc_id", comment.alias("comments_mh"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return joins.remove_listed(docs, listed, "doc_id")


@query(
    """
    SELECT p_partkey, p_name, p_type FROM part WHERE NOT EXISTS (
      SELECT 1 FROM part q WHERE q.p_size = 1 AND q.p_name = part.p_name AND q.p_type = part.p_type)
    """
)
def exclude_pairs(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    listed = parts.filter("p_size = 1").select("p_name", "p_type")
    return joins.exclude_pairs(parts.drop("p_size"), listed, ["p_name", "p_type"], salt_by=["p_partkey"])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
    """
)
def membership(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey")
    return joins.semi_join(lines, urgent, [("l_orderkey", "o_orderkey")])


@query(
    """
    SELECT o_orderkey, c_name, c_nationkey FROM orders LEFT JOIN (
      SELECT c_nationkey, min(c_name) AS c_name FROM customer GROUP BY c_nationkey) c ON c_nationkey = o_custkey
    """
)
def many_to_one(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_nationkey", "c_name")
    joined, _ = joins.many_to_one(orders, customers, [("o_custkey", "c_nationkey")])
    nation = F.when(F.col("c_name").isNotNull(), F.col("o_custkey").cast("int"))
    return joined.select("o_orderkey", "c_name", nation.alias("c_nationkey"))


@query(
    """
    SELECT rule, key, CAST(n AS VARCHAR) AS detail FROM (
      SELECT 'right_key_repeats' AS rule, CAST(o_custkey AS VARCHAR) AS key, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1
      UNION ALL
      SELECT 'left_key_repeats', CAST(c_nationkey AS VARCHAR), COUNT(*) FROM customer GROUP BY c_nationkey HAVING COUNT(*) > 1)
    """
)
def one_to_one_violations(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_nationkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return joins.one_to_one(customers, orders, [("c_nationkey", "o_custkey")])[1]


@query(
    r"""
    WITH ranked AS (
      SELECT p_partkey, p_brand, p_type = 'MEDIUM' AS is_species, split_part(p_name, ' ', 2) AS epithet,
             upper(substr(p_name, 1, 1)) || substr(split_part(p_name, ' ', 1), 2)
               || translate(regexp_extract(p_brand, '\d+'), '0123456789', 'abcdefghij') AS genus,
             CASE WHEN p_size <= 25 THEN split_part(p_name, ' ', 2) ELSE 'other' END AS infra FROM part),
    known AS (SELECT genus, epithet FROM ranked WHERE is_species GROUP BY genus, epithet HAVING COUNT(*) = 1)
    SELECT DISTINCT p_brand AS number, genus || ' ' || epithet || ' Aut.' AS "scientificName",
           md5(genus || ' ' || epithet || ' Aut.' || chr(31) || p_brand) AS "taxonID", 'autonym' AS "taxonRemarks"
    FROM ranked r WHERE NOT is_species AND infra = epithet
      AND NOT EXISTS (SELECT 1 FROM known k WHERE k.genus = r.genus AND k.epithet = r.epithet)
    """
)
def autonyms(spark, sf_dir):
    letters = F.translate(F.regexp_extract("p_brand", r"\d+", 0), "0123456789", "abcdefghij")
    genus = F.concat(F.initcap(text.first_token("p_name")), letters)
    epithet = text.epithet_token("p_name")
    is_species = F.col("p_type") == "MEDIUM"
    infra = F.when(F.col("p_size") <= 25, epithet).otherwise("other")
    name = F.when(is_species, F.concat_ws(" ", genus, epithet, F.lit("L."))).otherwise(
        F.concat_ws(" ", genus, epithet, F.lit("ssp."), infra, F.lit("Aut."))
    )
    ranked = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("taxonID"),
        F.col("p_brand").alias("number"),
        name.alias("scientificName"),
        F.when(is_species, "species").otherwise("subspecies").alias("taxonRank"),
        F.col("p_brand").alias("namePublishedIn"),
        F.lit(None).cast("double").alias("major_num"),
        F.lit(None).cast("double").alias("minor_num"),
    )
    made = parents.synthesise_autonyms(ranked)
    return made.select("number", "scientificName", "taxonID", "taxonRemarks")
