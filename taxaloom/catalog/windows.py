"""Order- and group-based operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.catalog.registry import query, table
from taxaloom.functions import text
from taxaloom.operators import ordering, windows


@query(
    """
    SELECT event_id, event_type, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
             OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase
    FROM events
    """
)
def carry_forward_global(spark, sf_dir):
    events = _purchases(spark, sf_dir).select("event_id", "event_type", "last_purchase")
    return windows.carry_forward(events, ["last_purchase"], "event_id")


@query(
    """
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
             OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase
    FROM events
    """
)
def carry_forward_by_user(spark, sf_dir):
    events = _purchases(spark, sf_dir).select("event_id", "user_id", "last_purchase")
    return windows.carry_forward(events, ["last_purchase"], "event_id", ["user_id"])


def _purchases(spark, sf_dir):
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    return table(spark, sf_dir, "events").withColumn("last_purchase", bought)


@query(
    """
    SELECT user_id, event_type, event_id AS start,
           coalesce(CAST(lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS DOUBLE) - 1,
                    CAST('inf' AS DOUBLE)) AS "end"
    FROM events
    """
)
def next_start_intervals(spark, sf_dir):
    starts = table(spark, sf_dir, "events").select("user_id", "event_type", F.col("event_id").alias("start"))
    return windows.next_start_interval(starts, "start", "start", ["user_id", "event_type"], dense=True)


@query(
    """
    SELECT doc_id, CASE WHEN COUNT(*) OVER (PARTITION BY text) = 1 THEN 'synonym' ELSE 'ambiguous synonym' END
             AS "taxonomicStatus"
    FROM documents
    """
)
def alias_status(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.content_key("text").alias("text_key"))
    return windows.status_by_multiplicity(docs, ["text_key"], salt_by=["doc_id"]).drop("text_key")


@query(
    """
    SELECT event_id, user_id, COUNT(*) OVER (PARTITION BY user_id, event_type) AS n FROM events
    """
)
def add_count(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return windows.add_count(events, ["user_id", "event_type"], salt_by=["event_id"]).drop("event_type")


@query(
    """
    SELECT p_name, p_brand, p_type, min(p_partkey) AS p_partkey FROM part GROUP BY p_name, p_brand, p_type HAVING COUNT(*) = 1
    """
)
def unique_lookup(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_name", "p_brand", "p_type", "p_partkey")
    return windows.unique_only_lookup(parts, ["p_name", "p_brand", "p_type"])


@query(
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    WHERE rn = 1
    """
)
def first_hit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("place")
    )
    return windows.first_hit(orders, ["o_custkey"], ["place", "o_orderkey"]).drop("place")


@query(
    """
    SELECT "taxonID", "scientificName", row_number() OVER (
             ORDER BY coalesce(accepted, "scientificName"), accepted IS NOT NULL, "scientificName", "taxonID") AS row_no
    FROM (SELECT 'C' || c_custkey AS "taxonID", c_name AS "scientificName", NULL AS accepted FROM customer
          UNION ALL
          SELECT 'O' || o_orderkey, 'Order#' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0'),
                 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') FROM orders)
    """
)
def interleave(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("taxonID"),
        F.col("c_name").alias("scientificName"),
        F.lit(None).cast("string").alias("acceptedNameUsage"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O"), "o_orderkey").alias("taxonID"),
        F.concat(F.lit("Order#"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("scientificName"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("acceptedNameUsage"),
    )
    return ordering.interleave_aliases(customers.unionByName(orders), "row_no").drop("acceptedNameUsage")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (
             ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS row_no
    FROM lineitem
    """
)
def row_sequence(spark, sf_dir):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select(*order)
    return windows.number_rows(lines, order).select("l_orderkey", "l_linenumber", "l_partkey", "row_no")
