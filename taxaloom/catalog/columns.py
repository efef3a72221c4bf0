"""Projections, filters, unions, counts and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.catalog.registry import query, table
from taxaloom.functions import text
from taxaloom.operators import columns, joins, quality, summary

# type of a part -> rank code, to run the rank operators on the part table
TYPE_CODES = {"ECONOMY": "O", "STANDARD": "F", "SMALL": "SF", "MEDIUM": "G", "LARGE": "S", "PROMO": "V"}


@query(
    """
    SELECT "taxonRank", COUNT(*) AS wf_accepted, CAST(SUM(2) AS BIGINT) AS wf_synonym FROM (
      SELECT CASE WHEN p_name LIKE 'red %' AND p_type = 'MEDIUM' THEN 'nothogenus'
                  WHEN p_name LIKE '% gear' AND p_type IN ('LARGE', 'PROMO') THEN 'hybrid'
                  WHEN p_type = 'ECONOMY' THEN 'order' WHEN p_type = 'STANDARD' THEN 'family'
                  WHEN p_type = 'SMALL' THEN 'subfamily' WHEN p_type = 'MEDIUM' THEN 'genus'
                  WHEN p_type = 'LARGE' THEN 'species' WHEN p_type = 'PROMO' THEN 'variety' END AS "taxonRank"
      FROM part)
    WHERE "taxonRank" IN ('order', 'family', 'subfamily', 'tribe', 'genus', 'nothogenus', 'species')
    GROUP BY "taxonRank"
    """
)
def count_by_rank(spark, sf_dir):
    name = F.regexp_replace(F.regexp_replace("p_name", "^red ", "xRed "), " gear$", " x gear")
    checklist = table(spark, sf_dir, "part").select(
        text.decode_rank(text.decode_rank("p_type", TYPE_CODES)).alias("taxonRank"),
        name.alias("scientificName"),
        F.concat(F.lit("= "), F.replace("p_name", F.lit(" "), F.lit(" = "))).alias("synonyms"),
    )
    return summary.count_taxa_by_rank(checklist)


@query(
    """
    SELECT c_custkey AS cust_key, c_name AS cust_name, c_nationkey AS cust_name_2, c_mktsegment AS mkt_segment
    FROM customer
    """
)
def clean_and_drop_empty(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustKey"),
        F.col("c_name").alias("Cust Name"),
        F.col("c_nationkey").alias("cust-name"),
        F.col("c_mktsegment").alias("mktSegment"),
        F.lit(None).cast("string").alias("Photo"),
        F.nullif("c_name", F.col("c_name")).alias("Always.Empty"),
    )
    return columns.drop_empty_columns(columns.clean_names(raw))


@query(
    """
    SELECT 'S' || s_suppkey AS "taxonID", s_name AS "scientificName", 'supplier' AS "taxonRank",
           CAST(NULL AS VARCHAR) AS "taxonRemarks" FROM supplier
    UNION ALL
    SELECT 'C' || c_custkey, c_name, 'customer', c_mktsegment FROM customer
    """
)
def union_terms(spark, sf_dir):
    suppliers = columns.rename_to_terms(
        table(spark, sf_dir, "supplier").withColumn("taxonID", F.concat(F.lit("S"), "s_suppkey")),
        {"s_name": "scientificName"},
    )
    customers = columns.rename_to_terms(
        table(spark, sf_dir, "customer").withColumn("taxonID", F.concat(F.lit("C"), "c_custkey")),
        {"c_name": "scientificName", "c_mktsegment": "taxonRemarks"},
    )
    return columns.select_terms(
        columns.union_by_name(
            columns.assign_const(suppliers, taxonRank="supplier"),
            columns.assign_const(customers, taxonRank="customer"),
        )
    )


@query(
    """
    SELECT doc_id, coalesce(CASE WHEN lang = 'en' THEN NULL ELSE lang END, source) AS label,
           CASE WHEN lang = 'fr' THEN text ELSE 'other' END AS fr
    FROM documents WHERE (lang IS NULL OR lang <> 'de') AND text NOT LIKE '%the the%'
    """
)
def filter_and_fill(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumns(
        {"label": F.nullif("lang", F.lit("en")), "fr": F.lit("other")}
    )
    kept = columns.exclude_incertae(docs.filter(text.not_in("lang", ["de"])), "text", "the the")
    filled = columns.fill_self_rank(columns.coalesce_columns(kept, "label", "label", "source"), "fr", "lang", "text")
    return columns.drop_columns(filled, "text", "lang", "absent", pattern="^n_")


@query(
    """
    SELECT o_orderkey, CASE WHEN s LIKE '%synonym%' THEN NULL ELSE o_custkey END AS "parentNameUsageID", s AS "taxonomicStatus"
    FROM (SELECT o_orderkey, o_custkey,
                 CASE o_orderstatus WHEN 'O' THEN 'accepted' WHEN 'F' THEN 'synonym' ELSE 'ambiguous synonym' END AS s
          FROM orders)
    WHERE s IN ('accepted', 'synonym', 'ambiguous synonym')
    """
)
def null_parent_for_aliases(spark, sf_dir):
    codes = {"O": "accepted", "F": "synonym", "P": "ambiguous synonym"}
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("parentNameUsageID"),
        text.decode_rank("o_orderstatus", codes).alias("taxonomicStatus"),
    )
    return columns.null_parent_for_aliases(columns.filter_status(rows, *codes.values()))


@query(
    """
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n,
           CAST(coalesce(SUM(CASE WHEN l_linestatus = 'O' THEN l_linenumber END), 0) AS BIGINT) AS open_lines
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def count_and_sum(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_returnflag", "l_linestatus"]
    open_line = F.when(F.col("l_linestatus") == "O", F.col("l_linenumber"))
    return summary.count_and_sum_by(lines, open_line, *keys, name="open_lines")


@query(
    """
    SELECT 'line_key_unique' AS rule, COUNT(*) AS n_violations FROM (
      SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
    UNION ALL SELECT 'key_not_null', COUNT(*) FROM lineitem WHERE nullif(l_linenumber, 3) IS NULL HAVING COUNT(*) > 0
    UNION ALL SELECT 'flag_in_values', COUNT(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') HAVING COUNT(*) > 0
    UNION ALL SELECT 'order_resolves', COUNT(*) FROM lineitem
      WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F') HAVING COUNT(*) > 0
    UNION ALL SELECT 'discount_below_tax', COUNT(*) FROM lineitem WHERE l_discount < l_tax HAVING COUNT(*) > 0
    UNION ALL SELECT 'one_order_per_part', COUNT(*) FROM (
      SELECT 1 FROM lineitem GROUP BY l_partkey HAVING COUNT(*) > 1) HAVING COUNT(*) > 0
    """
)
def quality_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    fulfilled = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    key = "l_orderkey"
    missing = F.nullif("l_linenumber", F.lit(3)).isNull()
    return quality.count_violations(
        quality.check(
            [
                quality.rule_unique_rows(lines, ["l_orderkey", "l_linenumber"], "line_key_unique"),
                quality.row_rules(
                    lines,
                    [
                        quality.predicate(missing, "key_not_null", key),
                        quality.in_values("l_returnflag", ["A", "N"], key, "flag_in_values"),
                        quality.predicate(F.col("l_discount") < F.col("l_tax"), "discount_below_tax", key),
                    ],
                ),
                quality.rule_membership(lines, "l_orderkey", fulfilled, "o_orderkey", "l_partkey", "order_resolves"),
                quality.rule_cardinality(lines, ["l_partkey"], "one_order_per_part"),
            ]
        )
    )


@query(
    """
    WITH t AS (
      SELECT 'O' || o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'accepted' WHEN 'F' THEN 'synonym' ELSE 'pending' END AS s,
             'O' || o_custkey AS acc, 'C' || o_custkey AS par FROM orders
      UNION ALL SELECT 'C' || c_custkey, 'accepted', NULL, 'C' || c_nationkey FROM customer)
    SELECT rule, COUNT(*) AS n_violations FROM (
      SELECT 'taxonomicStatus_in_values' AS rule FROM t WHERE s = 'pending'
      UNION ALL SELECT 'acceptedNameUsageID_resolves' FROM t WHERE acc IS NOT NULL AND acc NOT IN (SELECT id FROM t)
      UNION ALL SELECT 'acceptedNameUsageID_not_self' FROM t WHERE acc = id
      UNION ALL SELECT 'parentNameUsageID_resolves' FROM t WHERE par IS NOT NULL AND par NOT IN (SELECT id FROM t)
      UNION ALL SELECT 'parentNameUsageID_not_self' FROM t WHERE par = id
      UNION ALL SELECT 'column_names')
    GROUP BY rule
    """
)
def table_check(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O"), "o_orderkey").alias("taxonID"),
        F.when(F.col("o_orderstatus") == "O", "accepted")
        .when(F.col("o_orderstatus") == "F", "synonym")
        .otherwise("pending")
        .alias("taxonomicStatus"),
        F.concat(F.lit("O"), "o_custkey").alias("acceptedNameUsageID"),
        F.concat(F.lit("C"), "o_custkey").alias("parentNameUsageID"),
        F.col("o_orderpriority").alias("priority"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("taxonID"),
        F.lit("accepted").alias("taxonomicStatus"),
        F.concat(F.lit("C"), "c_nationkey").alias("parentNameUsageID"),
    )
    return quality.count_violations(quality.rule_table(columns.union_by_name(orders, customers)))


@query(
    """
    SELECT 'key_not_null' AS rule, COUNT(*) AS n_violations FROM lineitem WHERE nullif(l_linenumber, 3) IS NULL HAVING COUNT(*) > 0
    UNION ALL SELECT 'flag_in_values', COUNT(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') HAVING COUNT(*) > 0
    UNION ALL SELECT 'supplier_without_customers', COUNT(*) FROM (
      SELECT 1 FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer)) HAVING COUNT(*) > 0
    UNION ALL SELECT 'one_customer_per_nation', COUNT(*) FROM (
      SELECT 1 FROM customer GROUP BY c_nationkey HAVING COUNT(*) > 1) HAVING COUNT(*) > 0
    """
)
def measured_rules(spark, sf_dir):
    """Rules counted while tables are written: lines, and one customer per nation for a lookup that can't multiply."""
    key = "l_orderkey"
    lines = quality.write_measured(
        table(spark, sf_dir, "lineitem"),
        [
            quality.predicate(F.nullif("l_linenumber", F.lit(3)).isNull(), "key_not_null", key),
            quality.in_values("l_returnflag", ["A", "N"], key, "flag_in_values"),
            quality.predicate(F.col("l_quantity") < 0, "quantity_below_zero", key),
        ],
    )
    customers = table(spark, sf_dir, "customer").select("c_nationkey", "c_name")
    lookup = quality.write_measured_keys(customers, ["c_nationkey"], "one_customer_per_nation")
    suppliers = joins.lookup_join(table(spark, sf_dir, "supplier"), lookup.rows, [("s_nationkey", "c_nationkey")], skewed=False)
    matched = quality.write_measured(suppliers, [quality.predicate(F.col("c_name").isNull(), "supplier_without_customers", "s_suppkey")])
    return lines.counts().unionByName(lookup.counts()).unionByName(matched.counts())


@query(
    """
    SELECT 'part_and_supplier' AS rule, l_partkey || '|' || l_suppkey AS key, CAST(COUNT(*) AS VARCHAR) AS detail
    FROM lineitem GROUP BY l_partkey, l_suppkey HAVING COUNT(*) > 1
    UNION ALL SELECT 'line', l_orderkey || '|' || l_linenumber, CAST(COUNT(*) AS VARCHAR)
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
    UNION ALL SELECT 'first_line', CAST(CASE WHEN l_linenumber = 1 THEN l_orderkey END AS VARCHAR), CAST(COUNT(*) AS VARCHAR)
    FROM lineitem WHERE l_linenumber = 1 GROUP BY 2 HAVING COUNT(*) > 1
    UNION ALL SELECT 'flag_or_null', coalesce(nullif(l_returnflag, 'A'), 'NULL'), CAST(COUNT(*) AS VARCHAR)
    FROM lineitem GROUP BY nullif(l_returnflag, 'A') HAVING COUNT(*) > 1
    """
)
def unique_rules(spark, sf_dir):
    """Four uniqueness rules in one shuffle: keys of lines, pairs, first lines of orders, and flags with nulls."""
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {"first": F.when(F.col("l_linenumber") == 1, F.col("l_orderkey")), "flag": F.nullif("l_returnflag", F.lit("A"))}
    )
    rules = [
        quality.UniqueRule("line", ["l_orderkey", "l_linenumber"]),
        quality.UniqueRule("part_and_supplier", ["l_partkey", "l_suppkey"]),
        quality.UniqueRule("first_line", ["first"], nulls=False),
        quality.UniqueRule("flag_or_null", ["flag"]),
    ]
    return quality.rules_unique(lines, rules)
