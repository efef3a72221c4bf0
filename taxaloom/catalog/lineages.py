"""Hierarchies: region > nation > customer > order, as a node table."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.catalog.registry import query, table
from taxaloom.operators import columns, joins, lineage, ordering
from taxaloom.session import stage

# SQL of the node table; suppliers hang below their nation like customers do
NODES_SQL = """
    nodes AS (
      SELECT 'R' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent, 'order' AS rank, r_name || ' Auth.' AS name FROM region
      UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, 'family', n_name || ' Auth.' FROM nation
      UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, 'subfamily', s_name || ' Auth.' FROM supplier
      UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, 'genus', c_name || ' Auth.' FROM customer
      UNION ALL SELECT 'O' || o_orderkey, 'C' || o_custkey, 'species', 'Order ' || o_orderkey FROM orders)
"""


def nodes(spark, sf_dir):
    """Taxon table made of the five tables, all rows accepted."""

    def part(name, letter, key, parent, rank, label):
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(letter), key).alias("taxonID"),
            (F.concat(F.lit(parent[0]), parent[1]) if parent else F.lit(None).cast("string")).alias("parentNameUsageID"),
            F.lit(rank).alias("taxonRank"),
            label.alias("scientificName"),
        )

    def named(c):
        return F.concat(c, F.lit(" Auth."))

    return columns.union_by_name(
        part("region", "R", "r_regionkey", None, "order", named("r_name")),
        part("nation", "N", "n_nationkey", ("R", "n_regionkey"), "family", named("n_name")),
        part("supplier", "S", "s_suppkey", ("N", "s_nationkey"), "subfamily", named("s_name")),
        part("customer", "C", "c_custkey", ("N", "c_nationkey"), "genus", named("c_name")),
        part("orders", "O", "o_orderkey", ("C", "o_custkey"), "species", F.concat(F.lit("Order "), "o_orderkey")),
    )


@query(
    f"""
    WITH {NODES_SQL}
    SELECT n.id AS "taxonID", n.rank AS "taxonRank", p.name AS "parentNameUsage" FROM nodes n LEFT JOIN nodes p ON p.id = n.parent
    """
)
def lookup_fill(spark, sf_dir):
    filled = joins.lookup_fill(
        nodes(spark, sf_dir), "parentNameUsage", "scientificName", "taxonID", "parentNameUsageID"
    )
    return filled.select("taxonID", "taxonRank", "parentNameUsage")


@query(
    """
    SELECT o_orderkey, o_custkey, c_name, c_nationkey, n_name, n_regionkey, r_name FROM orders
    LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
    """
)
def lineage_flat(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return lineage.rank_chain_join(
        table(spark, sf_dir, "region"),
        [
            (table(spark, sf_dir, "nation"), "n_regionkey", "r_regionkey"),
            (customers, "c_nationkey", "n_nationkey"),
            (table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "c_custkey"),
        ],
    )


LINEAGE_SQL = f"""
    WITH RECURSIVE {NODES_SQL},
    chain AS (
      SELECT id, rank, name, parent FROM nodes
      UNION ALL SELECT c.id, n.rank, n.name, n.parent FROM chain c JOIN nodes n ON n.id = c.parent)
"""


@query(
    LINEAGE_SQL
    + """
    SELECT id AS "taxonID", max(CASE WHEN rank = 'genus' THEN split_part(name, ' ', 1) END) AS genus,
           CAST(NULL AS VARCHAR) AS tribe,
           max(CASE WHEN rank = 'subfamily' THEN split_part(name, ' ', 1) END) AS subfamily,
           max(CASE WHEN rank = 'family' THEN split_part(name, ' ', 1) END) AS family,
           max(CASE WHEN rank = 'order' THEN split_part(name, ' ', 1) END) AS "order"
    FROM chain GROUP BY id
    """
)
def lineage_columns(spark, sf_dir):
    full = lineage.ancestor_columns(nodes(spark, sf_dir), strip_author=True)
    return full.select("taxonID", *vocab.LINEAGE_RANKS)


@query(
    LINEAGE_SQL
    + """,
    flat AS (SELECT c.id, CASE r.rank WHEN c.rank THEN split_part(c.name, ' ', 1) END AS taxon, r.rank
             FROM chain c, (VALUES ('genus'), ('tribe'), ('subfamily'), ('family'), ('order')) r(rank))
    SELECT id AS "taxonID", rank, max(taxon) AS taxon FROM flat GROUP BY id, rank
    """
)
def lineage_long(spark, sf_dir):
    return lineage.pivot_longer_rank(lineage_columns(spark, sf_dir), "taxonID")


@query(
    LINEAGE_SQL
    + """
    SELECT id AS "taxonID", max(CASE WHEN rank = 'genus' THEN name END) AS genus,
           max(CASE WHEN rank = 'family' THEN name END) AS family
    FROM (SELECT id, rank, name FROM nodes UNION ALL
          SELECT n.id, p.rank, p.name FROM nodes n JOIN nodes p ON p.id = n.parent) GROUP BY id
    """
)
def lineage_wide(spark, sf_dir):
    rows = nodes(spark, sf_dir)
    above = rows.select(F.col("taxonID").alias("_id"), F.col("taxonRank").alias("rank"), F.col("scientificName").alias("name"))
    parents = joins.lookup_join(
        rows.select("taxonID", "parentNameUsageID"), above, [("parentNameUsageID", "_id")], salt_by=["taxonID"]
    ).drop("parentNameUsageID")
    own = rows.select("taxonID", F.col("taxonRank").alias("rank"), F.col("scientificName").alias("name"))
    return lineage.pivot_wider_rank(columns.union_by_name(own, parents), "taxonID", "rank", "name", ["genus", "family"])


ALIAS_SQL = """
    taxa AS (
      SELECT id, parent, rank, name, 'accepted' AS status, CAST(NULL AS VARCHAR) AS accepted FROM nodes
      UNION ALL SELECT 'P' || p_partkey, NULL, NULL, p_name || ' ' || p_partkey, 'synonym', 'S' || p_size FROM part
      UNION ALL SELECT 'L' || p_partkey, NULL, NULL, p_brand || ' ' || p_partkey, 'ambiguous synonym', 'O' || p_partkey FROM part)
"""


def taxa(spark, sf_dir):
    """The nodes, and two synonyms made of each part: one of a supplier, one of an order."""
    accepted = columns.assign_const(nodes(spark, sf_dir), taxonomicStatus="accepted", acceptedNameUsageID=None)

    def alias(letter, name, status, target):
        return table(spark, sf_dir, "part").select(
            F.concat(F.lit(letter), "p_partkey").alias("taxonID"),
            F.lit(None).cast("string").alias("parentNameUsageID"),
            F.lit(None).cast("string").alias("taxonRank"),
            F.concat_ws(" ", name, "p_partkey").alias("scientificName"),
            F.lit(status).alias("taxonomicStatus"),
            target.alias("acceptedNameUsageID"),
        )

    of_supplier = F.concat(F.lit("S"), "p_size")
    return columns.union_by_name(
        accepted,
        alias("P", "p_name", "synonym", of_supplier),
        alias("L", "p_brand", "ambiguous synonym", F.concat(F.lit("O"), "p_partkey")),
    )


@query(
    f"""
    WITH {NODES_SQL}, {ALIAS_SQL},
    kept AS (SELECT * FROM taxa WHERE rank IS NULL OR rank NOT IN ('species', 'form', 'subvariety', 'subspecies', 'variety'))
    SELECT id AS "taxonID", name AS "scientificName", rank AS "taxonRank" FROM kept
    WHERE accepted IS NULL OR accepted IN (SELECT id FROM kept)
    """
)
def filter_to_level(spark, sf_dir):
    return lineage.filter_to_level(taxa(spark, sf_dir)).select("taxonID", "scientificName", "taxonRank")


@query(
    LINEAGE_SQL
    + f""", {ALIAS_SQL},
    flat AS (
      SELECT id, max(CASE WHEN rank = 'genus' THEN split_part(name, ' ', 1) END) AS genus,
             max(CASE WHEN rank = 'subfamily' THEN split_part(name, ' ', 1) END) AS subfamily,
             max(CASE WHEN rank = 'family' THEN split_part(name, ' ', 1) END) AS family,
             max(CASE WHEN rank = 'order' THEN split_part(name, ' ', 1) END) AS "order"
      FROM chain GROUP BY id)
    SELECT t.id AS "taxonID", genus, subfamily, family, "order" FROM taxa t LEFT JOIN flat ON flat.id = coalesce(t.accepted, t.id)
    """
)
def attach_lineage(spark, sf_dir):
    full = lineage.attach_lineage(taxa(spark, sf_dir))
    return full.select("taxonID", "genus", "subfamily", "family", "order")


SORTED_SQL = (
    LINEAGE_SQL
    + f""", {ALIAS_SQL},
    flat AS (
      SELECT id, max(CASE WHEN rank = 'genus' THEN split_part(name, ' ', 1) END) AS genus,
             max(CASE WHEN rank = 'subfamily' THEN split_part(name, ' ', 1) END) AS subfamily,
             max(CASE WHEN rank = 'family' THEN split_part(name, ' ', 1) END) AS family,
             max(CASE WHEN rank = 'order' THEN split_part(name, ' ', 1) END) AS "order"
      FROM chain GROUP BY id),
    keyed AS (
      SELECT t.*, a.name AS accepted_name,
             concat_ws(' | ', coalesce(lpad(CAST(r_regionkey * 5 + 1 AS VARCHAR), 2, '0'), 'NA'),
               coalesce(CASE WHEN t.rank = 'order' THEN '0' WHEN t.rank IS NOT NULL THEN '1' END, 'NA'), coalesce(family, 'NA'),
               coalesce(CASE WHEN t.rank = 'family' THEN '0' WHEN t.rank IS NOT NULL THEN '1' END, 'NA'), coalesce(subfamily, 'NA'),
               coalesce(CASE WHEN t.rank = 'subfamily' THEN '0' WHEN t.rank IS NOT NULL THEN '1' END, 'NA'), 'NA',
               CASE WHEN t.rank IS NOT NULL THEN '1' ELSE 'NA' END, coalesce(genus, 'NA'),
               coalesce(CASE WHEN t.rank = 'genus' THEN '0' WHEN t.rank IS NOT NULL THEN '1' END, 'NA')) AS higher_tax
      FROM taxa t LEFT JOIN flat ON flat.id = coalesce(t.accepted, t.id) LEFT JOIN taxa a ON a.id = t.accepted
      LEFT JOIN region ON split_part(r_name, ' ', 1) = flat."order"),
    sorted AS (
      SELECT *, row_number() OVER (ORDER BY higher_tax, coalesce(accepted_name, name), accepted_name IS NOT NULL, name, id)
                AS sort_order FROM keyed)
"""
)


def sorted_taxa(spark, sf_dir):
    rows = taxa(spark, sf_dir)
    full = joins.lookup_fill(
        lineage.attach_lineage(rows),
        "acceptedNameUsage",
        "scientificName",
        "taxonID",
        "acceptedNameUsageID",
        keys_from=rows,
    )
    regions = table(spark, sf_dir, "region").select(
        F.col("r_name").alias("scientificName"),
        F.lit("order").alias("taxonRank"),
        (F.col("r_regionkey") * 5 + 1).alias("major_num"),
    )
    return ordering.hierarchical_sort(stage(full, "lineage"), regions)


@query(SORTED_SQL + """ SELECT id AS "taxonID", higher_tax, sort_order FROM sorted """)
def hierarchical_order(spark, sf_dir):
    return sorted_taxa(spark, sf_dir).select("taxonID", "higher_tax", "sort_order")
