"""Whole workflows on a checklist made of the tables.

Regions are orders that each cover five major numbers, brands are families,
brand and type make a genus, and every part is a species with two packed
synonyms; its code is blank and comes from the genus row above it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.catalog.registry import query, table
from taxaloom.functions import text
from taxaloom.operators import columns, quality, summary
from taxaloom.operators.windows import number_rows
from taxaloom.plans import checklist as plans
from taxaloom.session import scratch_dir, stage
from taxaloom.sources.checklist import read_checklist

DIGITS, LETTERS = "0123456789", "abcdefghij"
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def raw_rows(spark, sf_dir, unknown_size=None):
    """Raw checklist rows in file order (``pos``); parts of ``unknown_size`` get an unknown rank code."""
    parts = table(spark, sf_dir, "part")
    brand = F.regexp_extract("p_brand", r"\d+", 0)
    brand_name = F.translate(brand, DIGITS, LETTERS)
    place = F.array_position(F.array(*[F.lit(t) for t in TYPES]), F.col("p_type"))
    genus = F.concat(F.initcap(F.lower("p_type")), brand_name)
    key = F.translate(F.col("p_partkey").cast("string"), DIGITS, LETTERS)
    none = F.lit(None).cast("string")

    def rows(df, major, minor, last, number, code, name, literature=none, synonyms=none):
        return df.select(
            major.cast("int").alias("_major"),
            minor.cast("int").alias("_minor"),
            last.cast("long").alias("_last"),
            number.alias("number"),
            (F.lit(code) if isinstance(code, str) else code).alias("taxon"),
            name.alias("name"),
            literature.alias("literature"),
            synonyms.alias("synonyms"),
        )

    start = F.col("r_regionkey") * 5 + 1
    orders = rows(
        table(spark, sf_dir, "region"),
        start,
        F.lit(0),
        F.lit(-1),
        F.concat(F.lpad(start.cast("string"), 3, "0"), F.lit(".")),
        "O",
        F.concat(F.initcap(F.lower(text.first_token("r_name"))), F.lit("ales &amp; Co.")),
    )
    families = rows(
        parts.select("p_brand").distinct(),
        brand,
        F.lit(1000),
        F.lit(-1),
        F.concat(F.lpad(brand, 3, "0"), F.lit(".1000")),
        "F",
        F.concat(F.lit("Brand"), brand_name, F.lit("aceae Fam.")),
    )
    minor = place * 10 + 1000
    genera = rows(
        parts.select("p_brand", "p_type").distinct(),
        brand,
        minor,
        F.lit(-1),
        F.concat(F.lpad(brand, 3, "0"), F.lit("."), minor.cast("string")),
        "G",
        F.concat(genus, F.lit(" Gen.")),
    )
    first, second = text.first_token("p_name"), text.epithet_token("p_name")
    species = rows(
        parts,
        brand,
        minor,
        F.col("p_partkey"),
        none,
        F.when(F.col("p_size") == unknown_size, "Q").otherwise("S") if unknown_size else "S",
        F.concat(genus, F.lit(" "), first, key, F.lit(" Sp.")),
        F.concat(F.lit("Bk. "), F.col("p_size").cast("string")),
        F.concat(
            F.lit("= "), genus, F.lit(" "), second, F.lit(" Syn. [Vol. "), F.col("p_size").cast("string"),
            F.lit("] = "), genus, F.lit(" "), second, key, F.lit(" var. "), first, F.lit(" Syn."),
        ),
    )
    stacked = columns.union_by_name(orders, families, genera, species)
    return number_rows(stacked, ["_major", "_minor", "_last"], "pos").drop("_major", "_minor", "_last")


def prepared(spark, sf_dir, unknown_size=None):
    return stage(plans.prepare_checklist(raw_rows(spark, sf_dir, unknown_size)), "checklist")


CHECKLIST_SQL = r"""
    p AS (
      SELECT *, CAST(regexp_extract(p_brand, '\d+') AS INT) AS b, translate(regexp_extract(p_brand, '\d+'), '0123456789', 'abcdefghij') AS bn,
             translate(CAST(p_partkey AS VARCHAR), '0123456789', 'abcdefghij') AS k,
             list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'], p_type) * 10 + 1000 AS mi,
             upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2))
               || translate(regexp_extract(p_brand, '\d+'), '0123456789', 'abcdefghij') AS genus,
             split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2 FROM part),
    o AS (SELECT r_regionkey * 5 + 1 AS b, upper(substr(r_name, 1, 1)) || lower(substr(split_part(r_name, ' ', 1), 2)) || 'ales' AS "order" FROM region),
    named AS (
      SELECT b, 0 AS mi, -1 AS last, 'order' AS rank, "order" || ' & Co.' AS name, NULL AS published, lpad(CAST(b AS VARCHAR), 3, '0') || '.' AS number,
             NULL AS genus, NULL AS up, NULL AS syn1, NULL AS pub1, NULL AS syn2 FROM o
      UNION ALL SELECT DISTINCT b, 1000, -1, 'family', 'Brand' || bn || 'aceae Fam.', NULL, lpad(CAST(b AS VARCHAR), 3, '0') || '.1000',
             NULL, NULL, NULL, NULL, NULL FROM p
      UNION ALL SELECT DISTINCT b, mi, -1, 'genus', genus || ' Gen.', NULL, lpad(CAST(b AS VARCHAR), 3, '0') || '.' || mi,
             genus, 'Brand' || bn || 'aceae Fam.', NULL, NULL, NULL FROM p
      UNION ALL SELECT b, mi, p_partkey, 'species', genus || ' ' || w1 || k || ' Sp.', 'Bk. ' || p_size, lpad(CAST(b AS VARCHAR), 3, '0') || '.' || mi,
             genus, genus || ' Gen.', genus || ' ' || w2 || ' Syn.', 'Vol. ' || p_size, genus || ' ' || w2 || k || ' var. ' || w1 || ' Syn.'
             FROM p),
    acc AS (
      SELECT n.*, o."order", md5(concat_ws(chr(31), n.name, coalesce(n.published, '\N'))) AS id,
             CASE WHEN n.rank <> 'order' THEN 'Brand' || translate(CAST(n.b AS VARCHAR), '0123456789', 'abcdefghij') || 'aceae' END AS family,
             CASE n.rank WHEN 'family' THEN o."order" || ' & Co.' ELSE n.up END AS parent_name
      FROM named n JOIN o ON n.b BETWEEN o.b AND o.b + 4),
    ids AS (SELECT name, id FROM acc),
    syn AS (
      SELECT a.*, s.*, md5(concat_ws(chr(31), a.id, s_name, coalesce(s_pub, '\N'))) AS s_id,
             CASE WHEN COUNT(*) OVER (PARTITION BY s_name) = 1 THEN 'synonym' ELSE 'ambiguous synonym' END AS s_status
      FROM acc a, LATERAL (SELECT a.syn1 AS s_name, a.pub1 AS s_pub, 'species' AS s_rank
                           UNION ALL SELECT a.syn2, NULL, 'variety') s WHERE a.rank = 'species')
"""


@query(
    f"""
    WITH {CHECKLIST_SQL}
    SELECT row_number() OVER (ORDER BY b, mi, last) AS pos, number, rank AS "taxonRank", name AS "scientificName",
           published AS "namePublishedIn", id AS "taxonID" FROM acc
    """
)
def checklist_rows(spark, sf_dir):
    return prepared(spark, sf_dir).select(
        "pos", "number", "taxonRank", "scientificName", "namePublishedIn", "taxonID"
    )


@query(
    f"""
    WITH {CHECKLIST_SQL}
    SELECT s_id AS "taxonID", id AS "acceptedNameUsageID", s_name AS "scientificName", s_pub AS "namePublishedIn",
           s_rank AS "taxonRank", s_status AS "taxonomicStatus", number FROM syn
    """
)
def explode_synonyms(spark, sf_dir):
    return plans.explode_synonyms(prepared(spark, sf_dir))


@query(
    f"""
    WITH {CHECKLIST_SQL}
    SELECT a.id AS "taxonID", a.name AS "scientificName", a.rank AS "taxonRank", 'accepted' AS "taxonomicStatus",
           NULL AS "acceptedNameUsage", i.id AS "parentNameUsageID", a.parent_name AS "parentNameUsage",
           a.published AS "namePublishedIn", a.genus, a.family, a."order"
    FROM acc a LEFT JOIN ids i ON i.name = a.parent_name
    UNION ALL
    SELECT s_id, s_name, s_rank, s_status, s.name, i.id, s.parent_name, s_pub, s.genus, s.family, s."order"
    FROM syn s LEFT JOIN ids i ON i.name = s.parent_name
    """
)
def dwc_taxa(spark, sf_dir):
    taxa = plans.checklist_to_taxa(prepared(spark, sf_dir)).taxa
    return taxa.select(
        "taxonID",
        "scientificName",
        "taxonRank",
        "taxonomicStatus",
        "acceptedNameUsage",
        "parentNameUsageID",
        "parentNameUsage",
        "namePublishedIn",
        "genus",
        "family",
        "order",
    )


@query(
    f"""
    WITH {CHECKLIST_SQL},
    bad AS (SELECT * FROM acc WHERE published = 'Bk. 50'),
    bad_syn AS (SELECT * FROM syn WHERE published = 'Bk. 50')
    SELECT rule, COUNT(*) AS n_violations FROM (
      SELECT 'rank_not_null' AS rule FROM bad UNION ALL SELECT 'parentless_accepted_is_order' FROM bad
      UNION ALL SELECT 'order_not_null' FROM bad UNION ALL SELECT 'order_not_null' FROM bad_syn
      UNION ALL SELECT 'parentless_synonym_of_order' FROM bad_syn WHERE s_status = 'synonym')
    GROUP BY rule
    """
)
def dwc_violations(spark, sf_dir):
    """Parts of size 50 have an unknown rank, so they and their synonyms stay without parent and order."""
    written = plans.write_checklist(plans.prepare_checklist(raw_rows(spark, sf_dir, unknown_size=50)))
    result = plans.checklist_to_taxa(written)
    return quality.count_violations(plans.taxa_violations(result))


@query(
    f"""
    WITH {CHECKLIST_SQL}
    SELECT rank AS "taxonRank", COUNT(*) AS wf_accepted,
           CAST(SUM(CASE WHEN rank = 'species' THEN 2 ELSE 0 END) AS BIGINT) AS wf_synonym FROM acc GROUP BY rank
    """
)
def dwc_counts(spark, sf_dir):
    return summary.count_taxa_by_rank(prepared(spark, sf_dir))


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS number, p_name AS name, CASE WHEN p_size > 3 THEN p_brand END AS literature,
           row_number() OVER (ORDER BY p_name, p_partkey) AS pos FROM part
    """
)
def read_checklist_file(spark, sf_dir):
    """Part table written as delimited files in name order, and read back in file order."""
    from uuid import uuid4

    path = f"{scratch_dir(spark)}/taxaloom/file-{uuid4().hex}"
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("Number"),
        F.col("p_name").alias("Name"),
        F.when(F.col("p_size") > 3, F.col("p_brand")).alias("Literature"),
        F.lit(None).cast("string").alias("Photo"),
    )
    rows.orderBy("Name", F.col("Number").cast("long")).write.csv(path, sep="|", header=True, nullValue="NA")
    return read_checklist(spark, path)
