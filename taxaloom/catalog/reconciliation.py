"""Names against an authority table, both made of the parts.

A part is a taxon named after its first word, second word and type. The
authority knows each name once per group under its smallest part, except names
that end in "bolt"; for parts of size above 25 its authors differ.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.catalog.registry import query, table
from taxaloom.functions import text
from taxaloom.operators import columns, reconcile
from taxaloom.session import stage

RANKS = {"ECONOMY": "family", "STANDARD": "subfamily", "SMALL": "genus", "MEDIUM": "species", "LARGE": "variety"}

TAXA_SQL = """
    taxa AS (
      SELECT CAST(p_partkey AS VARCHAR) AS id, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS taxon,
             upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' ' || p_brand AS name,
             CASE p_type WHEN 'ECONOMY' THEN 'family' WHEN 'STANDARD' THEN 'subfamily' WHEN 'SMALL' THEN 'genus'
                         WHEN 'MEDIUM' THEN 'species' WHEN 'LARGE' THEN 'variety' END AS rank,
             CASE WHEN p_size > 40 THEN 'synonym' ELSE 'accepted' END AS status,
             CASE WHEN p_size > 40 THEN CAST(p_partkey - 1 AS VARCHAR) END AS accepted,
             CASE WHEN p_partkey > 0 THEN CAST(p_partkey // 2 AS VARCHAR) END AS parent, p_brand AS published
      FROM part),
    requests AS (
      SELECT id, taxon, CASE rank WHEN 'family' THEN 'families' WHEN 'subfamily' THEN 'infrafamilies' WHEN 'genus' THEN 'genera'
                                  WHEN 'species' THEN 'species' WHEN 'variety' THEN 'infraspecies' END AS grp FROM taxa),
    authority AS (
      SELECT r.taxon, r.grp, CAST(r.id AS BIGINT) AS ref_id, t.published AS authors,
             '/n/' || r.id AS url, 'Ref. ' || r.id AS reference
      FROM requests r JOIN taxa t ON t.id = r.id WHERE r.taxon NOT LIKE '%bolt'),
    results AS (
      SELECT q.id, a.* EXCLUDE (id) FROM requests q LEFT JOIN (
        SELECT q2.id, a2.taxon AS ref_name, a2.authors, a2.url, a2.reference,
               row_number() OVER (PARTITION BY q2.id ORDER BY a2.ref_id) AS rn
        FROM requests q2 JOIN (
          SELECT taxon, grp, min_by(authors, ref_id) AS authors, min_by(url, ref_id) AS url,
                 min_by(reference, ref_id) AS reference, min(ref_id) AS ref_id
          FROM authority GROUP BY taxon, grp) a2
        ON a2.taxon = q2.taxon AND (q2.grp IS NULL OR a2.grp = q2.grp)) a ON a.id = q.id AND rn = 1)
"""
SUMMARY_SQL = (
    TAXA_SQL
    + """,
    summary AS (
      SELECT r.id, t.status, t.name AS wf_name, ref_name, authors, url, reference, COUNT(*) OVER (PARTITION BY ref_name) AS hits,
             ref_name || ' ' || authors AS ipni_name,
             CASE WHEN ref_name IS NULL THEN FALSE WHEN t.name = ref_name || ' ' || authors THEN TRUE
                  ELSE COUNT(*) OVER (PARTITION BY ref_name) = 1 END AS keep
      FROM results r JOIN taxa t ON t.id = r.id)
"""
)


def taxa(spark, sf_dir):
    large = F.col("p_size") > 40
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("taxonID"),
        F.concat_ws(" ", F.initcap(text.first_token("p_name")), text.epithet_token("p_name"), "p_brand").alias(
            "scientificName"
        ),
        text.decode_rank("p_type", RANKS).alias("taxonRank"),
        F.when(large, "synonym").otherwise("accepted").alias("taxonomicStatus"),
        F.when(large, (key - 1).cast("string")).alias("acceptedNameUsageID"),
        F.when(key > 0, F.floor(key / 2).cast("string")).alias("parentNameUsageID"),
        F.col("p_brand").alias("namePublishedIn"),
        F.lit(None).cast("string").alias("taxonRemarks"),
    )


def authority(spark, sf_dir):
    named = taxa(spark, sf_dir).select(
        F.substring_index("scientificName", " ", 2).alias("match_name"),
        text.rank_to_group("taxonRank").alias("match_group"),
        F.col("taxonID").cast("long").alias("ref_id"),
        F.col("namePublishedIn").alias("authors"),
        F.concat(F.lit("/n/"), "taxonID").alias("url"),
        F.concat(F.lit("Ref. "), "taxonID").alias("reference"),
    )
    known = named.filter(~F.col("match_name").endswith("bolt")).withColumn("name", F.col("match_name"))
    missing = [c for c in vocab.AUTHORITY_COLUMNS if c not in known.columns]
    return columns.assign_const(known, **dict.fromkeys(missing))


def results(spark, sf_dir):
    requests = reconcile.prepare_match_requests(taxa(spark, sf_dir))
    return stage(reconcile.match_reference(requests, authority(spark, sf_dir), priority=["ref_id"]), "matches")


@query(f"""WITH {TAXA_SQL} SELECT id AS "taxonID", taxon, grp AS ipni_filter FROM requests""")
def match_requests(spark, sf_dir):
    return reconcile.prepare_match_requests(taxa(spark, sf_dir))


@query(f"""WITH {TAXA_SQL} SELECT id AS "taxonID", ref_name AS name, authors, url, reference FROM results""")
def match_reference(spark, sf_dir):
    return results(spark, sf_dir).select("taxonID", "name", "authors", "url", "reference")


@query(
    f"""WITH {SUMMARY_SQL} SELECT id AS "taxonID", status AS "taxonomicStatus", wf_name AS wf_sci_name, hits AS n_ipni_hits,
        ipni_name AS ipni_sci_name, keep FROM summary"""
)
def match_summary(spark, sf_dir):
    summary = reconcile.summarise_matches(taxa(spark, sf_dir), results(spark, sf_dir))
    return summary.select("taxonID", "taxonomicStatus", "wf_sci_name", "n_ipni_hits", "ipni_sci_name", "keep")


@query(
    f"""
    WITH {SUMMARY_SQL},
    named AS (
      SELECT t.*, CASE WHEN keep THEN ipni_name ELSE name END AS final, CASE WHEN keep THEN reference ELSE published END AS pub,
             CASE WHEN keep THEN 'https://www.ipni.org' || url END AS link
      FROM taxa t LEFT JOIN summary s ON s.id = t.id)
    SELECT n.id AS "taxonID", n.final AS "scientificName", n.rank AS "taxonRank", n.status AS "taxonomicStatus",
           a.final AS "acceptedNameUsage", n.accepted AS "acceptedNameUsageID",
           CASE WHEN n.status = 'accepted' THEN p.final END AS "parentNameUsage",
           CASE WHEN n.status = 'accepted' THEN n.parent END AS "parentNameUsageID",
           n.pub AS "namePublishedIn", CAST(NULL AS VARCHAR) AS "taxonRemarks", n.link AS "ipniURL"
    FROM named n LEFT JOIN named a ON a.id = n.accepted LEFT JOIN named p ON p.id = n.parent
    """
)
def apply_reference(spark, sf_dir):
    rows = taxa(spark, sf_dir)
    return reconcile.apply_reference_names(rows, reconcile.summarise_matches(rows, results(spark, sf_dir)))


@query(
    r"""
    WITH asked AS (SELECT DISTINCT unnest(string_split_regex(text, '[^\p{L}]+')) AS word FROM documents),
    known AS (SELECT word, COUNT(*) AS n_items FROM (
      SELECT unnest(string_split_regex(text, '[^\p{L}]+')) AS word FROM benchmark) GROUP BY word)
    SELECT asked.word AS new_taxon, 'word' AS new_rank, n_items FROM asked LEFT JOIN known ON known.word = asked.word
    WHERE asked.word <> ''
    """
)
def new_name_status(spark, sf_dir):
    def words(name):
        split = F.explode(F.split("text", r"[^\p{L}]+"))
        return table(spark, sf_dir, name).select(split.alias("taxon")).filter("taxon <> ''")

    asked = words("documents").distinct().withColumn("rank", F.lit("word"))
    known = words("benchmark").groupBy("taxon").agg(F.count(F.lit(1)).alias("n_items"))
    return reconcile.new_name_status(asked, known)


@query(
    """
    WITH issues AS (
      SELECT upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS a, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS b,
             lower(p_brand) AS rank FROM part WHERE p_size > 25),
    asked AS (SELECT a AS taxon, rank FROM issues UNION ALL SELECT b, rank FROM issues),
    known AS (SELECT DISTINCT upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS taxon FROM part WHERE p_size > 3)
    SELECT asked.taxon AS new_taxon, asked.rank AS new_rank, known.taxon || ' Auth.' AS "scientificName"
    FROM asked LEFT JOIN known ON known.taxon = asked.taxon
    """
)
def new_names_report(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    name = F.concat_ws(" ", F.initcap(text.first_token("p_name")), text.epithet_token("p_name"))
    issues = parts.select(
        F.when(F.col("p_size") > 25, "[PASSED] new").otherwise("[VOTE] new").alias("title"),
        F.concat(name, F.lit(" and "), F.initcap(F.lower("p_type"))).alias("name"),
        F.lower("p_brand").alias("rank"),
    )
    current = parts.filter("p_size > 3").select(F.concat(name, F.lit(" Auth.")).alias("scientificName")).distinct()
    return reconcile.new_names_report(issues, current)


@query(
    """
    WITH known AS (
      SELECT upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' ' || translate(CAST(p_partkey * 7919 % 100003 AS VARCHAR), '0123456789', 'abcdefghij') AS name,
             p_partkey AS ref_id, p_size AS priority FROM part),
    asked AS (
      SELECT ref_id AS id, CASE ref_id % 5 WHEN 0 THEN name WHEN 1 THEN substr(name, 1, 2) || substr(name, 4) WHEN 2 THEN name || 'q'
                                WHEN 3 THEN substr(name, 1, 4) || 'xyz' || substr(name, 5) ELSE 'k' || substr(name, 2, length(name) - 2) END AS name
      FROM known),
    pairs AS (
      SELECT a.id, k.name AS match_name, levenshtein(a.name, k.name) AS distance, k.priority, k.ref_id
      FROM asked a JOIN known k ON abs(length(a.name) - length(k.name)) <= 2 AND levenshtein(a.name, k.name) BETWEEN 1 AND 2
      WHERE a.name NOT IN (SELECT name FROM known))
    SELECT CAST(id AS VARCHAR) AS "taxonID", match_name, CAST(distance AS INT) AS distance, CAST(ref_id AS BIGINT) AS ref_id
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, priority, ref_id) AS rn FROM pairs) WHERE rn = 1
    """
)
def similar_matches(spark, sf_dir):
    """Misspelt names (a letter lost, added or changed, or three added) and the authority's names next to them."""
    code = F.translate((F.col("p_partkey") * 7919 % 100003).cast("string"), "0123456789", "abcdefghij")
    name = F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substring(p_name, 2)"), F.lit(" "), code)
    known = table(spark, sf_dir, "part").select(
        name.alias("match_name"), F.col("p_partkey").cast("long").alias("ref_id"), F.col("p_size").alias("priority")
    )
    spelt = F.expr(
        """CASE ref_id % 5 WHEN 0 THEN match_name WHEN 1 THEN substring(match_name, 1, 2) || substring(match_name, 4)
           WHEN 2 THEN match_name || 'q' WHEN 3 THEN substring(match_name, 1, 4) || 'xyz' || substring(match_name, 5)
           ELSE 'k' || substring(match_name, 2, length(match_name) - 2) END"""
    )
    asked = known.select(F.col("ref_id").cast("string").alias("taxonID"), spelt.alias("taxon"))
    return reconcile.match_similar(asked, known, columns=["ref_id"])
