"""Queries for the edges of the operators: deep trees, circles, overlapping and odd bands, unreadable names, files."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from taxaloom import vocab
from taxaloom.catalog.registry import query, table
from taxaloom.functions import names, text
from taxaloom.operators import columns, joins, lineage, parents, quality, reconcile, windows
from taxaloom.session import stage_path
from taxaloom.sources.checklist import number_lines, read_delimited, read_exclusions, write_table_csv
from taxaloom.sources.issues import read_issues
from taxaloom.sources.workbook import write_workbook


def _chained(spark, sf_dir):
    """Customers that each hang below the one 25 keys before: chains as long as the table allows."""
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("taxonID"),
        (F.col("c_custkey") - 25).cast("string").alias("parentNameUsageID"),
        F.when(segment == "BUILDING", "genus").when(segment == "MACHINERY", "family").alias("taxonRank"),
        F.col("c_name").alias("scientificName"),
    )


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS "taxonID",
           last_value(CASE WHEN c_mktsegment = 'BUILDING' THEN c_name END IGNORE NULLS) OVER w AS genus,
           last_value(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name END IGNORE NULLS) OVER w AS family
    FROM customer WINDOW w AS (PARTITION BY c_custkey % 25 ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """
)
def lineage_deep(spark, sf_dir):
    return lineage.ancestor_columns(_chained(spark, sf_dir), ranks=["genus", "family"]).select("taxonID", "genus", "family")


@query(
    """
    SELECT 'lineage_circle' AS rule, CAST(c_custkey AS VARCHAR) AS key,
           CAST(c_custkey - c_custkey % 100 + 7 AS VARCHAR) AS detail
    FROM customer WHERE c_custkey % 100 = 7
       OR (c_custkey % 100 IN (8, 9) AND c_custkey + 1 IN (SELECT c_custkey FROM customer))
    """
)
def lineage_circles(spark, sf_dir):
    """Keys that end in 07 are their own parents; the next three hang below them, one below the other."""
    place = F.col("c_custkey") % 100
    nodes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("taxonID"),
        F.when(place == 7, F.col("c_custkey"))
        .when(place.between(8, 10), F.col("c_custkey") - 1)
        .cast("string")
        .alias("parentNameUsageID"),
        F.lit("genus").alias("taxonRank"),
        F.col("c_name").alias("scientificName"),
    )
    resolved = lineage.resolve_nodes(nodes, "taxonID", "parentNameUsageID", "taxonRank", "scientificName", ["genus"])
    return lineage.circle_violations(resolved)


@query(
    """
    WITH RECURSIVE nodes AS (
      SELECT 'N' || n_nationkey AS id, CAST(NULL AS VARCHAR) AS parent, 'order' AS rank, n_name || ' Auth.' AS name FROM nation
      UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, 'genus', c_name || ' Auth.' FROM customer),
    chain AS (
      SELECT id, rank, name, parent FROM nodes
      UNION ALL SELECT c.id, n.rank, n.name, n.parent FROM chain c JOIN nodes n ON n.id = c.parent)
    SELECT id AS "taxonID", max(CASE WHEN rank = 'genus' THEN split_part(name, ' ', 1) END) AS genus,
           max(CASE WHEN rank = 'order' THEN split_part(name, ' ', 1) END) AS "order"
    FROM chain GROUP BY id
    """
)
def lineage_by_id(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), "n_nationkey").alias("taxonID"),
        F.lit(None).cast("string").alias("parentNameUsageID"),
        F.lit("order").alias("taxonRank"),
        F.concat("n_name", F.lit(" Auth.")).alias("scientificName"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("taxonID"),
        F.concat(F.lit("N"), "c_nationkey").alias("parentNameUsageID"),
        F.lit("genus").alias("taxonRank"),
        F.concat("c_name", F.lit(" Auth.")).alias("scientificName"),
    )
    taxa = columns.assign_const(nations.unionByName(customers), taxonomicStatus="accepted")
    return lineage.lineage_by_id(taxa).select("taxonID", "genus", "order")


OVERLAPS = [[(1, 10, "a"), (5, 12, "b")], [(1, 25, "c"), (10, 40, "d")], [(1, 1000, "e")]]


@query(
    """
    WITH bands(tier, low, high, tag) AS (
      VALUES (0, 1, 10, 'a'), (0, 5, 12, 'b'), (1, 1, 25, 'c'), (1, 10, 40, 'd'), (2, 1, 1000, 'e')),
    hits AS (SELECT p_partkey, tier, min(tag || p_brand) AS parent, COUNT(*) AS n
             FROM part JOIN bands ON p_size >= low AND p_size < high GROUP BY p_partkey, tier)
    SELECT p_partkey, min_by(parent, tier) AS parent, min_by(n, tier) AS n_matches FROM hits GROUP BY p_partkey
    """
)
def cascade_overlap(spark, sf_dir):
    """Bands that overlap inside a level: the smallest parent counts, and the number of bands is told."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    brands = parts.select("p_brand").distinct()

    def level(bands):
        rows = F.array(*[F.struct(F.lit(float(a)).alias("start"), F.lit(float(b)).alias("end"), F.lit(t).alias("t")) for a, b, t in bands])
        tagged = brands.select("p_brand", F.explode(rows).alias("r")).select("p_brand", "r.*")
        return tagged.withColumn("parent", F.concat("t", "p_brand")).drop("t")

    found = parents.cascade_parent(parts, [level(b) for b in OVERLAPS], ["p_brand"], "p_size", "p_partkey", "parent")
    return found.select("p_partkey", "parent", "n_matches")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, n_nationkey AS parent FROM lineitem
    LEFT JOIN nation ON l_discount BETWEEN n_nationkey / 250.0 AND n_nationkey / 250.0 + 0.003
    """
)
def range_parent_fraction(spark, sf_dir):
    """Bands far narrower than one."""
    bands = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("parent"), (F.col("n_nationkey") / F.lit(250.0)).alias("start")
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")
    found = parents.range_parent(lines, windows.fixed_width_interval(bands, "start", 0.003), "l_discount", "l_orderkey")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "parent")


@query(
    """
    SELECT o_orderkey, n_nationkey AS parent FROM orders
    LEFT JOIN nation ON o_custkey >= n_nationkey * 40 AND o_custkey < CASE WHEN n_nationkey = 24 THEN 9.99e99 ELSE n_nationkey * 40 + 39 END
    """
)
def range_parent_sentinel(spark, sf_dir):
    """The last band ends at a huge finite number."""
    last = F.col("n_nationkey") == 24
    start = (F.col("n_nationkey") * 40).cast("double")
    bands = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("parent"),
        start.alias("start"),
        F.when(last, F.lit(9.99e99)).otherwise(start + 39).alias("end"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    found = joins.interval_join(orders, bands, "o_custkey", "o_orderkey")
    return found.select("o_orderkey", "parent")


@query(
    """
    WITH ranked AS (
      SELECT 'O' || r_regionkey AS id, 'order' AS rank, r_regionkey * 5 + 1 AS major, 0 AS minor FROM region
      UNION ALL SELECT 'F' || n_nationkey, 'family', n_nationkey + 1, 1000 FROM nation
      UNION ALL SELECT 'S' || n_nationkey, 'subfamily', n_nationkey + 1, 2000 FROM nation
      UNION ALL SELECT 'T' || n_nationkey, 'tribe', n_nationkey + 1, 2100 FROM nation
      UNION ALL SELECT 'G' || c_custkey, 'genus', c_nationkey + 1, 1000 + c_custkey % 2000 FROM customer)
    SELECT id AS "taxonID", rank AS "taxonRank",
           CASE rank WHEN 'family' THEN 'O' || ((major - 1) // 5) WHEN 'subfamily' THEN 'F' || (major - 1)
                WHEN 'tribe' THEN 'S' || (major - 1)
                WHEN 'genus' THEN CASE WHEN minor >= 2100 AND minor < 2199 THEN 'T' || (major - 1)
                                       WHEN minor >= 2000 AND minor < 2999 THEN 'S' || (major - 1)
                                       WHEN minor >= 1000 AND minor < 1999 THEN 'F' || (major - 1) END END AS "parentNameUsageID"
    FROM ranked
    """
)
def parents_all_levels(spark, sf_dir):
    """Orders, families, subfamilies, tribes and genera: a genus takes its most specific band."""

    def rows(df, letter, key, rank, major, minor):
        return df.select(
            F.concat(F.lit(letter), key).alias("taxonID"),
            F.lit(None).cast("string").alias("number"),
            F.concat(F.lit("Name"), key).alias("scientificName"),
            F.lit(rank).alias("taxonRank"),
            F.lit(None).cast("string").alias("namePublishedIn"),
            major.cast("double").alias("major_num"),
            minor.cast("double").alias("minor_num"),
            F.lit("accepted").alias("taxonomicStatus"),
        )

    nation, key = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    ranked = columns.union_by_name(
        rows(table(spark, sf_dir, "region"), "O", F.col("r_regionkey"), "order", F.col("r_regionkey") * 5 + 1, F.lit(0)),
        rows(nation, "F", key, "family", key + 1, F.lit(1000)),
        rows(nation, "S", key, "subfamily", key + 1, F.lit(2000)),
        rows(nation, "T", key, "tribe", key + 1, F.lit(2100)),
        rows(
            table(spark, sf_dir, "customer"),
            "G",
            F.col("c_custkey"),
            "genus",
            F.col("c_nationkey") + 1,
            F.col("c_custkey") % 2000 + 1000,
        ),
    )
    return parents.assign_parents(ranked, ranked.filter("false")).select("taxonID", "taxonRank", "parentNameUsageID")


@query(
    """
    WITH t AS (
      SELECT CAST(p_partkey AS VARCHAR) AS id, CASE p_size % 4
               WHEN 0 THEN '?' || p_name WHEN 1 THEN lower(p_name) WHEN 2 THEN upper(substr(p_name, 1, 1)) || substr(p_name, 2)
             END AS name, p_size % 4 AS k, CASE WHEN p_size > 25 THEN 'variety' END AS rank FROM part)
    SELECT 'name_parsed' AS rule, id AS key, name AS detail FROM t WHERE k IN (0, 1)
    UNION ALL SELECT 'name_has_three_parts', id, name FROM t WHERE k = 2 AND rank = 'variety'
    """
)
def name_violations(spark, sf_dir):
    """Names that can't be read, and names of varieties with two parts."""
    name, k = F.col("p_name"), F.col("p_size") % 4
    capital = F.concat(F.upper(F.substring(name, 1, 1)), F.expr("substr(p_name, 2)"))
    taxa = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("taxonID"),
        F.when(k == 0, F.concat(F.lit("?"), name)).when(k == 1, F.lower(name)).when(k == 2, capital).alias("scientificName"),
        F.when(F.col("p_size") > 25, "variety").alias("taxonRank"),
    )
    return reconcile.name_violations(taxa)


@query(
    """
    SELECT user_id, event_id, epoch_us(ts) AS start,
           coalesce(CAST(lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DOUBLE) - 1,
                    CAST('inf' AS DOUBLE)) AS "end"
    FROM events
    """
)
def next_start_intervals_ts(spark, sf_dir):
    """Time stamps as positions, far apart; the event id keeps them unique."""
    events = table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("start"),
        F.struct("ts", "event_id").alias("place"),
    )
    return windows.next_start_interval(events, "start", "place", ["user_id"]).drop("place")


@query("SELECT CAST(doc_id AS VARCHAR) AS \"taxonID\", CASE WHEN toxic = 1 THEN 'please, delete' END AS comments_mh FROM labels")
def exclusions_file(spark, sf_dir):
    """A curated list written as a file with other columns, and read as exclusions."""
    path = stage_path(spark, "exclusions")
    listed = table(spark, sf_dir, "labels").select(
        F.col("quality").alias("Quality"),
        F.col("doc_id").alias("taxon ID"),
        F.when(F.col("toxic") == 1, "please, delete").alias("Comments MH"),
    )
    write_table_csv(listed, path)
    return read_exclusions(spark, path)


@query("SELECT CAST(doc_id AS VARCHAR) AS \"taxonID\", CASE WHEN toxic = 1 THEN 'please, <delete> & \"go\"' END AS comments_mh FROM labels")
def exclusions_workbook(spark, sf_dir):
    """A curated list written as a workbook and read as exclusions."""
    path = f"{stage_path(spark, 'exclusions')}.xlsx"
    listed = table(spark, sf_dir, "labels").select(
        F.col("quality").alias("Quality"),
        F.col("doc_id").alias("taxon ID"),
        F.when(F.col("toxic") == 1, 'please, <delete> & "go"').alias("Comments MH"),
    )
    write_workbook(listed, path, "Duplicates & more")
    return read_exclusions(spark, path, sheet="Duplicates & more")


@query(
    """
    SELECT CAST(p_partkey AS BIGINT) AS number, p_name AS title, 'https://github.com/a/issues/' || p_partkey AS url, 'u' || p_size AS "user",
           p_brand AS name, CASE WHEN p_size < 40 THEN lower(p_type) END AS rank
    FROM part WHERE p_size > 10
    """
)
def issues_file(spark, sf_dir):
    """Issue records written as JSON lines and read back; those marked as drafts are dropped."""
    path = stage_path(spark, "issues")
    brand = F.concat(F.lit("### Name of taxon\n\n"), "p_brand", F.lit("\n\n"))
    rank = F.when(F.col("p_size") < 40, F.concat(F.lit("### Rank of taxon\n\n"), F.lower("p_type"), F.lit("\n\n"))).otherwise("")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("number"),
        F.col("p_name").alias("title"),
        F.concat(F.lit("https://api.github.com/repos/a/issues/"), "p_partkey").alias("url"),
        F.struct(F.concat(F.lit("u"), "p_size").alias("login")).alias("user"),
        F.lit("open").alias("state"),
        F.concat(brand, rank).alias("body"),
        F.when(F.col("p_size") <= 10, F.lit(False)).alias("draft"),
    )
    rows.write.json(path)
    return read_issues(spark, path).select("number", "title", "url", "user", "name", "rank")


@query(
    """
    SELECT row_number() OVER (ORDER BY CASE WHEN c_nationkey <> 3 THEN c_mktsegment END NULLS LAST, c_name, c_custkey) AS row_no,
           CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS c_mktsegment, c_name
    FROM customer
    """
)
def sorted_names_file(spark, sf_dir):
    """Rows written in name order, nulls last, and numbered as they stand in the files."""
    path = stage_path(spark, "sorted")
    customers = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("c_mktsegment"), "c_name", "c_custkey"
    )
    write_table_csv(customers, path, ["c_mktsegment", "c_name", "c_custkey"])
    return number_lines(read_delimited(spark, path, ","), "row_no").select("row_no", "c_mktsegment", "c_name")


SUFFIX_SQL = ", ".join(f"('{i}', 'Aster{s} Auth.', '{r}')" for i, (s, r) in enumerate(vocab.UNINOMIAL_SUFFIXES))
MARKER_SQL = ", ".join(f"('{i + 20}', 'Aster albus {m} minor Auth.', '{r}')" for i, (m, r) in enumerate(vocab.INFRASPECIFIC_MARKERS))


@query(
    f"""
    WITH forms(k, name, rank) AS (VALUES {SUFFIX_SQL}, {MARKER_SQL}, ('30', 'Aster Auth.', 'genus'), ('31', 'Aster albus Auth.', 'species'),
      ('32', 'xAster x albus Auth.', NULL))
    SELECT p_partkey, name || ' ' || p_size AS name, rank FROM part JOIN forms
    ON p_partkey % 18 = CASE WHEN CAST(k AS INT) >= 30 THEN CAST(k AS INT) - 15 WHEN CAST(k AS INT) >= 20 THEN CAST(k AS INT) - 10 ELSE CAST(k AS INT) END
    """
)
def rank_rules(spark, sf_dir):
    """Every suffix and marker of the fixed rules, on names with authors."""
    forms = [f"Aster{s} Auth." for s, _ in vocab.UNINOMIAL_SUFFIXES]
    forms += [f"Aster albus {m} minor Auth." for m, _ in vocab.INFRASPECIFIC_MARKERS]
    forms += ["Aster Auth.", "Aster albus Auth.", "xAster x albus Auth."]
    form = F.get(F.array(*[F.lit(f) for f in forms]), (F.col("p_partkey") % len(forms)).cast("int"))
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", form, "p_size").alias("name"))
    return names.rank_from_name(parts, "name", "rank")


@query(
    "SELECT 'name_once' AS rule, p_name AS key, CAST(COUNT(*) AS VARCHAR) AS detail FROM part GROUP BY p_name HAVING COUNT(*) > 1"
)
def unique_violations(spark, sf_dir):
    return quality.rule_unique(table(spark, sf_dir, "part"), "p_name", "name_once")


@query("SELECT p_partkey, nullif(p_size, 7) AS p_size FROM part WHERE nullif(p_size, 7) IS NOT NULL")
def present_values(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.nullif("p_size", F.lit(7)).alias("p_size"))
    return parts.filter(text.is_present("p_size"))


@query(
    """
    SELECT row_number() OVER (ORDER BY p_partkey) AS pos, CAST(p_partkey AS VARCHAR) AS number, p_name || chr(10) || p_brand AS remarks FROM part
    """
)
def read_checklist_multiline(spark, sf_dir):
    """Fields with line breaks inside quotes, read in ranges of 2 kB, so that every file is cut inside quotes."""
    from taxaloom.sources.checklist import read_checklist

    path = stage_path(spark, "lines")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Number"), F.concat("p_name", F.lit("\n"), "p_brand").alias("Remarks")
    )
    rows.orderBy("Number").write.csv(path, sep="|", header=True, quoteAll=True, escape='"')
    return read_checklist(spark, path, multi_line=True, range_bytes=2_048).select("pos", "number", "remarks")


@query(
    """
    SELECT 'field_count' AS rule, CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_size < 5 THEN '2' ELSE '4' END AS detail
    FROM part WHERE p_size < 5 OR p_size > 45
    """
)
def field_counts(spark, sf_dir):
    """Lines with too few or too many fields."""
    from taxaloom.sources.checklist import field_count_violations

    path = f"{stage_path(spark, 'fields')}-{uuid4().hex}"
    line = F.concat(
        F.col("p_partkey").cast("string"),
        F.when(F.col("p_size") < 5, "|x").when(F.col("p_size") > 45, "|a|b|c").otherwise('|"a|""b"|c'),
    )
    lines = table(spark, sf_dir, "part").select(line.alias("value"))

    def with_header(batches):  # each task writes a file, which begins with the header
        first = True
        for batch in batches:
            if first and batch.num_rows:
                yield batch.from_pydict({"value": ["Number|Name|Remarks"]}, schema=batch.schema)
                first = False
            yield batch

    lines.mapInArrow(with_header, "value string").write.text(path)
    return field_count_violations(spark, path)
