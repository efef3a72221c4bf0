"""Treatment text."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from taxaloom.catalog.lineages import SORTED_SQL, sorted_taxa
from taxaloom.catalog.registry import query, table
from taxaloom.operators import treatment
from taxaloom.session import scratch_dir
from taxaloom.sources.checklist import number_lines, read_delimited, write_one_csv, write_treatment
from taxaloom.sources.checklist import write_table_csv as write_table_csv_files


LINES_SQL = (
    SORTED_SQL
    + r""",
    lines AS (
      SELECT id, sort_order - 0.5 AS place, 0 AS part, 'spacer' AS kind, '' AS line FROM sorted WHERE status = 'accepted'
      UNION ALL
      SELECT id, sort_order, 0, 'header',
             CASE rank WHEN 'order' THEN '## ' WHEN 'family' THEN '### ' WHEN 'subfamily' THEN '#### ' WHEN 'genus' THEN '###### ' ELSE '* ' END
             || CASE WHEN rank IN ('genus', 'species') THEN regexp_replace(name, '^(\w+)', '*\1*') ELSE name END || ' \-\- '
             || CASE WHEN rank = 'species' THEN 'NA  ' ELSE rank END
      FROM sorted WHERE status = 'accepted'
      UNION ALL
      SELECT id, sort_order + 0.1, 0, 'remarks', 'of ' || parent || '  ' FROM sorted WHERE status = 'accepted' AND parent IS NOT NULL
      UNION ALL
      SELECT s.accepted, a.sort_order + 0.2, s.sort_order, 'synonym', '= ' || s.name || ' \-\- NA  '
      FROM sorted s LEFT JOIN sorted a ON a.id = s.accepted WHERE s.status = 'synonym')
"""
)


@query(
    LINES_SQL
    + """
    SELECT id AS "taxonID", CAST(place AS DOUBLE) AS sort_order, CAST(part AS BIGINT) AS part_order, kind, line FROM lines
    """
)
def treatment_lines(spark, sf_dir):
    return _lines(spark, sf_dir)


def _lines(spark, sf_dir):
    rank = F.col("taxonRank")
    rows = sorted_taxa(spark, sf_dir).withColumns(
        {
            "namePublishedIn": F.when(rank != "species", rank),
            "taxonRemarks": F.concat(F.lit("of "), "parentNameUsageID"),
        }
    )
    return treatment.treatment_lines(rows)


@query(
    LINES_SQL
    + """
    SELECT row_number() OVER (ORDER BY place NULLS LAST, part, kind, id, line) AS line_no, line FROM lines
    """
)
def treatment_file(spark, sf_dir):
    """Treatment written as text files and read back in file order."""
    path = f"{scratch_dir(spark)}/taxaloom/treatment-{uuid4().hex}"
    write_treatment(_lines(spark, sf_dir), path)
    return number_lines(spark.read.text(path), "line_no").withColumnRenamed("value", "line")


@query("SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer")
def write_table_csv(spark, sf_dir):
    """Customers written as sorted CSV files and read back."""
    path = f"{scratch_dir(spark)}/taxaloom/table-{uuid4().hex}"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    write_table_csv_files(customers, path, ["c_name", "c_custkey"])
    back = read_delimited(spark, path, ",")
    return back.select(
        F.col("c_custkey").cast("long"), "c_name", "c_mktsegment", F.col("c_nationkey").cast("int")
    )


@query(
    """
    SELECT CAST(1 AS BIGINT) AS line_no, 'c_custkey,c_name,segment' AS line
    UNION ALL
    SELECT 1 + row_number() OVER (ORDER BY c_mktsegment, c_custkey),
           c_custkey || ',' || c_name || ',"a ""' || c_mktsegment || '"", b"' FROM customer
    """
)
def one_csv_file(spark, sf_dir):
    """Customers as one sorted CSV file with a header, read back line by line."""
    path = f"{scratch_dir(spark)}/taxaloom/one-{uuid4().hex}.csv"
    segment = F.concat(F.lit('a "'), "c_mktsegment", F.lit('", b')).alias("segment")
    write_one_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_name", segment), path, ["segment", "c_custkey"])
    return number_lines(spark.read.text(path), "line_no").withColumnRenamed("value", "line")
