"""Checklist files in, taxon tables and treatments out."""

from __future__ import annotations

import csv
import io

from pyspark.errors.exceptions.captured import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom.operators.columns import clean_names, drop_empty_columns
from taxaloom.operators.ordering import sort_names
from taxaloom.operators.treatment import report_sort
from taxaloom.operators.windows import number_rows
from taxaloom.session import stage_path
from taxaloom.sources.quoted import PLACE, read_quoted
from taxaloom.sources.workbook import read_workbook


def read_delimited(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """All columns as text; empty fields and ``NA`` are null; doubled quotes are decoded."""
    options = {"sep": sep, "header": True, "escape": '"', "nullValue": "NA", "enforceSchema": False}
    return spark.read.options(**options).csv(path)


def field_count_violations(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """Lines of delimited files whose number of fields is not that of the header; separators in quotes don't count.

    The key is the first field.
    """
    from taxaloom.operators.quality import predicate, row_rules

    lines = spark.read.text(path)
    bare = F.regexp_replace("value", r'"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    header = lines.select(fields.alias("n")).first()
    expected = header["n"] if header else 0
    rows = lines.select(fields.alias("n"), F.substring_index("value", sep, 1).alias("key")).filter(F.length("value") > 0)
    return row_rules(rows, [predicate(F.col("n") != expected, "field_count", "key", F.col("n"))])


def number_lines(rows: DataFrame, name: str = "pos") -> DataFrame:
    """Rows of a file scan numbered 1..n in file order: file, block, place in the block.

    The numbered table is written once. ``rows`` is the scan itself. Files that Spark wrote are numbered, and a number
    sorts as one, not as text.
    """
    placed = rows.select(
        "*",
        F.nullif(F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1), F.lit("")).cast("long").alias("x_part"),
        F.col("_metadata.file_path").alias("x_file"),
        F.col("_metadata.file_block_start").alias("x_block"),
        F.monotonically_increasing_id().alias("x_row"),
    )
    return number_rows(placed, PLACE, name).drop(*PLACE)


def read_checklist(
    spark: SparkSession,
    path: str,
    sep: str = "|",
    pos: str = "pos",
    multi_line: bool = False,
    range_bytes: int | None = None,
) -> DataFrame:
    """Pipe-delimited checklist with clean headers and its file order in ``pos`` (1..n).

    Blank fields are null, as ``NA`` is; columns without any value are dropped. ``multi_line`` allows line breaks inside
    quotes: files are then read twice, in ranges (of ``range_bytes`` if given), see ``sources.quoted``.
    """
    if multi_line:
        numbered = number_rows(read_quoted(spark, path, sep, range_bytes), PLACE, pos).drop(*PLACE)
    else:
        numbered = number_lines(read_delimited(spark, path, sep), pos)
    names = clean_names(numbered.drop(pos)).columns
    fields = [F.nullif(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in zip(numbered.columns, names)]
    return drop_empty_columns(numbered.select(*fields, pos))


def read_exclusions(spark: SparkSession, path: str, sep: str = ",", sheet: str | None = None) -> DataFrame:
    """Curated list of duplicates, a workbook or delimited text: ``taxonID`` and ``comments_mh``."""
    is_workbook = path.lower().endswith(".xlsx")
    listed = clean_names(read_workbook(spark, path, sheet) if is_workbook else read_delimited(spark, path, sep))
    return listed.select(F.col("taxon_id").alias("taxonID"), "comments_mh")


def write_table_csv(df: DataFrame, path: str, order: list[str] | None = None) -> str:
    """CSV files with a header and empty fields for nulls; sorted over the files by ``order``."""
    rows = sort_names(df, *order) if order else df
    rows.write.options(
        header=True,
        nullValue="",
        emptyValue="",
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


def write_one_csv(df: DataFrame, path: str, order: list[str]) -> str:
    """One CSV file with a header, its lines sorted by ``order``.

    Tasks write sorted parts, which the file system joins in order. Where it can't (local disks, object stores), the
    driver's JVM copies them one behind the other as bytes: no row passes through Python or one task.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = stage_path(spark, "parts")
    rows = sort_names(df, *order)
    rows.write.options(
        header=False, nullValue="", emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(folder)
    target, source = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(conf)
    here = source.getFileSystem(conf)
    found = [f.getPath() for f in here.listStatus(source) if f.getPath().getName().startswith("part-") and f.getLen()]
    parts = sorted(found, key=lambda p: p.getName())  # numbered with leading zeros, in the order of the sort
    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow(df.columns)

    def write(behind: list) -> None:
        out = fs.create(target, True)
        try:
            out.write(bytearray(header.getvalue().encode()))
            for part in behind:
                stream = here.open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
                finally:
                    stream.close()
        finally:
            out.close()

    write([])
    same = fs.getUri().equals(here.getUri())
    if parts and not (same and _joined(spark, fs, target, parts)):
        write(parts)
    return path


def _joined(spark: SparkSession, fs, target, parts: list) -> bool:
    """Whether the file system has put the parts behind the target by itself."""
    array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, part in enumerate(parts):
        array[i] = part
    try:
        fs.concat(target, array)
    except UnsupportedOperationException:
        return False
    return True


def write_treatment(lines: DataFrame, path: str) -> str:
    """Text files whose lines, read in file order, are the treatment."""
    report_sort(lines).select("line").write.text(path)
    return path
