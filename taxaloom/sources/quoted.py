"""Delimited text with line breaks inside quotes, read in ranges by many tasks.

A range of a file can't tell whether it begins inside quotes. So each range is read twice. The first time its task finds out
how the range would end from either beginning: outside quotes, or inside. These answers, one row per range, are
composed in file order and give every range its true beginning. The second time the records of the ranges are put
together; a record that crosses cuts comes as fragments, at most two per range, which are glued. No task reads more
than its part of the scan, whatever the size of the file.

A part of the scan may hold many ranges, one behind the other: how large ranges are doesn't set the number of tasks and written files.
Ranges inside a part begin as the one before ends, so only the parts' beginnings are composed, one row per part.

Lines are what stands between line feeds; a carriage return before one belongs to the line break outside quotes. A
quote opens a field only at the field's beginning, and doubled quotes are one quote.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from taxaloom.session import stage_path

#: characters of a record from which an open quote is taken for an error
LONGEST_RECORD = 64 << 20
#: place of a record: number in the file name (files that Spark wrote), file, range, record in the range
PLACE = ["x_part", "x_file", "x_block", "x_row"]


class OpenQuote(ValueError):
    """A quoted field goes on for more than the longest record allowed."""


def _open_end(sep: str) -> re.Pattern:
    """Matches lines that begin with a field and end inside quotes. Loops never go back, so it is linear."""
    if len(sep) != 1 or sep in '"\n\r':
        raise ValueError("one character separates fields, and it is no quote or line break")
    s = re.escape(sep)
    begun = r'"[^"]*+(?:""[^"]*+)*+'
    return re.compile(rf'(?:(?:{begun}"[^{s}]*+|[^"{s}][^{s}]*+)?+{s})*+{begun}')


def ends_inside(line: str, inside: bool, open_end: re.Pattern) -> bool:
    """Whether a line ends inside quotes, by how it begins."""
    if '"' not in line:
        return inside
    return open_end.fullmatch('"' + line if inside else line) is not None


def _lines(spark: SparkSession, path: str, range_bytes: int | None) -> DataFrame:
    """(line, x_file, x_block, x_length) in file order within each part of the scan, which is not smaller than a range."""
    if range_bytes and range_bytes > spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes():
        spark = spark.newSession()  # a session of its own, since only sessions say how files are cut
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
        spark.conf.set("spark.sql.files.openCostInBytes", str(range_bytes))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("x_file"),
        F.col("_metadata.file_block_start").alias("x_block"),
        F.col("_metadata.file_block_length").alias("x_length"),
    )


def _by_range(
    batches: Iterator[pa.RecordBatch], range_bytes: int | None, *more: str
) -> Iterator[tuple[tuple, list[str], bool, bool]]:
    """(range, some lines of it in order, whether they are its first, or the first of a part) of the batches of a task."""
    part, last, at = None, None, 0
    for batch in batches:
        rows = batch.to_pydict()
        parts = list(zip(rows["x_file"], rows["x_block"], rows["x_length"], *(rows[c] for c in more), strict=True))
        sizes = pc.binary_length(batch["line"]).to_numpy(zero_copy_only=False) + 1
        start = 0
        while start < len(parts):
            end = start
            while end < len(parts) and parts[end] == parts[start]:
                end += 1
            if parts[start] != part:
                part, last, at = parts[start], None, 0
            x_file, begin, length = part[:3]
            begins = at + np.cumsum(sizes[start:end], dtype=np.int64) - sizes[start:end]
            at += int(sizes[start:end].sum())
            # a part's last line may begin right behind it
            ranges = np.minimum(begins, max(length - 1, 0)) // (range_bytes or max(length, 1))
            cuts = [0, *(np.flatnonzero(np.diff(ranges)) + 1).tolist(), end - start]
            for low, high in zip(cuts, cuts[1:]):
                key = (x_file, begin + int(ranges[low]) * (range_bytes or 0), *part[3:])
                yield key, rows["line"][start + low : start + high], key != last, last is None
                last = key
            start = end


def range_ends(lines: DataFrame, sep: str) -> DataFrame:
    """(x_file, x_block, from_outside, from_inside): whether a part ends inside quotes, from either beginning."""
    open_end = _open_end(sep)

    def run(batches):
        current, ends = None, (False, True)
        for key, part, first, _ in _by_range(batches, None):
            if first:
                if current:
                    yield _rows([(*current, *ends)])
                current, ends = key, (False, True)
            for line in part:
                if '"' in line:
                    ends = tuple(ends_inside(line, e, open_end) for e in ends)
        if current:
            yield _rows([(*current, *ends)])

    def _rows(rows):
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        names = ["x_file", "x_block", "from_outside", "from_inside"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return lines.mapInArrow(run, "x_file string, x_block long, from_outside boolean, from_inside boolean")


def range_beginnings(ends: DataFrame) -> DataFrame:
    """(x_file, x_block, inside): whether each range begins inside quotes.

    A range either ends alike from both beginnings, or keeps the beginning, or turns it round. So a beginning is the last
    settled end before it, turned as often as ranges since then turn it. The windows see one row per part of a file.
    """
    before = Window.partitionBy("x_file").orderBy("x_block").rowsBetween(Window.unboundedPreceding, -1)
    upto = before.rowsBetween(Window.unboundedPreceding, 0)
    turns = F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0)
    settled = F.when(F.col("from_outside") == F.col("from_inside"), (F.col("from_outside").cast("int") + F.col("turned")) % 2)
    turned = ends.withColumn("turned", F.sum(turns).over(upto)).withColumn("settled", settled)
    inside = F.coalesce(F.last("settled", ignorenulls=True).over(before), F.lit(0)) + F.coalesce(F.last("turned").over(before), F.lit(0))
    return turned.select("x_file", "x_block", (inside % 2 == 1).alias("inside"))


_FRAGMENT = "x_file string, x_block long, x_row long, head boolean, open boolean, record string"


def _fragments(lines: DataFrame, beginnings: DataFrame, sep: str, longest: int, range_bytes: int | None) -> DataFrame:
    """Records of each range: ``head`` goes on from the range before, ``open`` goes on in the next one."""
    open_end = _open_end(sep)
    names = [c.split()[0] for c in _FRAGMENT.split(", ")]

    def run(batches):
        out: list[tuple] = []
        held: list[str] = []
        key, row, size, inside, head = None, 0, 0, False, False

        def emit(is_open: bool) -> None:
            nonlocal row, size, head
            record = "\n".join(held)
            if not is_open and record.endswith("\r"):
                record = record[:-1]
            if head or is_open or record:  # blank lines are no records
                out.append((key[0], key[1], row, head, is_open, record))
                row += 1
            held.clear()
            size, head = 0, False

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for now, part, first, begins_part in _by_range(batches, range_bytes, "inside"):
            if first:
                if held:
                    emit(True)
                inside = now[2] if begins_part else inside
                key, row, head = now, 0, inside
            for line in part:
                held.append(line)
                size += len(line)
                inside = ends_inside(line, inside, open_end)
                if not inside:
                    emit(False)
                elif size > longest:
                    raise OpenQuote(f"{key[0]}: a field is open for more than {longest} characters, after byte {key[1]}")
            if len(out) >= 10_000:
                yield batch()
        if held:
            emit(True)
        yield batch()

    # one row per part, which the scan's driver has planned one by one
    known = lines.join(F.broadcast(beginnings), ["x_file", "x_block"])
    return known.mapInArrow(run, _FRAGMENT)


def _glued(fragments: DataFrame, longest: int) -> DataFrame:
    """Records that cross cuts, at the place where they begin."""
    order = Window.partitionBy("x_file").orderBy("x_block", "x_row")  # at most two rows per range
    begun = F.when(~F.col("head"), F.struct("x_block", "x_row"))
    chained = fragments.withColumn("begun", F.last(begun, ignorenulls=True).over(order))
    sizes = chained.groupBy("x_file", "begun").agg(F.sum(F.length("record")).alias("size"))
    broken = sizes.where(F.col("size") > longest).select("x_file", "begun.x_block").first()
    if broken:
        raise OpenQuote(f"{broken.x_file}: a field is open for more than {longest} characters, after byte {broken.x_block}")
    parts = F.sort_array(F.collect_list(F.struct("x_block", "x_row", "record")))
    whole = chained.groupBy("x_file", "begun").agg(F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))
    return whole.select("x_file", "begun.x_block", "begun.x_row", F.regexp_replace("record", r"\r$", "").alias("record"))


def read_records(spark: SparkSession, path: str, sep: str, range_bytes: int | None = None, longest: int = LONGEST_RECORD) -> DataFrame:
    """(x_file, x_block, x_row, record): the records of delimited files as text, quotes and all.

    They are written once. ``range_bytes`` is the size of a range; without it each part of the scan, as the session cuts it, is one.
    """
    lines = _lines(spark, path, range_bytes)
    beginnings = range_beginnings(range_ends(lines, sep))
    folder = stage_path(spark, "records")
    _fragments(lines, beginnings, sep, longest, range_bytes).write.parquet(folder)
    found = spark.read.schema(_FRAGMENT).parquet(folder)
    whole = found.where("not head and not open").drop("head", "open")
    return whole.unionByName(_glued(found.where("head or open"), longest))


def column_names(names: list[str]) -> list[str]:
    """Names that are missing or repeated are numbered, as Spark's reader of delimited text does."""
    seen = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if seen.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def header_names(header: str, sep: str) -> list[str]:
    """Column names of a header line."""
    return column_names(next(csv.reader([header.lstrip("﻿")], delimiter=sep), []))


def read_quoted(spark: SparkSession, path: str, sep: str = "|", range_bytes: int | None = None) -> DataFrame:
    """Fields of all records as text, and their ``PLACE``; ``NA`` is null. Every file begins with the same header."""
    records = read_records(spark, path, sep, range_bytes)
    is_header = (F.col("x_block") == 0) & (F.col("x_row") == 0)
    headers = records.where(is_header).select("record").distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValueError(f"headers differ: {headers[0].record!r}, {headers[1].record!r}")
    names = header_names(headers[0].record, sep) if headers else []
    schema = ", ".join("`{}` string".format(n.replace("`", "``")) for n in names) or "_c0 string"
    options = {"sep": sep, "escape": '"', "nullValue": "NA", "maxCharsPerColumn": "-1"}
    part = F.nullif(F.regexp_extract("x_file", r"part-(\d+)[^/]*$", 1), F.lit("")).cast("long").alias("x_part")
    fields = F.from_csv("record", schema, options).alias("fields")
    return records.where(~is_header).select(part, "x_file", "x_block", "x_row", fields).select("fields.*", *PLACE)
