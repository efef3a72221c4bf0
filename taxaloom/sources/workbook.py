"""Workbooks (zipped XML sheets) as a data source: ``spark.read.format("workbook")``.

A sheet holds 1,048,576 rows at most, by its format. Spark's own file distribution brings the workbook to the executors, from
any store; a partition parses a range of rows, and stops behind it. All cells are text: numbers as they are
stored, dates in ISO form, truth values as TRUE and FALSE; empty cells and errors are null, as are cells that hold
``NA``. The first row that isn't empty names the columns.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from posixpath import basename
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from taxaloom.session import stage_path
from taxaloom.sources.quoted import column_names

#: rows of a sheet (a limit of the format), and of a partition
MOST_ROWS, RANGE_ROWS = 1_048_576, 65_536
#: numbers of the built-in formats that show dates or times (fixed values of the format)
DATE_FORMATS = frozenset([*range(14, 23), *range(45, 48)])
_PLACE = re.compile(r"([A-Z]+)(\d+)")


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _children(element: ElementTree.Element, name: str) -> list[ElementTree.Element]:
    return [e for e in element if _tag(e) == name]


def column_number(letters: str) -> int:
    """A is 0, Z is 25, AA is 26."""
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n - 1


def _text(element: ElementTree.Element) -> str:
    """Text of a string item: its runs, without phonetic hints."""
    parts = [e.text or "" for e in _children(element, "t")]
    for run in _children(element, "r"):
        parts += [e.text or "" for e in _children(run, "t")]
    return "".join(parts)


class Workbook:
    """An open workbook, and one of its sheets."""

    def __init__(self, path: str, sheet: str | None = None):
        self.zip = zipfile.ZipFile(path)
        book = ElementTree.fromstring(self.zip.read("xl/workbook.xml"))
        ids = {}
        for sheets in _children(book, "sheets"):
            for s in _children(sheets, "sheet"):
                ids[s.get("name")] = next(v for k, v in s.attrib.items() if k.endswith("}id"))
        if sheet is not None and sheet not in ids:
            raise ValueError(f"no sheet {sheet!r} among {list(ids)}")
        links = ElementTree.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target") for r in links}
        target = targets[ids[sheet] if sheet is not None else next(iter(ids.values()))]
        self.member = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        of_1904 = any(p.get("date1904") in ("1", "true") for p in _children(book, "workbookPr"))
        self.start = datetime(1904, 1, 1) if of_1904 else datetime(1899, 12, 30)
        self.dates = self._date_styles()

    def _date_styles(self) -> set[int]:
        """Numbers of the cell styles that show dates."""
        if "xl/styles.xml" not in self.zip.namelist():
            return set()
        styles = ElementTree.fromstring(self.zip.read("xl/styles.xml"))
        shown = set(DATE_FORMATS)
        for formats in _children(styles, "numFmts"):
            for f in formats:
                bare = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", f.get("formatCode", ""))
                if re.search("[ymdhs]", bare, re.IGNORECASE):
                    shown.add(int(f.get("numFmtId")))
        cells = [x for group in _children(styles, "cellXfs") for x in group]
        return {i for i, x in enumerate(cells) if int(x.get("numFmtId", "0")) in shown}

    def strings(self) -> list[str]:
        """The strings that cells name by number."""
        if "xl/sharedStrings.xml" not in self.zip.namelist():
            return []
        found = []
        with self.zip.open("xl/sharedStrings.xml") as stream:
            for _, element in ElementTree.iterparse(stream):
                if _tag(element) == "si":
                    found.append(_text(element))
                    element.clear()
        return found

    def date(self, number: str) -> str:
        days = float(number)
        # the format counts a 29th of February 1900
        moment = self.start + timedelta(days=days + (days < 60 and self.start.year == 1899), microseconds=1)
        return moment.date().isoformat() if days % 1 == 0 else moment.isoformat(" ", "seconds")

    def value(self, cell: ElementTree.Element, strings: list[str]) -> str | None:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            text = "".join(_text(e) for e in _children(cell, "is"))
        else:
            text = next((e.text for e in _children(cell, "v")), None)
            if text is None or kind == "e":
                return None
            if kind == "s":
                text = strings[int(text)]
            elif kind == "b":
                text = "TRUE" if text == "1" else "FALSE"
            elif kind == "n" and int(cell.get("s", "0")) in self.dates:
                text = self.date(text)
        return None if text in ("", "NA") else text

    def last_row(self) -> int:
        """Last row by the sheet's own word, or else by a look at all rows; enough to cut ranges."""
        number = 0
        with self.zip.open(self.member) as stream:
            for _, element in ElementTree.iterparse(stream, ["start"]):
                if _tag(element) == "dimension":
                    rows = [int(r) for _, r in _PLACE.findall(element.get("ref", ""))]
                    if len(rows) == 2:
                        return rows[1]
                if _tag(element) == "row":
                    number = int(element.get("r", number + 1))
        return number

    def rows(self, first: int, last: int, strings: list[str]) -> Iterator[tuple[int, dict[int, str]]]:
        """(row number, {column: value}) of the rows from first to last, but for empty ones."""
        with self.zip.open(self.member) as stream:
            number, parents = 0, []
            for event, element in ElementTree.iterparse(stream, ["start", "end"]):
                name = _tag(element)
                if event == "start":
                    if name == "sheetData":
                        parents.append(element)
                    continue
                if name != "row":
                    continue
                number = int(element.get("r", number + 1))
                if number > last:
                    return
                if number >= first:
                    found, column = {}, -1
                    for cell in _children(element, "c"):
                        place = _PLACE.match(cell.get("r", ""))
                        column = column_number(place[1]) if place else column + 1
                        value = self.value(cell, strings)
                        if value is not None:
                            found[column] = value
                    if found:
                        yield number, found
                parents[-1].clear()  # rows that are done


class RowRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.width = options, len(schema.fields)

    def open(self) -> Workbook:
        return Workbook(SparkFiles.get(self.options["file"]), self.options.get("sheet"))

    def partitions(self) -> list[InputPartition]:
        book = self.open()
        header = next((n for n, _ in book.rows(1, MOST_ROWS, book.strings())), 0)
        last, size = max(book.last_row(), header + 1), int(self.options.get("rangerows", RANGE_ROWS))
        ranges = [RowRange(s, s + size - 1) for s in range(header + 1, last + 1, size)]
        ranges[-1].last = MOST_ROWS  # whatever the sheet said
        return ranges

    def read(self, partition: RowRange) -> Iterator[tuple]:
        book = self.open()
        for number, cells in book.rows(partition.first, partition.last, book.strings()):
            yield (*(cells.get(i) for i in range(self.width - 1)), number)


class WorkbookSource(DataSource):
    """Options: ``file`` (name in Spark's distributed files), ``sheet`` (default: the first), ``rangerows``."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> StructType:
        book = Workbook(SparkFiles.get(self.options["file"]), self.options.get("sheet"))
        header = next((cells for _, cells in book.rows(1, MOST_ROWS, book.strings())), {})
        names = column_names([header.get(i, "") for i in range(max(header, default=-1) + 1)])
        return StructType([*(StructField(n, StringType()) for n in names), StructField("x_row", LongType())])

    def reader(self, schema: StructType) -> WorkbookReader:
        return WorkbookReader(dict(self.options), schema)


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows of a sheet as text, and their row number in ``x_row``."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    # under a name of its own, since distributed files are known by their names only
    source, copy = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{stage_path(spark, 'workbook')}.xlsx")
    jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, copy.getFileSystem(conf), copy, False, conf)
    spark.sparkContext.addFile(copy.toString())
    spark.dataSource.register(WorkbookSource)
    options = {"file": basename(copy.toString()), "rangeRows": str(range_rows)}
    return spark.read.format("workbook").options(**options | ({"sheet": sheet} if sheet else {})).load()


_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


def write_workbook(rows: DataFrame, path: str, sheet: str = "Sheet1") -> str:
    """A list for curators as a workbook of one sheet, strings shared. Rows beyond the format's limit are refused.

    The format is one compressed file, so the driver streams it, partition by partition, into a local file and puts that into the
    store: for bounded lists, not for tables.
    """
    strings: dict[str, int] = {}

    def row(number: int, values: tuple) -> str:
        cells = "".join(
            f'<c r="{letters[i]}{number}" t="s"><v>{strings.setdefault(str(v), len(strings))}</v></c>' for i, v in enumerate(values) if v is not None
        )
        return f'<row r="{number}">{cells}</row>'

    letters = [column_letters(i) for i in range(len(rows.columns))]
    handle, local = tempfile.mkstemp(suffix=".xlsx")
    os.close(handle)
    with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as out:
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = {"workbook": "sheet.main", "worksheets/sheet1": "worksheet", "sharedStrings": "sharedStrings"}
        types = "".join(f'<Override PartName="/xl/{p}.xml" ContentType="{kind}.{t}+xml"/>' for p, t in parts.items())
        rels = '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        out.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types">{rels}{types}</Types>')

        def links(name: str, targets: dict[str, str]) -> None:
            found = "".join(f'<Relationship Id="rId{i}" Type="{_OFFICE}/{t}" Target="{x}"/>' for i, (t, x) in enumerate(targets.items(), 1))
            out.writestr(name, f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">{found}</Relationships>')

        links("_rels/.rels", {"officeDocument": "xl/workbook.xml"})
        links("xl/_rels/workbook.xml.rels", {"worksheet": "worksheets/sheet1.xml", "sharedStrings": "sharedStrings.xml"})
        sheets = f'<sheets><sheet name={quoteattr(sheet)} sheetId="1" r:id="rId1"/></sheets>'
        out.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}">{sheets}</workbook>')
        with out.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as stream:
            stream.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>{row(1, tuple(rows.columns))}'.encode())
            for number, values in enumerate(rows.toLocalIterator(), 2):
                if number > MOST_ROWS:
                    raise ValueError(f"a sheet holds {MOST_ROWS} rows at most")
                stream.write(row(number, tuple(values)).encode())
            stream.write(b"</sheetData></worksheet>")
        with out.open("xl/sharedStrings.xml", "w", force_zip64=True) as stream:
            stream.write(f'{_HEAD}<sst xmlns="{_MAIN}">'.encode())
            for text in strings:
                stream.write(f'<si><t xml:space="preserve">{escape(text)}</t></si>'.encode())
            stream.write(b"</sst>")
    jvm, conf = rows.sparkSession._jvm, rows.sparkSession._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).moveFromLocalFile(jvm.org.apache.hadoop.fs.Path(f"file://{local}"), target)
    return path


def column_letters(number: int) -> str:
    letters = ""
    number += 1
    while number:
        number, digit = divmod(number - 1, 26)
        letters = chr(65 + digit) + letters
    return letters
