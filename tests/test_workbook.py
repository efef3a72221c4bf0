"""Workbooks read in ranges of rows."""

import zipfile

import pytest

from taxaloom.sources import workbook
from taxaloom.sources.checklist import read_exclusions

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write(path, sheets, strings=(), styles=None, book="", dimension=""):
    """A workbook by hand: {name: XML of its rows}."""
    with zipfile.ZipFile(path, "w") as out:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets))
        out.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{OFFICE}">{book}<sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Target="{"/xl/" if i else ""}worksheets/s{i}.xml"/>' for i in range(len(sheets)))
        out.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        for i, rows in enumerate(sheets.values()):
            out.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {MAIN}>{dimension}<sheetData>{rows}</sheetData></worksheet>")
        if strings:
            out.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{''.join(f'<si>{s}</si>' for s in strings)}</sst>")
        if styles:
            out.writestr("xl/styles.xml", f"<styleSheet {MAIN}>{styles}</styleSheet>")
    return str(path)


def rows_of(spark, path, **options):
    found = workbook.read_workbook(spark, path, **options)
    return found.columns, [tuple(r) for r in found.orderBy("x_row").collect()]


def test_all_kinds_of_cells(spark, tmp_path):
    strings = ["<t>taxon ID</t>", "<t>When</t>", "<r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh>", '<t xml:space="preserve"> a &amp; b </t>', "<t>NA</t>"]
    styles = '<numFmts><numFmt numFmtId="200" formatCode="yyyy\\-mm&quot;red&quot;"/><numFmt numFmtId="201" formatCode="0.0&quot;d&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="200"/><xf numFmtId="201"/></cellXfs>'
    rows = (
        '<row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2" t="s"><v>1</v></c><c r="D2" t="s"><v>1</v></c></row>'
        '<row r="3"><c r="A3" t="s"><v>2</v></c><c r="B3" s="1"><v>45000</v></c><c r="D3" s="2"><v>45000.5</v></c></row>'
        '<row r="4"><c r="B4" s="3"><v>1.5</v></c><c r="C4" t="b"><v>1</v></c><c r="D4" t="e"><v>#N/A</v></c></row>'
        '<row r="5"/><row r="7"><c t="inlineStr"><is><t>in</t></is></c><c t="str"><v>calc</v></c><c s="1"><v>1</v></c><c t="s"><v>4</v></c></row>'
        '<row r="8"><c r="A8" t="s"><v>3</v></c><c r="B8"/><c r="AB8"><v>9</v></c></row>'
    )
    path = write(tmp_path / "book.xlsx", {"one": rows, "two": '<row r="1"><c r="A1"><v>5</v></c></row>'}, strings, styles)
    for size in (1, 2, 100):
        columns, found = rows_of(spark, path, range_rows=size)
        assert columns == ["taxon ID", "When1", "_c2", "When3", "x_row"]
        assert found == [
            ("rich", "2023-03-15", None, "2023-03-15 12:00:00", 3),
            (None, "1.5", "TRUE", None, 4),
            ("in", "calc", "1900-01-01", None, 7),
            (" a & b ", None, None, None, 8),
        ]
    assert rows_of(spark, path, sheet="two") == (["5", "x_row"], [])
    with pytest.raises(Exception, match="no sheet 'three'"):
        rows_of(spark, path, sheet="three")


def test_dates_from_1904_and_dimension(spark, tmp_path):
    styles = '<cellXfs><xf numFmtId="14"/></cellXfs>'
    rows = '<row><c t="inlineStr"><is><t>D</t></is></c></row>' + "".join(f'<row><c s="0"><v>{i}</v></c></row>' for i in range(1, 20))
    path = write(tmp_path / "b.xlsx", {"s": rows}, styles=styles, book='<workbookPr date1904="1"/>', dimension='<dimension ref="A1:A20"/>')
    found = workbook.read_workbook(spark, path, range_rows=4)
    assert found.rdd.getNumPartitions() == 5
    assert [r.D for r in found.orderBy("x_row").collect()] == [f"1904-01-{i + 1:02}" for i in range(1, 20)]


def test_round_trip_in_parallel(spark, tmp_path):
    rows = [(i, f"é <{i}> & \"x\" '", None if i % 3 else " delete\n me") for i in range(2500)]
    df = spark.createDataFrame(rows, "`Taxon ID` long, Other string, `Comments MH` string")
    path = workbook.write_workbook(df, str(tmp_path / "list.xlsx"), "A & B")
    found = workbook.read_workbook(spark, path, "A & B", range_rows=300)
    got = found.orderBy("x_row").collect()
    assert [(int(r[0]), r[1], r[2]) for r in got] == rows and [r.x_row for r in got] == list(range(2, 2502))
    assert len({r.p for r in found.selectExpr("spark_partition_id() AS p").distinct().collect()}) > 5
    listed = {r.taxonID: r.comments_mh for r in read_exclusions(spark, path).collect()}
    assert listed == {str(i): c for i, _, c in rows}
    empty = workbook.write_workbook(df.limit(0), str(tmp_path / "none.xlsx"))
    assert read_exclusions(spark, empty).count() == 0


def test_column_places():
    for i in (0, 25, 26, 701, 702, 16_383):
        assert workbook.column_number(workbook.column_letters(i)) == i
    assert workbook.column_letters(27) == "AB" and workbook.column_letters(16_383) == "XFD"
