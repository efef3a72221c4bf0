"""Delimited files with line breaks inside quotes, cut into ranges."""

import csv
import io
import random

import pytest

from taxaloom.sources import quoted
from taxaloom.sources.checklist import read_checklist


def written(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, delimiter="|", lineterminator=end).writerows(rows)
    return out.getvalue()


def random_rows(seed, n):
    rng = random.Random(seed)
    words = ["a", "b c", "é", 'say "x"', "two\nlines", '"', "|", "\n", '"\n"', "plain", 'end"', "x" * 40]
    return [[str(i), *("".join(rng.choice(words) for _ in range(rng.randint(1, 6))) for _ in range(3))] for i in range(n)]


def read(spark, path, range_bytes):
    found = quoted.read_quoted(spark, str(path), "|", range_bytes)
    rows = found.orderBy(*quoted.PLACE).drop(*quoted.PLACE).collect()
    return found, [list(r) for r in rows]


@pytest.mark.parametrize(("range_bytes", "end"), [(64, "\n"), (333, "\r\n"), (1000, "\n"), (None, "\n")])
def test_ranges_give_the_rows_of_the_file(spark, tmp_path, range_bytes, end):
    rows = random_rows(range_bytes or 1, 300)
    (tmp_path / "list.csv").write_bytes(written([["Id", "A", "A", ""], *rows], end).encode())
    found, got = read(spark, tmp_path / "list.csv", range_bytes)
    assert found.columns[:4] == ["Id", "A1", "A2", "_c3"]
    assert got == rows
    ranges = {r.x_block for r in found.select("x_block").distinct().collect()}
    assert len(ranges) > (8 if range_bytes else 0)


def test_small_ranges_make_no_more_tasks(spark, tmp_path, monkeypatch):
    """Parts of a scan hold many ranges, which are cut alike whether the scan has one part or many."""
    rows = random_rows(9, 400)
    path = tmp_path / "list.csv"
    path.write_bytes(written([["Id", "A", "B", "C"], *rows]).encode())
    folders = []
    monkeypatch.setattr(quoted, "stage_path", lambda s, tag: folders.append(str(tmp_path / f"{tag}{len(folders)}")) or folders[-1])
    parted = spark.newSession()
    parted.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    parted.conf.set("spark.sql.files.openCostInBytes", "3000")
    size = path.stat().st_size
    for session, parts in ((spark, 1), (parted, size // 3000 + 1)):
        found, got = read(session, path, 100)
        assert got == rows
        assert found.select("x_block").distinct().count() > size / 400
        written_ = [f for f in (tmp_path / folders[-1]).iterdir() if f.name.startswith("part-")]
        assert len(written_) <= 8 if parts == 1 else parts - 1 <= len(written_) <= parts
    assert read(parted, path, 5000)[1] == rows and read(parted, path, None)[1] == rows


def test_a_field_longer_than_many_ranges(spark, tmp_path):
    long = "\n".join(f'line {i} "" | {i}' for i in range(400))
    rows = [["1", "x"], ["2", long], ["3", "y"], ["4", long], ["5", "z"]]
    (tmp_path / "list.csv").write_text(written([["Id", "Text"], *rows]))
    found, got = read(spark, tmp_path / "list.csv", 512)
    assert got == rows
    path = str(tmp_path / "list.csv")
    for small in (100, 3000):  # found within a range, and over ranges
        with pytest.raises(Exception, match="a field is open for more than"):
            quoted.read_records(spark, path, "|", 512 if small > 512 else None, longest=small).count()


def test_quotes_inside_unquoted_fields(spark, tmp_path):
    """Only a quote at the beginning of a field opens it, so parity alone would be wrong."""
    lines = ["Id|Text|More"] + [f'{i}|5" wide|"a\n""b""|{i}"' for i in range(50)]
    (tmp_path / "list.csv").write_text("\n".join(lines) + "\n")
    _, got = read(spark, tmp_path / "list.csv", 100)
    assert got == [[str(i), '5" wide', f'a\n"b"|{i}'] for i in range(50)]


def test_several_files_blank_lines_and_null(spark, tmp_path):
    for part in range(3):
        body = written([["Number", "Name", "Empty"], *([str(part * 10 + i), f"n\n{i}", ""] for i in range(4))])
        (tmp_path / f"part-{part:05}.csv").write_text(body.replace("n\n2", "NA") + "\n\n")
    got = read_checklist(spark, str(tmp_path), multi_line=True, range_bytes=20).orderBy("pos").collect()
    assert [(r.pos, r.number) for r in got] == [(k + 1, str(k // 4 * 10 + k % 4)) for k in range(12)]
    assert [r.name for r in got][:4] == ["n\n0", "n\n1", None, "n\n3"] and "empty" not in got[0].asDict()
    (tmp_path / "part-00009.csv").write_text("Number|Other|Empty\n")
    with pytest.raises(ValueError, match="headers differ"):
        read_checklist(spark, str(tmp_path), multi_line=True)


def test_header_only_and_open_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Id|"Na\nme"\n')
    found, got = read(spark, tmp_path / "a.csv", 4)
    assert found.columns[:2] == ["Id", "Na\nme"] and got == []


def test_line_states():
    open_end = quoted._open_end("|")
    state = lambda line, inside=False: quoted.ends_inside(line, inside, open_end)
    assert not state("a|b") and state("a|b", True) and state('a|"b') and not state('a|"b"')
    assert state('"a""') and not state('"a"""') and not state('a"b|c"') and not state('b"|c', True)
    assert state('b"|"c', True) and state('b""', True) and not state('"x"y|z')
    assert not state('"' * 200_000) and state('"' * 200_001) and state('|"a"' * 50_000 + '|"')
