"""Files read by splits give what files read whole give."""

import csv
import io
import os
import random

import pytest
from test_ingest import FILES

from rosterloom.config import GuardLimits
from rosterloom.sources import landing, splits

HEAD = "first_name,last_name,company\n"


def made():
    """Files whose quoted line ends, separators and characters fall across splits."""
    draw = random.Random(4)
    pieces = ["a", "Bo", "é", "漢", "Ċਊ", " ", "\n", "\r\n", '"', "x,y", ";", "\t", "Ā", "lange Zeile " * 9]
    files = {}
    for n in range(4):
        out = io.StringIO()
        writer = csv.writer(out, delimiter=",;\t|"[n % 4], lineterminator="\n" if n % 2 else "\r\n")
        writer.writerow(["first_name", "last_name", "company", "Odd"])
        for i in range(90):
            writer.writerow(["".join(draw.choices(pieces, k=draw.randint(0, 6))) for _ in range(4)])
            if i % 11 == 3:
                out.write(draw.choice(["\n", "\r\n", "\n\n", ",,,\n"]))
        text = out.getvalue()
        files[f"made{n}.csv"] = text.encode()
        if n % 2:
            files[f"wide{n}.csv"] = text.encode("utf-16")
            files[f"signed{n}.csv"] = b"\xef\xbb\xbf" + text.encode()
        else:
            files[f"big_endian{n}.csv"] = b"\xfe\xff" + text.encode("utf-16-be")
        files[f"western{n}.csv"] = text.encode("cp1252", "replace") + b"Ren\xe9,\x80\x81,x\n"
    return files


ODD = {
    "literal.csv": (HEAD + 'a"b,c""d,"e"f"\n"x" y,z,\n').encode(),
    "open.csv": (HEAD + 'Ana,Lee,"never closed\nBo,Ng,x\n\n' + "Cy,Oh,y\n" * 600).encode(),
    "late_cr.csv": (HEAD + "Ana,Lee,x\n" * 500 + "An\rna,Lee,x\n" + "Bo,Ng,y\n" * 9).encode(),
    "two_cr.csv": (HEAD + '"q\n\n\rq",b,c\n' * 300 + "a\rb,c,d\n" + "a,b\rc,d\n" * 3).encode(),
    "header_cr.csv": b"\r\n\rfirst\r_name,last_name\nAna,Lee\n",
    "blank_first.csv": b"\n\r\n\r\n" * 900 + HEAD.encode() + b"Ana,Lee,x\n",
    "spaces_first.csv": b"   \n" * 900 + b"first_name;last_name\nAna;Lee\n",
    "quoted_header.csv": b'"first\nname",last_name,"first_name"\nAna,Lee,Bo\n',
    "no_end.csv": (HEAD + "Ana,Lee,x\n" * 450 + "Zoe,End,z").encode(),
    "late_byte.csv": (HEAD + "Ana,Lee,x\n" * 700 + "René,Lee,x\n").encode("cp1252"),
    "late_nul.csv": (HEAD + "Ana,Lee,x\n" * 500 + "A\0,Lee,x\n").encode(),
    "nothing.csv": b"",
}


def told(profile, rows):
    facts = {os.path.basename(r["path"]): (
        r["encoding"], r["delimiter"], r["warnings"], r["problem"], r["columns"],
        r["ignored_columns"]) for r in profile.collect()}
    lines = sorted((os.path.basename(r["path"]), *r[1:]) for r in rows.collect())
    return facts, lines


@pytest.fixture
def cut(spark):
    """Splits of a few bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "2003", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("limits", [GuardLimits(), GuardLimits(max_input_bytes=9000, max_rows=460)])
def test_same_rows_as_whole_files(spark, tmp_path, cut, monkeypatch, limits):
    files = FILES | made() | ODD
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    lines = splits.lines_of(spark, str(tmp_path))
    assert lines.select("path", "block").distinct().count() > 1.5 * len(files)
    want = told(*landing.registrants_of(landing.landing_files(spark, str(tmp_path)), limits))
    assert told(*splits.registrants_by_splits(spark, str(tmp_path), limits)) == want
    # Spark's readers pass over a file without bytes.
    assert len(want[0]) == len(files) - 1 and len(want[1]) > 150
    if limits.max_rows is None:
        monkeypatch.setattr(splits, "MOST_SENT", 0)  # blocks dealt out instead
        monkeypatch.setattr(splits, "LINES_PER_BLOCK", 7)
        assert told(*splits.registrants_by_splits(spark, str(tmp_path), limits)) == want


def test_a_field_of_a_megabyte_with_line_ends(spark, tmp_path):
    long = "lange Zeile\n" * 90_000
    text = HEAD + "Ana,Lee,x\n" * 3 + f'Bo,Ng,"{long}"\n' + "Cy,Oh,y\n"
    (tmp_path / "long.csv").write_text(text)
    (tmp_path / "ignored.csv").write_text("first_name,last_name,Odd\nAna,Lee,\"" + long + '"\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        by_splits = told(*splits.registrants_by_splits(spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert by_splits == told(*landing.registrants_of(
        landing.landing_files(spark, str(tmp_path))))
    assert [r[5] for r in by_splits[1] if r[2] == "Bo"] == [long.strip()]
    assert {p[3] for p in by_splits[0].values()} == {None}


@pytest.mark.parametrize("line,inside,want", [
    ("a,b", False, False), ('a,"b', False, True), ('a,"b"', False, False), ('a"b,c', False, False),
    ('"a""', False, True), ('"a"""', False, False), ('x"', True, False), ('x"",', True, True),
    ('x"y,"', True, True), ("", True, True), ("", False, False), ('"', False, True),
    (',"', False, True), ('"a" "b,c', False, False)])
def test_open_quotes(line, inside, want):
    assert splits.ends_open(line, ",", '"', inside) is want
    rows = list(csv.reader([('"' if inside else "") + line + "\n", "end,end\n"]))
    assert (len(rows) == 1 or rows == [[], ["end", "end"]] and False) is want or line == ""
