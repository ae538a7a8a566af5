"""Landed files: encodings, delimiters, headers, malformed input, consent, golden files."""

import os

import pytest
from pyspark.sql import functions as F

from rosterloom.config import GuardLimits
from rosterloom.operators import validation
from rosterloom.sources import landing

SIGNUPS = """First Name,Surname,E-mail,Employer,City,LinkedIn,Lunch
Marta,Kowalska,marta.k@nowhere,,,,vegan
Ibrahim,Sow,,none,,https://www.linkedin.com/in/ibrahim-sow-77/,fish
Chloe,Dubois,,,,see my card,fish
  Søren ,Ålund,,Fjord Tools,Bergen,,vegan
unknown,unknown,,,,,fish
B52,X4,,,,,fish
marta.k@nowhere.org,Kowalska,,,,,vegan
First Name,Surname,E-mail,Employer,City,LinkedIn,Lunch
,,,,,,
Marta,Kowalska,,,,,fish
"""

FILES = {
    "signups.csv": SIGNUPS.encode(),
    "semicolon.csv": "first_name;last_name\nJosé;García\n".encode("cp1252"),
    "utf16.csv": "first_name\tlast_name\nAna\tLee\n".encode("utf-16"),
    "bom.csv": b"\xef\xbb\xbffirst_name,last_name\nAna,Lee\n",
    "cr.csv": b"first_name,last_name\nAn\ra,Lee\n",
    "nul.csv": b"first_name,last_name\nAn\x00a,Lee\n",
    "empty.csv": b"\r\n\r\n",
    "headeronly.csv": b"first_name,last_name\n",
    "missing.csv": b"first_name,email\nAna,a@b.co\n",
    "twice.csv": b"First Name,first,Surname,Badge\nAna,Bea,Lee,7\n",
    "ragged.csv": b"first_name,last_name,email\nAna,Lee\nBo,Ng,b@x.io,extra\n",
    "quoted.csv": b'first_name,last_name,company\nAna,"O""Neil, Jr","multi\nline"\n',
    "junk.csv": b"first_name,last_name\n" + b"test,test\n" * 6 + b"John,Doe\n" * 2,
    "consent.csv": b"first_name,last_name,consent\nA,B,yes\nA,B,no\nA,B,\nA,B,maybe\n",
    "big.csv": b"first_name,last_name\n" + b"Ana,Lee\n" * 40,
}


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("incoming")
    for name, data in FILES.items():
        (folder / name).write_bytes(data)
    return landing.landing_files(spark, str(folder))


@pytest.fixture(scope="module")
def parsed(landed):
    small = GuardLimits(max_input_bytes=len(SIGNUPS.encode()) + 1)
    profile, rows = landing.registrants_of(landed.filter(~F.col("path").endswith("big.csv")), small)
    cleaned = validation.clean_rows(rows)
    verdict = validation.contract_dry_run(profile, cleaned)
    files = {os.path.basename(r["path"]): r for r in verdict.collect()}
    lines = {}
    for r in cleaned.collect():
        lines.setdefault(os.path.basename(r["path"]), {})[r["row_number"]] = r
    return files, lines


def test_signups(parsed):
    files, lines = parsed
    rows = lines["signups.csv"]
    assert files["signups.csv"]["accepted"]
    assert files["signups.csv"]["warnings"] == ["ignored_columns: Lunch"]
    assert sorted(n for n, r in rows.items() if r["reason"] is None) == [1, 2, 3, 4, 10]
    assert sorted(n for n, r in rows.items() if r["reason"]) == [5, 6, 7, 8]
    assert rows[1]["notes"] == ["input.email_invalid"]
    assert rows[2]["notes"] == ["input.company_placeholder"]
    assert rows[2]["linkedin_url"] == "linkedin.com/in/ibrahim-sow-77"
    assert rows[3]["notes"] == ["input.linkedin_url_invalid"]
    assert (rows[4]["first_name"], rows[4]["company"]) == ("Søren", "Fjord Tools")
    assert rows[5]["reason"] == ("first_name: placeholder value 'unknown'; "
                                 "last_name: placeholder value 'unknown'")
    assert rows[6]["reason"] == "first_name: contains digits; last_name: contains digits"
    assert rows[7]["reason"] == "first_name: looks like an email address (columns swapped?)"


def test_encodings_and_delimiters(parsed):
    files, lines = parsed
    semicolon = files["semicolon.csv"]
    assert (semicolon["encoding"], semicolon["delimiter"]) == ("cp1252", ";")
    assert semicolon["warnings"] == [
        "encoding: not valid UTF-8 (byte 0xe9 at offset 24); decoded as Windows-1252, "
        "check accented names", "delimiter: ';' detected instead of ','"]
    assert lines["semicolon.csv"][1]["first_name"] == "José"
    assert files["utf16.csv"]["warnings"] == [
        "encoding: UTF-16 file; decoded from its BOM", "delimiter: '\\t' detected instead of ','"]
    assert files["bom.csv"]["encoding"] == "utf-8-sig"
    assert lines["bom.csv"][1]["first_name"] == "Ana"


@pytest.mark.parametrize("name,text", [
    ("cr.csv", "malformed CSV near line"),
    ("nul.csv", "input contains NUL bytes; this is not a text CSV file"),
    ("empty.csv", "input file is empty or has no header row"),
    ("headeronly.csv", "input has a header but no data rows"),
    ("missing.csv", "missing required column(s) ['last_name']; header was ['first_name', 'email']"),
    ("junk.csv", "6 of 8 rows rejected (75%), above the 50% limit; the columns probably do not "
                 "hold what the header says (first_name: placeholder value x6)"),
])
def test_turned_away(parsed, name, text):
    assert not parsed[0][name]["accepted"]
    assert parsed[0][name]["reason"].startswith(text)


def test_headers_and_ragged_rows(parsed):
    files, lines = parsed
    assert files["twice.csv"]["warnings"] == [
        "ignored_columns: Badge", "duplicate_columns: first (first occurrence kept)"]
    assert lines["twice.csv"][1]["first_name"] == "Ana"
    assert lines["ragged.csv"][1]["email"] is None
    assert lines["ragged.csv"][2]["email"] == "b@x.io"
    assert lines["quoted.csv"][1]["last_name"] == 'O"Neil, Jr'
    assert lines["quoted.csv"][1]["company"] == "multi line"


def test_consent(landed, parsed):
    rows = parsed[1]["consent.csv"]
    assert {n: r["reason"] for n, r in rows.items()} == {
        1: None, 2: "consent: withheld", 3: None, 4: None}
    assert rows[4]["notes"] == ["input.consent_unrecognised"]
    only = landed.filter(F.col("path").endswith("consent.csv"))
    strict = GuardLimits(require_consent=True)
    _, again = landing.registrants_of(only, strict)
    refused = validation.rejected_rows(validation.clean_rows(again, strict)).collect()
    assert sorted(r["row_number"] for r in refused) == [2, 3, 4]


def test_size_and_row_cap(landed):
    big = landed.filter(F.col("path").endswith("big.csv"))
    profile = landing.file_profile(big, GuardLimits(max_input_bytes=100)).collect()[0]
    assert profile["problem"] == ("input is 341 bytes, above the 100 byte limit; split the file")
    capped, rows = landing.registrants_of(big, GuardLimits(max_rows=39))
    assert capped.collect()[0]["problem"] == "input has more than 39 rows; split the file"
    assert rows.count() == 0
