"""Text normal forms against the standard library's Unicode tables."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from rosterloom.functions import guards as G
from rosterloom.functions import responses as R
from rosterloom.functions import text as X

SAMPLES = ["", " ", "José", "José", "STRASSE", "straße", "ﬁancé", "ＡＢＣ  １２", "O'Brien-Smith",
           "a b c", "Ǆungla", "İstanbul", "zero​width", "tab\there\r\n", "née/Müller",
           "Σίσυφος", "Ω", "Ⅷ", "x_y", "--", "N/A", "first_name", "李 小龙", "Ñandú", "﻿BOM\x00"]
ALPHABET = "aAéÉñßﬁΣς １Ⅷ_-'./,\t ​́İıЖж李"


def words(folded):
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s'\-]", " ", folded)).strip()


def normal(value):
    return words(unicodedata.normalize("NFKC", value).casefold())


def folded(value):
    bare = "".join(c for c in unicodedata.normalize("NFKD", value)
                   if unicodedata.category(c) != "Mn")
    return normal(bare)


def visible(value):
    return "".join(" " if c in "\t\n\r" else c for c in value
                   if c in "\t\n\r" or unicodedata.category(c) not in ("Cc", "Cf"))


@pytest.fixture(scope="module")
def values():
    rng = random.Random(7)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    # A combining mark alone is a letter to neither side, but only one of them drops it.
    return [v for v in SAMPLES + made if not re.search("(^|[^a-zA-Z])́", v)]


def test_normal_forms(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    v = F.col("v")
    rows = df.select("i", X.normalize_text(v).alias("n"), X.fold_text(v).alias("f"),
                     X.strip_invisible(v).alias("s"), X.normalize_email(v).alias("e"),
                     X.casefold(v).alias("c")).collect()
    for r in rows:
        value = values[r["i"]]
        assert r["n"] == normal(value), value
        assert r["f"] == folded(value), value
        assert r["s"] == visible(value), value
        assert r["e"] == unicodedata.normalize("NFKC", value).strip().casefold(), value
        assert r["c"] == value.casefold(), value


def test_normalizing_twice_changes_nothing(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string").select(
        X.normalize_text(F.col("v")).alias("once"))
    assert df.filter(X.normalize_text(F.col("once")) != F.col("once")).count() == 0


@pytest.mark.parametrize("given,clean", [
    ("https://www.linkedin.com/in/jane/", "linkedin.com/in/jane"),
    ("HTTP://SG.LinkedIn.com/pub/Jane?trk=1#x", "linkedin.com/pub/jane"),
    ("linkedin.com/in/jane/details/", "linkedin.com/in/jane"),
    ("linkedin.com/company/acme", None), ("linkedin.com/in/", None), ("jane", None)])
def test_linkedin(spark, given, clean):
    df = spark.createDataFrame([(given,)], "v string").select(X.normalize_url(F.col("v")).alias("u"))
    assert df.select(G.linkedin_guard(F.col("u"))[0]).first()[0] == clean


@pytest.mark.parametrize("given,good", [
    ("2020", True), ("2020-05", True), ("2020-13", False), ("2020-02-31", True), ("1899", False),
    ("2100-12-31", True), ("2101", False), ("2020-5", False), ("", False)])
def test_dates(spark, given, good):
    df = spark.createDataFrame([(given,)], "v string")
    assert df.select(G.valid_date(F.col("v"))).first()[0] is good


@pytest.mark.parametrize("text,number", [
    ("60", 60.0), (" 1.5 ", 1.5), ('{"minute": 60, "day": 7}', 7.0), ("{}", None), ("soon", None)])
def test_first_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(R.first_number(F.col("v"))).first()[0] == number


def test_hidden_values(spark):
    body = ('{"id": "p", "full_name": true, "location_name": false, "inferred_years_experience": 4,'
            ' "experience": [{"company": {"name": true, "location": {"country": "fiji"}},'
            ' "title": {"levels": ["a", null, "", "a", "b"]}, "end_date": null, "is_primary": null}]}')
    df = spark.createDataFrame([(body,), ('{"id": "q", "experience": true}',)], "b string")
    p, q = [r[0] for r in df.select(R.coerce_obscured(F.parse_json("b"))).collect()]
    assert p["full_name"] is None and p["location_name"] is None
    assert p["inferred_years_experience"] == 4
    job = p["experience"][0]
    assert job["company"]["name"] is None and job["company"]["location_country"] == "fiji"
    assert job["title"]["levels"] == ["a", "b"] and job["is_primary"] is False
    assert q["experience"] == []
