"""Recorded attempts to lookup results."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rosterloom.functions import responses as R
from rosterloom.operators import validation
from rosterloom.plans import recorded

START = datetime(2024, 3, 1, 8)
ADA = {"id": "p1", "full_name": "Ada Byron", "first_name": "ada", "last_name": "byron",
       "job_title": "analyst", "location_name": True, "inferred_years_experience": 7,
       "experience": [{"company": {"name": "acme", "location": {"country": "uk"}},
                       "title": {"name": "analyst", "levels": ["senior", True, None]},
                       "start_date": "2020", "is_primary": True}]}


def registrants(spark, rows):
    """Rows (first name, last name, e-mail) of one batch, numbered from 1."""
    return spark.createDataFrame(
        [("b1", "2024-03-01", i, first, last, email, "", "", "", "yes")
         for i, (first, last, email) in enumerate(rows, 1)],
        "batch_id string, batch_date string, row_number int, first_name string, last_name string, "
        "email string, company string, location string, linkedin_url string, consent string")


def tries(spark, *rows):
    """Attempts (row, attempt, status, headers, body, failure)."""
    return spark.createDataFrame(
        [("b1", row, n, START + timedelta(minutes=10 * row + n), status, headers,
          json.dumps(body) if isinstance(body, (dict, list)) else body, failure)
         for row, n, status, headers, body, failure in rows], recorded.ATTEMPT)


def found(data, likelihood=9):
    return {"status": 200, "likelihood": likelihood, "data": data}


def matches(*pairs):
    return {"matches": [{"match_score": s, "data": d} for s, d in pairs]}


def results(spark, people, attempts):
    valid, _ = validation.split_valid_invalid(registrants(spark, people))
    rows = recorded.recorded_results(valid, attempts).collect()
    assert len({r["row_number"] for r in rows}) == len(rows)
    return {r["row_number"]: r for r in rows}


def test_retries_headers_and_the_cache_of_a_batch(spark):
    ada = ("Ada", "Byron", "ada@example.com")
    got = results(spark, [ada, ada, ada, ("Bo", "Li", "bo@example.com")], tries(
        spark, (1, 1, 429, {"retry-after": "3"}, None, None), (1, 2, 503, None, "<html>", None),
        (1, 3, 200, {"X-Call-Credits-Spent": "4"}, found(ADA), None),
        (4, 1, 404, None, {"error": {"message": "nobody"}}, None)))
    first = got[1]
    assert (first.status, first.attempts, first.credits_consumed) == ("matched", 3, 4)
    assert first.profile.id == "p1" and first.profile.location_name is None
    assert "senior" in first.profile.experience[0].title.levels
    assert first.requested_at == START + timedelta(minutes=11)
    for row in (2, 3):
        assert (got[row].status, got[row].attempts, got[row].credits_consumed) == ("cached", 0, 0)
        assert got[row].profile == first.profile and got[row].raw_ref == first.raw_ref
    assert (got[4].status, got[4].http_status, got[4].error_message) == ("not_found", 404, None)


def test_a_failed_call_is_made_again_and_no_earlier_row_is_served(spark):
    ada = ("Ada", "Byron", "ada@example.com")
    got = results(spark, [ada] * 4, tries(
        spark, (2, 1, None, None, None, "connection reset"), (3, 1, 200, None, found(ADA), None)))
    assert set(got) == {2, 3, 4}  # row 1 has neither a call nor an answer before it
    assert (got[2].status, got[2].error_message) == ("error", "transport error: connection reset")
    assert (got[2].attempts, got[2].credits_consumed, got[2].http_status) == (1, 0, None)
    assert (got[3].status, got[3].credits_consumed, got[4].status) == ("matched", 1, "cached")


def test_attempts_end_at_the_limit(spark):
    got = results(spark, [("Ada", "Byron", "ada@example.com")], tries(
        spark, *[(1, n, 500, None, {"error": "busy"}, None) for n in range(1, 5)],
        (1, 5, 200, None, found(ADA), None)))
    assert (got[1].status, got[1].attempts, got[1].error_message) == ("error", 4, "busy")


@pytest.mark.parametrize("body, status, message", [
    (found(ADA), "matched", None),
    ({"likelihood": 3}, "error", "200 response without data"),
    ({"data": [1]}, "error", "200 response without data"),
    ("{cut", "error", "200 response without data"), (None, "error", "200 response without data"),
    (found({**ADA, "id": 5}), "error",
     "unparseable profile: id: Input should be a valid string"),
    (found({"full_name": {"x": 1}, "experience": "none"}), "error",
     "unparseable profile: id: Field required; full_name: Input should be a valid string; "
     "experience: Input should be a valid list")])
def test_bodies_of_strong_lookups(spark, body, status, message):
    got = results(spark, [("Ada", "Byron", "ada@example.com")],
                  tries(spark, (1, 1, 200, None, body, None)))
    assert (got[1].status, got[1].error_message) == (status, message)
    assert got[1].credits_consumed == 1


@pytest.mark.parametrize("body, status, person, likelihood, candidates", [
    (matches((90, ADA), (60, {"id": "p2"})), "matched", "p1", 90.0, 2),
    (matches((60, {"id": "p2"}), (90, ADA)), "matched", "p1", 90.0, 2),
    (matches((90, ADA), (71, {"id": "p2"})), "ambiguous", None, 90.0, 2),
    (matches((80, ADA), (80, {"id": "p2"})), "ambiguous", None, 80.0, 2),
    (matches((69, ADA)), "ambiguous", None, 69.0, 1),
    (matches((None, ADA)), "ambiguous", None, 0.0, 1),
    (matches((95, None)), "error", None, None, None),
    (matches(), "not_found", None, None, 0), (None, "not_found", None, None, 0)])
def test_bodies_of_name_searches(spark, body, status, person, likelihood, candidates):
    got = results(spark, [("Ada", "Byron", "")], tries(spark, (1, 1, 200, None, body, None)))[1]
    assert (got.status, got.likelihood, got.candidates) == (status, likelihood, candidates)
    assert (got.profile.id if got.profile else None) == person


def test_years_that_are_not_whole(spark):
    rows = [(7,), ("7",), (True,), (None,), (7.0,), (7.5,), ("x",), ([1],)]
    df = spark.createDataFrame([(json.dumps({**ADA, "inferred_years_experience": v}),)
                                for (v,) in rows], "body string")
    bad = [r[0] is not None for r in df.select(
        R.profile_problem(F.parse_json("body"))).collect()]
    assert bad == [False] * 5 + [True] * 3


def test_no_rows_and_tables_of_a_batch(spark):
    people = [("Ada", "Byron", "ada@example.com"), ("test", "x", ""), ("Bo", "Li", "bo@example.com")]
    attempts = tries(spark, (1, 1, 200, None, found(ADA), None))
    tables = recorded.run_recorded(registrants(spark, people), attempts,
                                   F.lit("2030-01-01").cast("timestamp"))
    assert [r.person_id for r in tables["dim_person"].collect()] == ["p1"]
    assert {(r.row_number, r.status) for r in tables["fact_lookup"].collect()} == {
        (1, "matched"), (2, "invalid_input")}
    valid, _ = validation.split_valid_invalid(registrants(spark, people))
    assert recorded.recorded_results(valid, attempts.limit(0)).count() == 0
