"""Golden outcomes of the sample list, curated tables, checks, publishing and erasure."""

import pytest
from pyspark.sql import functions as F

from rosterloom.config import GuardLimits, LadderConfig
from rosterloom.operators import curate, erasure, matching, validation
from rosterloom.plans import analytics, pipeline
from rosterloom.plans.workspace import Workspace
from rosterloom.sources import store
from rosterloom.tables import CURATED, PROFILE, SchemaMismatch, conform_schema

NAMES = [("John", "Doe", "", ""), ("Jane", "Smith", "", ""), ("Alex", "Lee", "", ""),
         (" José ", "García", "Acme Corp", "Singapore"), ("Alex", "Lee", "", ""), ("", "Nguyen", "", "")]


def job(company, start, end, primary):
    return {"company": {"name": company, "location_country": "singapore"},
            "title": {"name": "engineer", "levels": ["senior", "senior"]},
            "start_date": start, "end_date": end, "is_primary": primary}


def person(pid, first, last, jobs):
    return {"id": pid, "full_name": f"{first} {last}", "first_name": first, "last_name": last,
            "job_title": "engineer" if jobs else None, "experience": jobs}


PEOPLE = [
    person("p1", "john", "doe", [job("fabrikam retail", "2016-05", "2018-12", False),
                                 job("northwind analytics", "2022-03", None, True),
                                 job("contoso logistics", "2019-01", "2022-02", False)]),
    person("p2", "jane", "smith", [job("globex corporation", "2020-01", None, True),
                                   job("initech", "2015", "2019-12", False)]),
    person("p2b", "jane", "smith", []), person("p3a", "alex", "lee", []),
    person("p3b", "alex", "lee", []), person("p3c", "alex", "lee", []),
]
SCORES = {"p1": 88.0, "p2": 90.0, "p2b": 45.0, "p3a": 62.0, "p3b": 58.0, "p3c": 40.0}


@pytest.fixture(scope="module")
def tables(spark):
    profiles = spark.createDataFrame([(p["id"], SCORES[p["id"]], p) for p in PEOPLE],
                                     f"person_id string, match_score double, "
                                     f"profile {PROFILE.simpleString()}")
    none = F.lit(None).cast("string")
    people = profiles.select(
        "person_id", none.alias("email"), none.alias("linkedin_url"),
        F.col("profile.first_name").alias("first_name"), F.col("profile.last_name").alias("last_name"),
        none.alias("company_name"), none.alias("location"), F.lit(8.0).alias("likelihood"),
        "match_score", "profile")
    rows = spark.createDataFrame(
        [("b1", "2024-01-01", i, *r[:2], "", *r[2:], "", "") for i, r in enumerate(NAMES, 1)],
        "batch_id string, batch_date string, row_number int, first_name string, last_name string, "
        "email string, company string, location string, linkedin_url string, consent string")
    built = pipeline.run_batches(rows, people, matching.name_candidates(people),
                                 F.lit("2024-01-01").cast("timestamp"))
    return {n: df.persist() for n, df in built.items()} | {"rows": rows, "people": people}


def test_outcomes_row_by_row(tables):
    rows = tables["fact_lookup"].orderBy("row_number").collect()
    assert [r["status"] for r in rows] == [
        "matched", "matched", "ambiguous", "not_found", "cached", "invalid_input"]
    assert [r["credits_consumed"] for r in rows] == [1, 1, 1, 0, 0, 0]
    assert rows[2]["candidates"] == 3 and rows[2]["likelihood"] == 62.0
    assert rows[5]["error_message"] == "first_name: String should have at least 1 character"
    assert rows[5]["quality_flags"] == ["input.rejected"]


def test_quality_report(tables):
    q = tables["fact_batch_quality"].collect()[0]
    assert (q["rows_valid"], q["rows_invalid"], q["matched"], q["cached"]) == (5, 1, 2, 1)
    assert (q["credits_spent"], q["persons"], q["employment_rows"]) == (3, 2, 5)
    assert q["match_rate"] == pytest.approx(0.6)
    assert q["warnings"] == []


def test_questions(tables):
    got = analytics.companies(tables["dim_person"], tables["fact_employment"]).collect()
    assert [r["company_name"] for r in got if r["full_name"] == "john doe"] == [
        "northwind analytics", "contoso logistics", "fabrikam retail"]
    assert [r["company_name"] for r in got if r["full_name"] == "jane smith"][0] == "globex corporation"
    levels = analytics.roles(tables["dim_person"], tables["fact_employment"]).collect()[0]["title_levels"]
    assert levels == ["senior"]


def violations(tables, expected=6, **changed):
    some = {**tables, **changed}
    rows = some["fact_lookup"].sparkSession.createDataFrame([("b1", expected)],
                                                            "batch_id string, rows long")
    return {r["rule"] for r in curate.check_tables(some, rows).collect()}


def test_checks_find_each_mutation(tables):
    lookup, persons = tables["fact_lookup"], tables["dim_person"]
    assert violations(tables) == set()
    assert violations(tables, expected=7) == {"row_count"}
    assert violations(tables, fact_lookup=lookup.withColumn("row_number", F.lit(1))) == {"row_number"}
    assert violations(tables, fact_lookup=lookup.withColumn("row_number", F.when(
        F.col("row_number") > 1, F.col("row_number")))) == {"row_number"}
    nobody = persons.withColumn("person_id", F.when(F.col("person_id") == "p1", "p1"))
    assert "person_id" in violations(tables, dim_person=nobody)
    assert "person_unique" in violations(tables, dim_person=persons.union(persons))
    assert violations(tables, dim_person=persons.filter("person_id = 'p1'")) == {"orphan_employment"}
    unmatched = lookup.withColumn("status", F.lit("error"))
    assert violations(tables, fact_lookup=unmatched) == {"too_many_persons"}
    with pytest.raises(curate.OutputCheckError):
        wrong = tables["rows"].sparkSession.createDataFrame([("b1", 9)], "batch_id string, rows long")
        curate.require_consistent(curate.check_tables(tables, wrong))


def test_publish_replaces_batches(spark, tables, folder):
    curated = {n: tables[n] for n in CURATED}
    for _ in range(2):  # publishing again replaces, never adds
        store.write_curated(curated, folder)
    assert store.read_curated(spark, folder, "fact_lookup").count() == 6
    assert store.read_curated(spark, folder, "dim_person").columns == [
        *CURATED["dim_person"].fieldNames(), "batch_date"]
    counts = {n: df.groupBy("batch_id").agg(F.count("*").alias("rows")) for n, df in curated.items()}
    assert store.verify_written(spark, folder, counts).count() == 0
    store.write_curated({n: df.limit(0) for n, df in curated.items()}, folder + "/empty")
    assert store.read_curated(spark, folder + "/empty", "dim_person").count() == 0
    store.catalog_tables(spark, folder)
    assert spark.sql("SELECT count(*) FROM dim_person").first()[0] == 2


def test_emptied_batches_lose_their_rows(spark, tables, folder):
    curated = {n: tables[n] for n in CURATED}
    other = {n: df.withColumn("batch_id", F.lit("b2")) for n, df in curated.items()}
    store.write_curated(curated, folder)
    store.write_curated(other, folder)  # of the same day: the first batch stays
    assert store.read_curated(spark, folder, "dim_person").groupBy("batch_id").count().count() == 2
    built = spark.createDataFrame([("2024-01-01", "b1")], "batch_date string, batch_id string")
    store.write_curated({"dim_person": curated["dim_person"].limit(0)}, folder, built)
    left = store.read_curated(spark, folder, "dim_person")
    assert {r["batch_id"] for r in left.collect()} == {"b2"}
    last = spark.createDataFrame([("2024-01-01", "b2")], "batch_date string, batch_id string")
    store.write_curated({"dim_person": curated["dim_person"].limit(0)}, folder, last)
    assert store.read_curated(spark, folder, "dim_person").count() == 0


def test_database_tables(spark, tables, folder):
    store.write_curated({n: tables[n] for n in CURATED}, folder)
    names = store.catalog_tables(spark, folder, "rosterloom_test")
    assert names == [f"rosterloom_test.{n}" for n in CURATED]
    assert spark.sql("SELECT count(*) FROM rosterloom_test.dim_person "
                     "WHERE batch_date = '2024-01-01'").first()[0] == 2
    spark.sql("DROP DATABASE rosterloom_test CASCADE")


def test_erasing_the_only_person_of_a_batch(spark, tables, folder):
    rows = tables["rows"].filter("row_number IN (1, 2)").withColumn(
        "batch_id", F.concat(F.lit("b"), "row_number"))
    valid, rejected = validation.split_valid_invalid(rows)
    results = pipeline.lookup_results(valid, tables["people"], matching.name_candidates(
        tables["people"]))
    at = F.lit("2024-01-02").cast("timestamp")
    store.write_lookup_results(results, f"{folder}/results")
    store.rejected_rows_export(rejected, f"{folder}/rejected")
    stored = store.lookup_results(spark, f"{folder}/results")
    store.write_raw_responses(stored.select("provider", "batch_date", "batch_id", "lookup_key"),
                              f"{folder}/raw")
    empty = spark.createDataFrame([], "lookup_key string, status string, person_id string, "
                                  "likelihood double, batch_id string, updated_at timestamp, "
                                  "expires_at timestamp")
    matching.cache_upsert(stored.withColumn("person_id", F.col("profile.id")), empty,
                          at).write.parquet(f"{folder}/cache")
    pipeline.publish(stored, rejected, f"{folder}/curated", at, "recorded")
    store.manifest(store.read_curated(spark, f"{folder}/curated", "fact_batch_quality"),
                   f"{folder}/manifest")
    assert store.read_manifests(spark, f"{folder}/manifest").count() == 2
    asked = spark.createDataFrame([("r", None, None, "JOHN", "Doe")], "request_id string, "
                                  "person_id string, email string, first_name string, "
                                  "last_name string")
    matches = erasure.subject_match(asked, valid, rejected, stored).persist()
    items = erasure.erasure_items(matches, stored, spark.createDataFrame(
        [], "batch_id string, source string")).persist()
    items.count()
    pipeline.erase(folder, matches, items, rejected, at, "recorded")
    for table in CURATED:
        left = {r["batch_id"] for r in store.read_curated(spark, f"{folder}/curated", table)
                .collect()}
        assert left == {"b2"}, table
    assert {r["batch_id"] for r in store.lookup_results(spark, f"{folder}/results").collect()} == {
        "b2"}
    assert {r["batch_id"] for r in store.raw_responses(spark, f"{folder}/raw").collect()} == {"b2"}
    assert [r["batch_id"] for r in store.read_manifests(spark, f"{folder}/manifest").collect()] == [
        "b2"]
    assert spark.read.parquet(f"{folder}/cache").count() == 1
    assert spark.read.parquet(f"{folder}/cache_gone").count() == 1


def test_blank_companies_match_nobody(spark, tables):
    people = tables["people"].limit(1).withColumns({
        "first_name": F.lit("Ana"), "last_name": F.lit("Lee"), "company_name": F.lit(None).cast("string")})
    plan = spark.createDataFrame(
        [("b", 1, "name_context", "enrich", "Ana", "Lee", "", "!!!", None, "")],
        "batch_id string, row_number int, lookup_method string, call_kind string, "
        "first_name string, last_name string, email string, company string, location string, "
        "linkedin_url string")
    got = matching.match_strong(plan, people).collect()
    assert [(r["http_status"], r["person_id"]) for r in got] == [(404, None)]


def test_attempts_beyond_the_limit_and_in_the_thousands(spark):
    rows = [("a", n, 500, None) for n in range(1, 9)] + [("b", n, 503, None) for n in (1, 2)] + [
        ("c", n, 429 if n < 7000 else 200, 1.0) for n in (1, 6000, 7000)]
    calls = spark.createDataFrame(rows, "lookup_key string, attempt int, http_status int, wait double")
    got = {r["lookup_key"]: r["attempts"] for r in matching.resolve_attempts(calls).collect()}
    assert got["a"] == 4 and got["b"] == 2
    wide = matching.resolve_attempts(calls, LadderConfig(max_attempts=10_000))
    assert {r["lookup_key"]: r["attempts"] for r in wide.collect()} == {"a": 8, "b": 2, "c": 7000}


def test_stages_depend_on_settings(spark):
    folder = "/root/testdata/sf0.001"
    strict = pipeline.Settings(guards=GuardLimits(require_consent=True))
    loose = Workspace(spark, folder).rejected().count()
    assert Workspace(spark, folder, strict).rejected().count() > loose


def test_a_claim_runs_out(spark):
    triggers = spark.createDataFrame(
        [("b1", "2024-06-01 00:00:00", "new"), ("b2", "2024-02-01 00:00:00", "new")],
        "batch_id string, triggered_at string, execution_id string")
    claims = spark.createDataFrame(
        [("b1", "old", "2024-01-01 00:00:00"), ("b2", "old", "2024-01-01 00:00:00")],
        "batch_id string, execution_id string, claimed_at string")
    got = {r["batch_id"]: r["duplicate"] for r in validation.batch_claim(triggers, claims).collect()}
    assert got == {"b1": False, "b2": True}


def test_conform_refuses_unknown_columns(tables):
    with pytest.raises(SchemaMismatch):
        conform_schema(tables["dim_person"].withColumn("surprise", F.lit(1)), "dim_person",
                       ("batch_date",))


def test_gate_boundaries(spark):
    scores = {"a": [70.0, 50.0], "b": [69.0], "c": [90.0, 71.0], "d": [70.0], "e": [99.0, 79.0, 10.0]}
    rows = [(n, f"{n}{i}", s) for n, all_ in scores.items() for i, s in enumerate(all_)]
    got = {r["name_key"]: (r["gate"], r["candidates"]) for r in matching.gate_candidates(
        spark.createDataFrame(rows, "name_key string, person_id string, match_score double")).collect()}
    assert got == {"a": ("matched", 2), "b": ("ambiguous", 1), "c": ("ambiguous", 2),
                   "d": ("matched", 1), "e": ("matched", 3)}


def test_erasure_needs_a_subject(spark):
    asked = spark.createDataFrame(
        [("1", None, None, "Ana", None), ("2", "p1", None, None, None), ("3", None, None, "A", "B")],
        "request_id string, person_id string, email string, first_name string, last_name string")
    assert [r["request_id"] for r in erasure.usable_requests(asked).collect()] == ["2", "3"]
    first, last = erasure.name_subject(F.lit("Mary Teresa  Doe"))
    assert spark.range(1).select(first, last).first()[:] == ("Mary Teresa", "Doe")


def test_claims_can_be_released(spark):
    claims = spark.createDataFrame([("b1", "x"), ("b2", "y")], "batch_id string, execution_id string")
    crashed = claims.filter("execution_id = 'x'")
    assert [r["batch_id"] for r in validation.release_claims(claims, crashed).collect()] == ["b2"]
