"""Analyst questions over the curated tables.

Each takes the tables (with their ``batch_date`` partition column) and returns a DataFrame;
``since`` and ``on`` restrict partitions, so the filter reaches the file listing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.functions.responses import header

CURRENT_COLUMNS = ["person_id", "full_name", "current_job_title", "current_company_name",
                   "current_company_industry", "location_country", "linkedin_url",
                   "match_likelihood", "lookup_method", "quality_flags", "enriched_at",
                   "batch_date", "batch_id"]


def _dated(df: DataFrame, since: str | None, on: str | None) -> DataFrame:
    if since is not None:
        df = df.filter(F.col("batch_date") >= since)
    return df if on is None else df.filter(F.col("batch_date") == on)


def who(persons: DataFrame, since: str | None = None) -> DataFrame:
    return (_dated(persons, since, None)
            .select("batch_date", "full_name", "current_job_title", "current_company_name",
                    "location_country", "linkedin_url", "match_likelihood", "lookup_method",
                    "quality_flags", "enriched_at")
            .orderBy(F.desc("batch_date"), "full_name"))


def _positions(persons: DataFrame, employment: DataFrame, on: str | None) -> DataFrame:
    names = _dated(persons, None, on).select("person_id", "batch_id", "batch_date", "full_name")
    return _dated(employment, None, on).join(names, ["person_id", "batch_id", "batch_date"])


def companies(persons: DataFrame, employment: DataFrame, on: str | None = None) -> DataFrame:
    return (_positions(persons, employment, on)
            .orderBy(F.desc("batch_date"), "full_name", "sequence_no")
            .select("batch_date", "full_name", "company_name", "company_industry", "start_date",
                    "end_date", "is_current"))


def roles(persons: DataFrame, employment: DataFrame, on: str | None = None) -> DataFrame:
    return (_positions(persons, employment, on)
            .orderBy(F.desc("batch_date"), "full_name", "sequence_no")
            .select("batch_date", "full_name", "title_name", "title_role", "title_levels",
                    "company_name", "start_date", "end_date"))


def outcomes(lookup: DataFrame, on: str | None = None) -> DataFrame:
    return (_dated(lookup, None, on)
            .groupBy("batch_date", "batch_id", "status", "lookup_method")
            .agg(F.count("*").alias("rows"), F.sum("credits_consumed").alias("credits"),
                 F.round(F.avg("likelihood"), 1).alias("avg_likelihood"))
            .orderBy(F.desc("batch_date"), "batch_id", "status", "lookup_method"))


def _newest(persons: DataFrame, *order: Column) -> DataFrame:
    # The window keeps one row per person before it shuffles, however often one was seen.
    recency = Window.partitionBy("person_id").orderBy(*order)
    return (persons.withColumn("recency", F.row_number().over(recency))
            .filter("recency = 1").drop("recency"))


def latest_snapshot(persons: DataFrame) -> DataFrame:
    return (_newest(persons, F.desc("enriched_at"), F.desc("batch_id"))
            .select("full_name", "current_job_title", "current_company_name", "location_country",
                    "linkedin_url", "match_likelihood", "quality_flags", "batch_date", "batch_id")
            .orderBy("full_name"))


def person_current(persons: DataFrame) -> DataFrame:
    """Current state per person; also the ``person_current`` view."""
    return _newest(persons, F.desc("enriched_at"), F.desc("batch_id")).select(*CURRENT_COLUMNS)


def create_person_current(persons: DataFrame, name: str = "person_current") -> None:
    person_current(persons).createOrReplaceTempView(name)


def quality_trend(quality: DataFrame) -> DataFrame:
    return (quality.select(
        "batch_date", "batch_id", "pipeline_version", "rows_valid", "rows_invalid", "matched",
        "cached", "not_found", "ambiguous", "budget_deferred", "provider_unavailable", "error",
        F.round("match_rate", 2).alias("match_rate"), "flagged_matches", "warning_count",
        "warnings", "credits_spent", "persons")
        .orderBy(F.desc("batch_date"), F.desc("batch_id")))


def top_companies(employment: DataFrame, on: str | None = None, limit: int = 20) -> DataFrame:
    return (_dated(employment, None, on).groupBy("company_name")
            .agg(F.countDistinct("person_id").alias("people"))
            .orderBy(F.desc("people"), "company_name").limit(limit))


def row_outcomes(lookup: DataFrame) -> DataFrame:
    return (lookup.select(
        "batch_id", "row_number", "input_first_name", "input_last_name", "status",
        "lookup_method", "likelihood", "candidates", "http_status", "credits_consumed",
        "attempts").orderBy("batch_id", "row_number"))


def batch_report(lookup: DataFrame) -> DataFrame:
    """One display row per input row: who, outcome, score, cost, note."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    name = F.trim(F.concat_ws(" ", text("input_first_name"), text("input_last_name")))
    at_company = F.when(text("input_company") != "",
                        F.concat(name, F.lit(" @ "), "input_company")).otherwise(name)
    score = F.regexp_replace(text("likelihood"), r"\.0\z", "")
    note = (F.when(F.col("status") == "ambiguous",
                   F.concat(F.col("candidates").cast("string"), F.lit(" candidates")))
            .when(F.col("status").isin("error", "invalid_input", "budget_deferred"),
                  F.left(text("error_message"), F.lit(60))).otherwise(""))
    return lookup.select(
        "batch_id", "row_number", F.left(at_company, F.lit(24)).alias("name"),
        F.left("status", F.lit(16)).alias("status"),
        F.left(F.coalesce("lookup_method", F.lit("-")), F.lit(13)).alias("method"),
        score.alias("score"),
        text("http_status").alias("http"), F.col("credits_consumed").alias("credits"),
        "attempts", note.alias("note")).orderBy("batch_id", "row_number")


def calls_by_credit_type(raw: DataFrame, by: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """Recorded calls, and the fewest credits the provider said remain, per credit type.

    ``raw``: kind and ``headers`` of every stored response.
    """
    told = header(F.col("headers"), "x-call-credits-type")
    left = header(F.col("headers"), "x-totallimit-remaining")
    kind = F.coalesce(F.when(told != "", told), F.when(F.col("kind") != "", F.col("kind")),
                      F.lit("unknown"))
    return (raw.withColumn("credit_type", kind)
            .withColumn("remaining", F.when(left.rlike(r"\A\d+\z"), left.try_cast("bigint")))
            .groupBy(*by, "credit_type")
            .agg(F.count("*").alias("calls"), F.min("remaining").alias("remaining")))


def reconcile_counts(lookup: DataFrame, quality: DataFrame, persons: DataFrame) -> DataFrame:
    """Per batch: do the lookup rows equal the valid and invalid input rows?  And overall:
    does the current-person view hold each distinct person once?"""
    rows = lookup.groupBy("batch_id").agg(F.count("*").alias("actual"))
    batches = quality.join(rows, "batch_id", "left").select(
        F.concat(F.lit("batch "), "batch_id").alias("subject"),
        (F.col("rows_valid") + F.col("rows_invalid")).cast("bigint").alias("expected"),
        F.coalesce("actual", F.lit(0)).alias("actual"))
    none = F.lit(0).cast("bigint")
    people = persons.agg(F.countDistinct("person_id").alias("expected"), none.alias("actual"))
    shown = person_current(persons).agg(none.alias("expected"), F.count("*").alias("actual"))
    view = people.unionByName(shown).select(F.lit("person_current").alias("subject"), "*").groupBy(
        "subject").agg(F.sum("expected").alias("expected"), F.sum("actual").alias("actual"))
    return batches.unionByName(view).withColumn("agrees", F.col("expected") == F.col("actual"))


def idempotency_check(first: DataFrame, second: DataFrame, lookup_second: DataFrame) -> DataFrame:
    """The second run of the same files: nothing spent, same people, only cached answers.

    ``first`` and ``second`` are quality rows with the ``source`` both runs share.
    """
    a = first.select("source", F.col("credits_spent").alias("first_credits"),
                     F.col("persons").alias("first_persons"))
    b = second.select("source", "batch_id", F.col("credits_spent").alias("second_credits"),
                      F.col("persons").alias("second_persons"))
    other = lookup_second.groupBy("batch_id").agg(
        F.count_if(~F.col("status").isin("cached", "invalid_input")).alias("not_cached"))
    return a.join(b, "source").join(other, "batch_id", "left").select(
        "source", "first_credits", "second_credits", "first_persons", "second_persons",
        "not_cached",
        ((F.col("second_credits") == 0) & (F.col("first_persons") == F.col("second_persons"))
         & (F.col("not_cached") == 0)).alias("passed"))
