"""From lookup results to the four curated tables, their quality report and their checks.

All batches are built by one plan.  ``results`` is one row per valid input row:
batch_id, batch_date, row_number, first_name, last_name, email, company, notes, lookup_key,
status, provider, lookup_method, profile, likelihood, candidates, http_status,
error_message, credits_consumed, attempts, raw_ref, match_flags, requested_at.
``rejected`` is batch_id, batch_date, row_number, raw, reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom import __version__
from rosterloom import vocabulary as V
from rosterloom.config import GuardLimits, LadderConfig
from rosterloom.functions import guards as G
from rosterloom.operators.matching import plan_lookup
from rosterloom.operators.validation import percent
from rosterloom.tables import CURATED, PROFILE, conform_schema, stamp_version

LIMITS = GuardLimits()
KEEP = ("batch_date",)


class OutputCheckError(RuntimeError):
    """The curated tables contradict each other or the input; nothing may be published."""


def quality_flags(notes: Column, flags: Column) -> Column:
    """Input notes, then doubts about the match, each once."""
    return F.array_distinct(F.concat(notes, flags))


def unrecorded_rows(valid: DataFrame, results: DataFrame, row_errors: DataFrame, at: Column,
                    provider: str, cfg: LadderConfig | None = None) -> DataFrame:
    """``error`` results for valid rows that left none, with the cause when one is known.

    ``row_errors``: batch_id, row_number, error, cause.
    """
    lost = valid.join(results.select("batch_id", "row_number"), ["batch_id", "row_number"],
                      "left_anti")
    causes = row_errors.groupBy("batch_id", "row_number").agg(
        F.max(F.struct(F.lit(True).alias("known"), "error", "cause")).alias("why"))
    told = F.regexp_replace(F.concat(
        F.coalesce(G.blank_to_null(F.col("why.error")), F.lit("error")), F.lit(": "),
        F.coalesce("why.cause", F.lit(""))), r"\A[: ]+|[: ]+\z", "")
    planned = plan_lookup(lost, cfg or LadderConfig()).join(
        causes, ["batch_id", "row_number"], "left")
    none = F.lit(None)
    return planned.select(
        "batch_id", "batch_date", "row_number", "first_name", "last_name", "email", "company",
        "notes", "lookup_key", F.lit("error").alias("status"), F.lit(provider).alias("provider"),
        "lookup_method", none.cast(PROFILE).alias("profile"),
        none.cast("double").alias("likelihood"), none.cast("int").alias("candidates"),
        none.cast("int").alias("http_status"),
        F.left(F.when(F.col("why.known"), told).otherwise(V.UNRECORDED_MESSAGE),
               F.lit(V.MAX_ERROR_MESSAGE)).alias("error_message"),
        F.lit(0).alias("credits_consumed"), F.lit(0).alias("attempts"),
        none.cast("string").alias("raw_ref"),
        F.array().cast("array<string>").alias("match_flags"), at.alias("requested_at"),
        F.lit(True).alias("unrecorded"))


def first_per_person(results: DataFrame) -> DataFrame:
    """The first input row of every distinct person of a batch, with its profile.

    ``row_number() = 1`` is cut down to one row per person before the shuffle, so a person
    registered over and over does not pile up in one task.
    """
    found = results.filter(F.col("status").isin(V.MATCHED_STATUSES)
                           & F.col("profile.id").isNotNull())
    order = Window.partitionBy("batch_id", F.col("person_id")).orderBy("row_number")
    return (found.withColumn("person_id", F.col("profile.id"))
            .withColumn("nth", F.row_number().over(order)).filter("nth = 1").drop("nth"))


def dim_person(persons: DataFrame, version: str = __version__) -> DataFrame:
    p = F.col("profile")
    rows = persons.select(
        "person_id", "provider", "batch_id", F.col("row_number").alias("input_row_number"),
        F.col("first_name").alias("input_first_name"),
        F.col("last_name").alias("input_last_name"), F.col("email").alias("input_email"),
        p["full_name"].alias("full_name"), p["first_name"].alias("first_name"),
        p["last_name"].alias("last_name"), p["linkedin_url"].alias("linkedin_url"),
        p["location_country"].alias("location_country"),
        p["location_name"].alias("location_name"), p["job_title"].alias("current_job_title"),
        p["job_title_role"].alias("current_job_title_role"),
        p["job_company_name"].alias("current_company_name"),
        p["job_company_industry"].alias("current_company_industry"),
        p["inferred_years_experience"].alias("inferred_years_experience"),
        F.col("likelihood").alias("match_likelihood"), "lookup_method",
        quality_flags(F.col("notes"), F.col("match_flags")).alias("quality_flags"),
        F.col("requested_at").alias("enriched_at"), "batch_date")
    return conform_schema(stamp_version(rows, version), "dim_person", KEEP)


def fact_employment(persons: DataFrame, version: str = __version__) -> DataFrame:
    """Positions of each first row, numbered from the most recent one."""
    ordered = persons.select(
        "person_id", "batch_id", "batch_date",
        F.posexplode(G.order_experience(F.col("profile.experience"))).alias("sequence_no", "e"))
    company, title = F.col("e.company"), F.col("e.title")
    rows = ordered.select(
        "person_id", "batch_id", "sequence_no",
        *[company[n].alias(f"company_{n}") for n in (
            "name", "id", "website", "linkedin_url", "industry", "size", "location_country")],
        *[title[n].alias(f"title_{n}") for n in ("name", "role", "sub_role")],
        G.title_levels(title["levels"]).alias("title_levels"),
        F.col("e.start_date").alias("start_date"), F.col("e.end_date").alias("end_date"),
        G.start_year(F.col("e.start_date")).alias("start_year"),
        G.is_current(F.col("e")).alias("is_current"), "batch_date")
    return conform_schema(stamp_version(rows, version), "fact_employment", KEEP)


def fact_lookup(results: DataFrame, rejected: DataFrame, at: Column, provider: str,
                version: str = __version__) -> DataFrame:
    """Every input row, valid or not, exactly once."""
    looked_up = results.select(
        "batch_id", "row_number", F.col("first_name").alias("input_first_name"),
        F.col("last_name").alias("input_last_name"), F.col("email").alias("input_email"),
        F.col("company").alias("input_company"), "lookup_key", "status", "lookup_method",
        F.col("profile.id").alias("person_id"), "likelihood", "candidates", "http_status",
        "error_message", "credits_consumed", "attempts", "provider", "raw_ref",
        quality_flags(F.col("notes"), F.col("match_flags")).alias("quality_flags"),
        "requested_at", "batch_date")
    raw = F.col("raw")
    turned_away = rejected.select(
        "batch_id", "row_number",
        *[G.blank_to_null(raw[n]).alias(f"input_{n}")
          for n in ("first_name", "last_name", "email", "company")],
        F.lit("invalid_input").alias("status"), F.col("reason").alias("error_message"),
        F.lit(0).alias("credits_consumed"), F.lit(0).alias("attempts"),
        F.lit(provider).alias("provider"),
        F.array(F.lit("input.rejected")).alias("quality_flags"),
        at.alias("requested_at"), "batch_date")
    rows = looked_up.unionByName(turned_away, allowMissingColumns=True)
    return conform_schema(stamp_version(rows, version), "fact_lookup", KEEP)


# ------------------------------------------------------------------ quality


def status_counts(lookup: DataFrame) -> DataFrame:
    """Rows per batch and status, one column per status."""
    return lookup.groupBy("batch_id").agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in V.STATUSES])


def flag_counts(lookup: DataFrame) -> DataFrame:
    """Every note and flag of valid rows: how often, and where it first appears."""
    flags = (lookup.filter(F.col("status") != "invalid_input")
             .select("batch_id", "row_number", F.posexplode("quality_flags").alias("i", "flag")))
    return flags.groupBy("batch_id", "flag").agg(
        F.count("*").alias("n"), F.min(F.struct("row_number", "i")).alias("first_seen"))


def batch_quality(lookup: DataFrame) -> DataFrame:
    """Counts, match rate and flags per batch, from ``fact_lookup`` rows."""
    valid = F.col("status") != "invalid_input"
    matched = F.col("status").isin(V.MATCHED_STATUSES)
    doubtful = F.exists("quality_flags", lambda f: f.startswith("match."))
    counts = lookup.groupBy("batch_id").agg(
        F.count_if(valid).alias("rows_valid"), F.count_if(~valid).alias("rows_invalid"),
        F.count_if(matched).alias("rows_matched"),
        F.count_if(matched & doubtful).alias("flagged_matches"),
        F.count_if(F.col("status") == "provider_unavailable").alias("rows_unavailable"))
    # One entry per distinct flag of a fixed vocabulary: the map stays tiny.
    flags = flag_counts(lookup).groupBy("batch_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("flag", "n")))).alias("flag_counts"))
    doubts = (flag_counts(lookup).filter(F.col("flag").startswith("match."))
              .withColumn("rank", F.row_number().over(
                  Window.partitionBy("batch_id").orderBy(F.desc("n"), "first_seen")))
              .filter("rank <= 3")
              .groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct(
                  "rank", F.concat("flag", F.lit(" x"), F.col("n").cast("string")).alias("t"))))
                  .alias("d"))
              .select("batch_id", F.array_join(F.transform("d", lambda s: s["t"]), ", ")
                      .alias("top_doubts")))
    rate = F.when(F.col("rows_valid") > 0, F.col("rows_matched") / F.col("rows_valid"))
    return (counts.join(flags, "batch_id", "left").join(doubts, "batch_id", "left")
            .withColumn("match_rate", rate)
            .withColumn("flag_counts", F.coalesce(
                "flag_counts", F.create_map().cast("map<string,bigint>"))))


def batch_warnings(quality: DataFrame, parse_warnings: DataFrame | None = None,
                   unrecorded: DataFrame | None = None, limits: GuardLimits = LIMITS) -> DataFrame:
    """The advisory findings of each batch behind its parse warnings.

    ``parse_warnings``: batch_id, parse_warnings (list).  ``unrecorded``: batch_id,
    rows_unrecorded.
    """
    df = quality
    df = (df.join(parse_warnings, "batch_id", "left") if parse_warnings is not None
          else df.withColumn("parse_warnings", F.lit(None).cast("array<string>")))
    df = (df.join(unrecorded, "batch_id", "left") if unrecorded is not None
          else df.withColumn("rows_unrecorded", F.lit(0)))
    df = df.fillna(0, ["rows_unrecorded"])
    total = F.col("rows_valid") + F.col("rows_invalid")
    refused = F.col("rows_invalid") / total

    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    low = ((F.col("rows_valid") >= limits.min_rows_for_match_rate)
           & (F.col("match_rate") < limits.min_match_rate))
    found = F.array(
        F.when(low, text(
            "low_match_rate: ", F.col("rows_matched"), " of ", F.col("rows_valid"),
            " valid rows matched (", percent(F.col("match_rate")),
            f"), below {limits.min_match_rate:.0%}; check the input columns and the provider's "
            "credit state")),
        F.when((total > 0) & (refused >= limits.warn_invalid_fraction), text(
            "high_invalid_rate: ", F.col("rows_invalid"), " of ", total, " rows rejected (",
            percent(refused), "); see fact_lookup rows with status invalid_input")),
        F.when(F.col("flagged_matches") > 0, text(
            "flagged_matches: ", F.col("flagged_matches"),
            " matched rows carry quality flags (", F.col("top_doubts"), ")")),
        F.when(F.col("rows_unrecorded") > 0, text(
            "unrecorded_rows: ", F.col("rows_unrecorded"),
            " rows produced no result and were recorded as errors")),
        F.when(F.col("rows_unavailable") > 0, text(
            "provider_unavailable: ", F.col("rows_unavailable"),
            " rows were skipped while the provider circuit breaker was open; re-upload or "
            "redrive the file once the provider recovers")))
    parsed = F.coalesce("parse_warnings", F.array().cast("array<string>"))
    return (df.withColumn("warnings", F.concat(parsed, F.array_compact(found)))
            .withColumn("warning_count", F.size("warnings"))
            .drop("parse_warnings"))


def fact_batch_quality(lookup: DataFrame, persons: DataFrame, employment: DataFrame, at: Column,
                       provider: str, warned: DataFrame, version: str = __version__) -> DataFrame:
    """The quality report as one row per batch build."""
    dates = lookup.groupBy("batch_id").agg(
        F.first("batch_date").alias("batch_date"),
        F.sum("credits_consumed").alias("credits_spent"))
    people = persons.groupBy("batch_id").agg(F.count("*").alias("persons"))
    jobs = employment.groupBy("batch_id").agg(F.count("*").alias("employment_rows"))
    rows = (warned.join(status_counts(lookup), "batch_id").join(dates, "batch_id")
            .join(people, "batch_id", "left").join(jobs, "batch_id", "left")
            .fillna(0, ["persons", "employment_rows"])
            .withColumn("provider", F.lit(provider))
            .drop("invalid_input", "rows_matched", "rows_unavailable", "flag_counts", "top_doubts"))
    return conform_schema(stamp_version(rows, version, built_at=at), "fact_batch_quality", KEEP)


# ------------------------------------------------------------------ checks


def check_tables(tables: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Contradictions between the tables: batch_id, rule, detail.  Empty means publishable.

    ``expected``: batch_id, rows (input rows of the batch).
    """
    lookup, persons = tables["fact_lookup"], tables["dim_person"]
    employment = tables["fact_employment"]

    def finding(df: DataFrame, rule: str, *detail: str | Column) -> DataFrame:
        text = F.concat(*[F.lit(d) if isinstance(d, str) else d.cast("string") for d in detail])
        return df.select("batch_id", F.lit(rule).alias("rule"), text.alias("detail"))

    n = F.coalesce("n", F.lit(0))
    sizes = lookup.groupBy("batch_id").agg(F.count("*").alias("n"), F.count_if(
        F.col("status").isin(V.MATCHED_STATUSES)).alias("matched"))
    rows = F.coalesce("rows", F.lit(0))
    off = sizes.join(expected, "batch_id", "full").filter(n != rows)
    doubled = (lookup.groupBy("batch_id", "row_number").count()
               .filter((F.col("count") > 1) | F.col("row_number").isNull())
               .select("batch_id").distinct())
    nobody = (persons.filter(F.coalesce("person_id", F.lit("")) == "")
              .select("batch_id").distinct())
    twice = (persons.groupBy("batch_id", "person_id").count().filter("count > 1")
             .select("batch_id").distinct())
    orphans = (employment.select("batch_id", "person_id").distinct()
               .join(persons.select("batch_id", "person_id"), ["batch_id", "person_id"],
                     "left_anti")
               .groupBy("batch_id").agg(F.count("*").alias("n")))
    crowd = (persons.groupBy("batch_id").agg(F.count("*").alias("n"))
             .join(sizes.select("batch_id", "matched"), "batch_id", "left")
             .filter(F.col("n") > F.coalesce("matched", F.lit(0))))
    findings = [
        finding(off, "row_count", "fact_lookup has ", n, " rows for ", rows, " input rows"),
        finding(doubled, "row_number", "fact_lookup row_number is not unique and non-null"),
        finding(nobody, "person_id", "dim_person has a row without person_id"),
        finding(twice, "person_unique", "dim_person person_id is not unique within the batch"),
        finding(orphans, "orphan_employment", "fact_employment references ", F.col("n"),
                " person_id(s) missing from dim_person"),
        finding(crowd, "too_many_persons", "dim_person has ", F.col("n"), " rows but only ",
                F.coalesce("matched", F.lit(0)), " lookups matched"),
    ]
    every = findings[0]
    for more in findings[1:]:
        every = every.unionByName(more)
    return every


def require_consistent(violations: DataFrame) -> None:
    """Raise when there is any violation; a sink calls this before it publishes."""
    first = violations.orderBy("batch_id").limit(1).collect()
    if first:
        raise OutputCheckError(f"{first[0]['batch_id']}: {first[0]['detail']}")


def build_tables(results: DataFrame, rejected: DataFrame, at: Column, provider: str,
                 parse_warnings: DataFrame | None = None,
                 version: str = __version__) -> dict[str, DataFrame]:
    """The four curated tables of every batch in ``results`` and ``rejected``."""
    tables = build_facts(results, rejected, at, provider, version)
    tables["fact_batch_quality"] = build_quality(tables, at, provider, parse_warnings,
                                                 unrecorded_counts(results), version)
    return tables


def build_facts(results: DataFrame, rejected: DataFrame, at: Column, provider: str,
                version: str = __version__) -> dict[str, DataFrame]:
    persons = first_per_person(results)
    return {"dim_person": dim_person(persons, version),
            "fact_employment": fact_employment(persons, version),
            "fact_lookup": fact_lookup(results, rejected, at, provider, version)}


def unrecorded_counts(results: DataFrame) -> DataFrame | None:
    if "unrecorded" not in results.columns:
        return None
    return results.groupBy("batch_id").agg(F.count_if(F.col("unrecorded")).alias("rows_unrecorded"))


def build_quality(tables: dict[str, DataFrame], at: Column, provider: str,
                  parse_warnings: DataFrame | None = None, unrecorded: DataFrame | None = None,
                  version: str = __version__) -> DataFrame:
    """The quality table from the other three, best from their published files."""
    lookup = tables["fact_lookup"]
    warned = batch_warnings(batch_quality(lookup), parse_warnings, unrecorded)
    return fact_batch_quality(lookup, tables["dim_person"], tables["fact_employment"], at,
                              provider, warned, version)


def empty_tables(spark) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in CURATED.items()}
