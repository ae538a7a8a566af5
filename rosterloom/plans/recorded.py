"""Lookup results from recorded answers: the attempts of every call, their headers and bodies.

The plan says what each row would ask; the record says what came back.  ``attempts`` has a row for
each attempt (:data:`ATTEMPT`): a row of the batch that made a call has one or more, a row that was
served from an earlier one's answer has none.  Attempts fold into the response that counts, its
headers tell the credits, and its body is read as VARIANT, for its schema is open.

A transport failure is final, counts the attempts that are recorded and costs nothing.  A body that is
not JSON counts as none.  A row without attempts whose key no earlier row of its batch has answered is
left out: it is what ``curate.unrecorded_rows`` reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom import vocabulary as V
from rosterloom.functions import responses as R
from rosterloom.operators import curate, matching, validation
from rosterloom.plans.pipeline import Settings, record, row_clock
from rosterloom.session import cut_lineage
from rosterloom.sources import store

#: ``failure`` is the text of a transport failure; such an attempt has no ``http_status``.
ATTEMPT = ("batch_id string, row_number int, attempt int, requested_at timestamp, http_status int, "
           "headers map<string,string>, body string, failure string")
ROW = ("batch_id", "row_number")


def ranked_matches(matches: Column) -> Column:
    """Scores and places of a name search's matches, best first; equal scores keep their order."""
    def score(m: Column) -> Column:
        return F.coalesce(F.try_variant_get(m, "$.match_score", "double"), F.lit(0.0))

    return F.array_sort(F.transform(matches, lambda m, i: F.struct(
        (-score(m)).alias("below"), i.alias("place"))))


def final_responses(attempts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The response that counts for each call, with ``attempts``, waits and when it began."""
    waits = attempts.withColumn("wait", R.rate_limit_wait(F.col("headers"), F.col("requested_at")))
    return matching.resolve_attempts(waits, settings.ladder, ROW,
                                     {"started_at": F.min("requested_at")})


def interpreted(valid: DataFrame, attempts: DataFrame,
                settings: Settings = Settings()) -> DataFrame:
    """Every valid row with what its own call came to; ``attempts`` is null where it made none."""
    cfg = settings.ladder
    final = final_responses(attempts, settings).select(
        *ROW, "http_status", "headers", F.try_parse_json("body").alias("body"), "failure",
        "attempts", "waited_seconds", "started_at")
    enrich, ok = F.col("call_kind") == "enrich", F.col("http_status") == 200
    asked = (matching.plan_lookup(valid, cfg).join(final, list(ROW), "left")
             .withColumn("_matches", R.listed(F.col("body"), "$.matches"))
             .withColumn("_ranked", ranked_matches(F.col("_matches")))
             .withColumn("_top", -F.get("_ranked", F.lit(0))["below"])
             .withColumn("_margin", F.col("_top") - F.coalesce(
                 -F.get("_ranked", F.lit(1))["below"], F.lit(0.0))))
    confident = (F.col("_top") >= cfg.identify_min_score) & (
        F.col("_margin") >= cfg.identify_min_margin)
    best = R.at(F.get("_matches", F.get("_ranked", F.lit(0))["place"]), "$.data")
    read = (asked
            .withColumn("_data", F.when(enrich, R.at(F.col("body"), "$.data")).otherwise(
                F.coalesce(best, F.parse_json(F.lit("{}")))))
            .withColumn("has_data", F.coalesce(
                R.kind_of(F.col("_data")).startswith("OBJECT"), F.lit(False)))
            .withColumn("gate", F.when(~enrich & ok & (F.size("_matches") > 0), F.when(
                confident, "matched").otherwise("ambiguous")))
            .withColumn("unparseable", F.when(ok, R.profile_problem(F.col("_data"))))
            .withColumn("provider_error", R.response_error(F.col("body"))))
    failed, matched = F.col("failure").isNotNull(), F.col("status") == "matched"
    told = matching.interpret_status(read).withColumns({
        "status": F.when(failed, "error").when(F.col("attempts").isNotNull(), F.col("status")),
        "error_message": F.when(failed, F.concat(F.lit("transport error: "), "failure"))
        .otherwise(F.col("error_message"))})
    scored = matched | (F.col("status") == "ambiguous")
    told = told.withColumns({
        "profile": F.when(matched, R.coerce_obscured(F.col("_data"))),
        "likelihood": F.when(enrich & matched, F.try_variant_get("body", "$.likelihood", "double"))
        .when(~enrich & scored, F.col("_top")),
        "candidates": F.when(enrich & matched, 1).when(
            ~enrich & ok & F.col("status").isin("matched", "ambiguous", "not_found"),
            F.size("_matches")),
        "credits": F.when(failed, 0).otherwise(R.credits_spent(
            F.col("call_kind"), F.col("http_status"), F.col("headers"))),
        "credits_remaining": R.credits_remaining(F.col("headers")),
        "requested_at": F.coalesce("started_at", row_clock()),
        "provider": F.lit(settings.provider)})
    return (matching.match_flags(told, cfg).withColumn("raw_ref", store.raw_ref())
            .drop("_matches", "_ranked", "_top", "_margin", "_data", "body", "headers", "started_at"))


def recorded_results(valid: DataFrame, attempts: DataFrame,
                     settings: Settings = Settings()) -> DataFrame:
    """Lookup results of every row that called or was served from an earlier row's answer.

    What a served row shows is the answer of the first row of its key in the batch whose answer
    can be kept, found with a map-side combined minimum.
    """
    rows = cut_lineage(interpreted(valid, attempts, settings))
    shown = ["profile", "likelihood", "candidates", "match_flags"]
    payers = (rows.filter(F.col("status").isin(V.CACHEABLE_STATUSES))
              .groupBy("batch_id", "lookup_key")
              .agg(F.min_by(F.struct("row_number", "raw_ref", *shown), "row_number").alias("payer")))
    calls = F.col("attempts").isNotNull()
    answered = F.coalesce(F.col("payer.row_number") < F.col("row_number"), F.lit(False))
    served = (rows.join(payers, ["batch_id", "lookup_key"], "left").filter(calls | answered)
              .withColumn("repeat", ~calls)
              .withColumn("payer_ref", F.col("payer.raw_ref"))
              .withColumns({c: F.when(calls, F.col(c)).otherwise(F.col(f"payer.{c}"))
                            for c in shown}))
    return record(served)


def run_recorded(registrants: DataFrame, attempts: DataFrame, at: Column,
                 settings: Settings = Settings(),
                 parse_warnings: DataFrame | None = None) -> dict[str, DataFrame]:
    """Raw registrant rows and the recorded attempts of their calls to the four curated tables."""
    valid, rejected = validation.split_valid_invalid(registrants, settings.guards)
    return curate.build_tables(recorded_results(valid, attempts, settings), rejected, at,
                               settings.provider, parse_warnings)
