"""The identifier ladder: planning, cache, matching as joins, interpretation, doubts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom import vocabulary as V
from rosterloom.config import LadderConfig
from rosterloom.functions.guards import valid_date
from rosterloom.functions.text import (fold_text, lookup_key, normalize_email, normalize_text,
                                       normalize_url)

LADDER = LadderConfig()


def plan_lookup(valid: DataFrame, cfg: LadderConfig = LADDER) -> DataFrame:
    """Rung, call kind, request parameters and cache key of every valid row."""
    hint = F.lit(cfg.location_hint).cast("string")
    place = F.coalesce("location", hint)
    method = (F.when(F.col("email").isNotNull(), "email")
              .when(F.col("linkedin_url").isNotNull(), "linkedin")
              .when(F.col("company").isNotNull() | place.isNotNull(), "name_context")
              .otherwise("name_only"))
    is_enrich = F.col("call_kind") == "enrich"
    likelihood = str(cfg.enrich_min_likelihood)

    def sent(name: str, value: Column, when: Column) -> Column:
        return F.struct(F.lit(name).alias("k"), F.when(when, value).alias("v"))

    rung = F.col("lookup_method")
    by_name = rung.isin("name_context", "name_only")
    pairs = F.array(
        sent("email", F.col("email"), rung == "email"),
        sent("profile", F.col("linkedin_url"), rung == "linkedin"),
        sent("first_name", F.col("first_name"), by_name),
        sent("last_name", F.col("last_name"), by_name),
        sent("company", F.col("company"), rung == "name_context"),
        sent("location", place, rung == "name_context"),
        sent("min_likelihood", F.lit(likelihood), is_enrich))
    extra = F.when(is_enrich, f"min_likelihood={likelihood}").otherwise(
        f"identify_min_score={cfg.identify_min_score}"
        f";identify_min_margin={cfg.identify_min_margin}")
    return (valid.withColumn("lookup_method", method)
            .withColumn("call_kind", F.when(rung == "name_only", "identify").otherwise("enrich"))
            .withColumn("params", F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull())))
            .withColumn("lookup_key", lookup_key(
                F.col("first_name"), F.col("last_name"), email=F.col("email"),
                company=F.col("company"), location=F.when(rung == "name_context", place),
                linkedin_url=F.col("linkedin_url"), extra=extra)))


# ------------------------------------------------------------------ cache


def cache_lookup(plan: DataFrame, cache: DataFrame, now: Column) -> DataFrame:
    """Rows with the stored answer of their key where it has not expired (``hit``).

    The cache holds one row per key, so the join never multiplies rows; a key shared by very
    many rows makes the plan side skewed only, which adaptive execution splits.
    """
    live = cache.filter(F.col("expires_at") > now)
    answer = [c for c in live.columns if c not in ("lookup_key", "expires_at", "updated_at")]
    stored = live.select("lookup_key", F.struct(*answer).alias("stored"))
    return plan.join(stored, "lookup_key", "left").withColumn("hit", F.col("stored").isNotNull())


def in_batch_cache(calls: DataFrame, scope: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """Who pays for a key: ``repeat`` rows reuse an earlier row's answer.

    ``calls`` carries the outcome each row would get (``status``).  The first row of a key in
    its ``scope`` pays; later ones are repeats when that outcome can be cached.  With an
    empty scope several batches of one job share their answers, in batch order.  First rows
    come from a map-side combined minimum, not from a window over a possibly hot key.
    """
    place = F.struct("batch_id", "row_number")
    keys = [*scope, "lookup_key"]
    payer = calls.groupBy(*keys).agg(F.min(place).alias("payer"))
    return (calls.join(payer, keys)
            .withColumn("repeat", (place > F.col("payer"))
                        & F.col("status").isin(V.CACHEABLE_STATUSES)))


def cache_upsert(results: DataFrame, cache: DataFrame, now: Column,
                 days: int = LADDER.cache_days) -> DataFrame:
    """The cache with the newest cacheable answer per key, good for ``days`` more days."""
    fresh = (results.filter(F.col("status").isin(V.CACHEABLE_STATUSES))
             .withColumn("updated_at", F.col("requested_at"))
             .withColumn("expires_at", F.col("requested_at") + F.make_dt_interval(F.lit(days))))
    both = cache.unionByName(fresh.select(*cache.columns))
    newest = Window.partitionBy("lookup_key").orderBy(F.desc("updated_at"), F.desc("batch_id"))
    return (both.filter(F.col("expires_at") > now)
            .withColumn("age", F.row_number().over(newest)).filter("age = 1").drop("age"))


# ------------------------------------------------------------------ matching


def identifier_index(people: DataFrame, cfg: LadderConfig = LADDER) -> DataFrame:
    """(method, identifier) -> the person the provider answers with, likely enough to count.

    Slim rows only; the best person per identifier is found with a map-side combined
    maximum, so a join against the index never multiplies rows.
    """
    name = normalize_text(F.concat_ws(" ", "first_name", "last_name"))
    named = people.select(
        "person_id", "likelihood", name.alias("name"),
        normalize_email(F.col("email")).alias("email"),
        normalize_url(F.col("linkedin_url")).alias("url"),
        normalize_text(F.col("company_name")).alias("company"),
        normalize_text(F.col("location")).alias("place"))

    def entry(method: str, value: Column) -> Column:
        return F.struct(F.lit(method).alias("method"), value.alias("identifier"))

    def whole(kind: str) -> Column:
        # Without a company or place that says something a name stands for everybody of it.
        return F.when((F.col("name") != "") & (F.col(kind) != ""),
                      F.concat_ws("|", "name", F.lit(kind), kind))

    entries = F.array(
        entry("email", F.col("email")), entry("linkedin", F.col("url")),
        entry("name_context", whole("company")), entry("name_context", whole("place")))
    return (named.filter(F.col("likelihood") >= cfg.enrich_min_likelihood)
            .select("person_id", "likelihood", F.inline(entries))
            .filter(F.col("identifier") != "")
            .groupBy("method", "identifier")
            .agg(F.max_by(F.struct("person_id", "likelihood"),
                          F.struct("likelihood", "person_id")).alias("best"))
            .select("method", "identifier", "best.person_id", "best.likelihood"))


def identifier_of(cfg: LadderConfig = LADDER) -> Column:
    """The identifier a planned row is looked up by on its own rung."""
    name = normalize_text(F.concat_ws(" ", "first_name", "last_name"))
    place = F.coalesce("location", F.lit(cfg.location_hint).cast("string"))
    return (F.when(F.col("lookup_method") == "email", normalize_email(F.col("email")))
            .when(F.col("lookup_method") == "linkedin", normalize_url(F.col("linkedin_url")))
            .when(normalize_text(F.col("company")) != "",
                  F.concat_ws("|", name, F.lit("company"), normalize_text(F.col("company"))))
            .when(normalize_text(place) != "",
                  F.concat_ws("|", name, F.lit("place"), normalize_text(place)))
            .otherwise(name))


def gate_candidates(candidates: DataFrame, cfg: LadderConfig = LADDER) -> DataFrame:
    """One verdict per name: confident or not, the top candidate, its score, how many.

    ``candidates`` is (name_key, person_id, match_score).  Ranking keeps two rows per name
    before the shuffle (window group limit), counting is combined map-side; a name shared by
    very many people therefore stays cheap.
    """
    best = Window.partitionBy("name_key").orderBy(F.desc("match_score"), "person_id")
    two = candidates.withColumn("rank", F.row_number().over(best)).filter("rank <= 2")
    top = two.groupBy("name_key").agg(
        F.max(F.when(F.col("rank") == 1, F.struct("match_score", "person_id"))).alias("top"),
        F.max(F.when(F.col("rank") == 2, F.col("match_score"))).alias("second"))
    counts = candidates.groupBy("name_key").agg(F.count("*").cast("int").alias("candidates"))
    score = F.coalesce(F.col("top.match_score"), F.lit(0.0))
    margin = score - F.coalesce("second", F.lit(0.0))
    confident = (score >= cfg.identify_min_score) & (margin >= cfg.identify_min_margin)
    return top.join(counts, "name_key").select(
        "name_key", "candidates", score.alias("likelihood"),
        F.when(confident, F.col("top.person_id")).alias("person_id"),
        F.when(confident, "matched").otherwise("ambiguous").alias("gate"))


def answer_index(people: DataFrame | None, candidates: DataFrame | None,
                 cfg: LadderConfig = LADDER) -> DataFrame:
    """Everything the provider could answer: one row per (method, identifier)."""
    parts = []
    if people is not None:
        parts.append(identifier_index(people, cfg).withColumns(
            {"candidates": F.lit(1), "gate": F.lit(None).cast("string")}))
    if candidates is not None:
        parts.append(gate_candidates(candidates, cfg)
                     .withColumnRenamed("name_key", "identifier")
                     .withColumn("method", F.lit("name_only")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _answer(plan: DataFrame, index: DataFrame, cfg: LadderConfig) -> DataFrame:
    asked = (plan.withColumn("method", F.col("lookup_method"))
             .withColumn("identifier", identifier_of(cfg)))
    known = index.withColumn("answered", F.lit(True))
    return (asked.join(known, ["method", "identifier"], "left")
            .withColumn("http_status", F.when(F.col("answered"), 200).otherwise(404))
            .drop("method", "identifier", "answered"))


def match_ladder(plan: DataFrame, people: DataFrame, candidates: DataFrame,
                 cfg: LadderConfig = LADDER, index: DataFrame | None = None) -> DataFrame:
    """The answer to every planned row, all four rungs in one equi-join.

    Adds http_status, person_id, likelihood, candidates and (name rung) gate.  Each row asks
    on its own rung only, so the plan is read and shuffled once and no OR-join is needed.
    ``index`` is the people's and candidates' :func:`answer_index` where it is kept.
    """
    if index is None:
        index = answer_index(people, candidates, cfg)
    return _answer(plan, index, cfg)


def match_strong(plan: DataFrame, people: DataFrame, cfg: LadderConfig = LADDER) -> DataFrame:
    """Answers on the e-mail, profile and name-with-context rungs: 200 with a person, or 404."""
    return _answer(plan.filter(F.col("call_kind") == "enrich"),
                   answer_index(people, None, cfg), cfg).drop("gate")


def match_identify(plan: DataFrame, candidates: DataFrame, cfg: LadderConfig = LADDER) -> DataFrame:
    """Answers on the name-only rung through the confidence gate."""
    return _answer(plan.filter(F.col("call_kind") == "identify"),
                   answer_index(None, candidates, cfg), cfg)


def name_candidates(people: DataFrame) -> DataFrame:
    """Candidates a provider would list for a name."""
    name = normalize_text(F.concat_ws(" ", "first_name", "last_name"))
    return people.select(name.alias("name_key"), "person_id", "match_score")


# ------------------------------------------------------------------ responses


def resolve_attempts(responses: DataFrame, cfg: LadderConfig = LADDER,
                     keys: tuple[str, ...] = ("lookup_key",),
                     also: dict[str, Column] | None = None) -> DataFrame:
    """The response that counts per call: the first final one, else the last allowed.

    ``responses`` is one row per attempt (``attempt``, ``http_status``, ``wait`` from the
    headers or null).  Adds ``attempts``, the capped seconds waited before it, and the aggregates
    in ``also``.  An attempt without a status (a transport failure) is final.
    """
    retried = F.coalesce((F.col("http_status") == 429) | (F.col("http_status") >= 500),
                         F.lit(False))
    allowed = responses.filter(F.col("attempt") <= cfg.max_attempts)
    last = F.col("attempt") == cfg.max_attempts
    asked = F.when(F.col("http_status") == 429, F.col("wait"))
    pause = F.least(F.coalesce(asked, F.pow(F.lit(2.0), F.col("attempt"))),
                    F.lit(float(cfg.max_wait_seconds)))
    held = [c for c in responses.columns if c not in keys]
    # The least (not final, attempt) is the first final response; without one the latest counts.
    final = ~retried | last
    rank = F.struct((~final).alias("open"), F.when(final, F.col("attempt")).otherwise(
        -F.col("attempt")).alias("turn"))
    chosen = allowed.groupBy(*keys).agg(
        F.min_by(F.struct(*held), rank).alias("r"),
        F.map_from_entries(F.collect_list(F.struct("attempt", F.when(retried & ~last, pause)
                                                   .otherwise(0.0)))).alias("pauses"),
        *[value.alias(name) for name, value in (also or {}).items()])
    waited = F.aggregate(
        F.filter(F.map_entries("pauses"), lambda e: e["key"] < F.col("r.attempt")),
        F.lit(0.0), lambda acc, e: acc + e["value"])
    return chosen.select(*keys, "r.*", F.col("r.attempt").alias("attempts"),
                         waited.alias("waited_seconds"), *(also or {}))


def interpret_status(calls: DataFrame) -> DataFrame:
    """``status`` and ``error_message`` of answered calls.

    Reads ``http_status``, ``call_kind``, ``gate`` (name rung), ``has_data`` (a 200 carried an
    object), ``unparseable`` (why a profile could not be read) and ``provider_error``.
    """
    http = F.col("http_status")
    told = F.col("provider_error")
    not_data = (F.col("call_kind") == "enrich") & ~F.col("has_data")
    no_candidates = (F.col("call_kind") == "identify") & F.col("gate").isNull()
    ambiguous = (F.col("call_kind") == "identify") & (F.col("gate") == "ambiguous")
    broken = F.col("unparseable").isNotNull()
    status = (F.when(http == 402, "budget_deferred").when(http == 404, "not_found")
              .when((http != 200) | not_data, "error").when(no_candidates, "not_found")
              .when(ambiguous, "ambiguous").when(broken, "error").otherwise("matched"))
    message = (F.when(http == 402, F.coalesce(told, F.lit("payment required")))
               .when(http == 404, F.lit(None).cast("string"))
               .when(http != 200, F.coalesce(told, F.concat(F.lit("HTTP "), http.cast("string"))))
               .when(not_data, "200 response without data")
               .when(no_candidates | ambiguous, F.lit(None).cast("string"))
               .when(broken, F.concat(F.lit("unparseable profile: "), F.col("unparseable"))))
    return calls.withColumn("status", status).withColumn("error_message", message)


def match_flags(results: DataFrame, cfg: LadderConfig = LADDER) -> DataFrame:
    """Doubts about every matched profile as ``match_flags``, in fixed order, else empty.

    Reads ``last_name``, ``profile``, ``likelihood``, ``call_kind`` and ``status``.
    """

    def words(value: Column) -> Column:
        return F.filter(F.split(value, " "), lambda t: t != "")

    profile, jobs = F.col("profile"), F.col("profile.experience")
    folded = (results
              .withColumn("entered", words(fold_text(F.col("last_name"))))
              .withColumn("known", words(fold_text(F.concat_ws(
                  " ", profile["full_name"], profile["first_name"], profile["last_name"])))))
    mismatch = ((F.size("entered") > 0) & (F.size("known") > 0)
                & ~F.arrays_overlap("entered", "known"))
    sparse = profile["full_name"].isNull() | (
        profile["job_title"].isNull() & profile["job_company_name"].isNull())
    at_floor = ((F.col("call_kind") == "enrich")
                & (F.col("likelihood") <= cfg.enrich_min_likelihood))

    def bad(e: Column) -> Column:
        return (F.coalesce(~valid_date(e["start_date"]), F.lit(False))
                | F.coalesce(~valid_date(e["end_date"]), F.lit(False)))

    def backwards(e: Column) -> Column:
        return ~bad(e) & F.coalesce(e["end_date"] < e["start_date"], F.lit(False))

    flags = F.array_compact(F.array(
        F.when(mismatch, "match.name_mismatch"),
        F.when(sparse, "match.sparse_profile"),
        F.when(F.size(F.coalesce(jobs, F.array())) == 0, "match.no_employment"),
        F.when(at_floor, "match.likelihood_at_floor"),
        F.when(F.exists(jobs, bad), "match.malformed_dates"),
        F.when(F.exists(jobs, backwards), "match.end_before_start")))
    matched = (F.col("status") == "matched") & profile.isNotNull()
    return (folded.withColumn("match_flags", F.when(matched, flags)
                              .otherwise(F.array().cast("array<string>")))
            .drop("entered", "known"))
