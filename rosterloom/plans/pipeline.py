"""The batch plan: registrants -> guards -> ladder -> credits and breaker -> curated tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom import vocabulary as V
from rosterloom.config import CreditLimits, GuardLimits, LadderConfig
from rosterloom.operators import (breaker, credits, curate, erasure, forecast, matching,
                                  validation)
from rosterloom.operators.prefix import ordered_prefix
from rosterloom.session import cut_lineage, discard, scratch_path, side_by_side
from rosterloom.sources import identities, snapshots, store
from rosterloom.sources.snapshots import Publication

@dataclass(frozen=True)
class Settings:
    provider: str = "recorded"
    guards: GuardLimits = field(default_factory=GuardLimits)
    ladder: LadderConfig = field(default_factory=LadderConfig)
    limits: CreditLimits = field(default_factory=CreditLimits)


def would_answer(valid: DataFrame, people: DataFrame, candidates: DataFrame,
                 settings: Settings = Settings(), faults: DataFrame | None = None,
                 index: DataFrame | None = None) -> DataFrame:
    """Every valid row with the outcome it would get if it were called.

    ``faults`` (lookup_key, fault_status, provider_error) are recorded responses that were no
    answers: 402, 5xx and other errors; they take the place of the catalogue's answer.
    ``index`` is the ``matching.answer_index`` of people and candidates where it is kept.
    """
    plan = matching.plan_lookup(valid, settings.ladder)
    answered = matching.match_ladder(plan, people, candidates, settings.ladder, index)
    if faults is None:
        answered = answered.withColumn("provider_error", F.lit(None).cast("string"))
    else:
        hit = F.col("fault_status").isNotNull()
        answered = (answered.join(faults, "lookup_key", "left")
                    .withColumn("http_status", F.coalesce("fault_status", "http_status"))
                    .withColumns({c: F.when(~hit, F.col(c)) for c in (
                        "person_id", "likelihood", "candidates", "gate")})
                    .drop("fault_status"))
    return _finish(answered, people, settings)


def _finish(answered: DataFrame, people: DataFrame, settings: Settings) -> DataFrame:
    found = F.col("profile").isNotNull()
    profiles = people.select("person_id", "profile")
    interpreted = matching.interpret_status(
        answered.join(profiles, "person_id", "left")
        .withColumn("has_data", found)
        .withColumn("unparseable", F.lit(None).cast("string")))
    cost = F.when((F.col("http_status") == 200) | (
        (F.col("call_kind") == "identify") & (F.col("http_status") == 404)), 1).otherwise(0)
    flagged = matching.match_flags(interpreted, settings.ladder)
    return (flagged.withColumn("provider", F.lit(settings.provider))
            .withColumn("credits", cost)
            .withColumn("requested_at", row_clock())
            .withColumn("raw_ref", store.raw_ref()))


def row_clock() -> Column:
    """When a row of a batch is looked up: the batch's day, one row per second."""
    return F.to_timestamp("batch_date", "yyyy-MM-dd") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("row_number").cast("decimal(18,6)"))


def record(outcomes: DataFrame) -> DataFrame:
    """Lookup results from outcomes with ``repeat`` and, optionally, ``block`` marks.

    A call counts one attempt unless the outcomes have ``attempts``.
    ``block`` is a struct (status, message, http_status) of rows that never were called.
    """
    cached = F.col("repeat")
    if "block" not in outcomes.columns:
        outcomes = outcomes.withColumn(
            "block", F.lit(None).cast("struct<status:string,message:string,http_status:int>"))
    blocked = F.col("block").isNotNull()
    idle = cached | blocked

    def unless_blocked(name: str) -> Column:
        return F.when(~blocked, F.col(name)).alias(name)

    return outcomes.select(
        "batch_id", "batch_date", "row_number", "first_name", "last_name", "email", "company",
        "location", "linkedin_url", "notes", "lookup_key",
        F.when(blocked, F.col("block.status")).when(cached, "cached")
        .otherwise(F.col("status")).alias("status"),
        "provider", "lookup_method", "call_kind", unless_blocked("profile"),
        unless_blocked("likelihood"), unless_blocked("candidates"),
        F.when(blocked, F.col("block.http_status")).when(~cached, F.col("http_status"))
        .alias("http_status"),
        F.when(blocked, F.col("block.message")).when(~cached, F.col("error_message"))
        .alias("error_message"),
        F.when(idle, 0).otherwise(F.col("credits")).alias("credits_consumed"),
        F.when(idle, 0).otherwise(F.col("attempts") if "attempts" in outcomes.columns else 1)
        .alias("attempts"),
        F.when(~blocked, F.when(cached, F.coalesce("payer_ref", "raw_ref"))
               .otherwise(F.col("raw_ref"))).alias("raw_ref"),
        F.when(blocked, F.array().cast("array<string>")).otherwise(F.col("match_flags"))
        .alias("match_flags"),
        "requested_at")


def lookup_results(valid: DataFrame, people: DataFrame, candidates: DataFrame,
                   settings: Settings = Settings(), faults: DataFrame | None = None,
                   index: DataFrame | None = None) -> DataFrame:
    """Results without ceilings and breaker: each batch pays once per key, repeats are cached."""
    outcomes = would_answer(valid, people, candidates, settings, faults, index)
    return record(matching.in_batch_cache(outcomes).withColumn("payer_ref", F.col("raw_ref")))


def cached_results(valid: DataFrame, cache: DataFrame, now: Column, people: DataFrame,
                   candidates: DataFrame, settings: Settings = Settings(),
                   faults: DataFrame | None = None) -> DataFrame:
    """Results behind a stored cache: rows with a live answer are cached and pay nothing.

    What a hit shows is what is stored: its person, not what a call would answer today.
    """
    asked = matching.cache_lookup(matching.plan_lookup(valid, settings.ladder), cache, now)
    rows = asked.select("batch_id", "row_number", "hit", F.col("stored.person_id").alias("_person"),
                        F.col("stored.likelihood").alias("_likelihood"))
    outcomes = matching.in_batch_cache(would_answer(valid, people, candidates, settings, faults))
    profiles = people.select(F.col("person_id").alias("_person"), F.col("profile").alias("_profile"))
    joined = (outcomes.join(rows, ["batch_id", "row_number"]).join(profiles, "_person", "left")
              .withColumns({
                  "repeat": F.col("repeat") | F.col("hit"),
                  "profile": F.when(F.col("hit"), F.col("_profile")).otherwise(F.col("profile")),
                  "likelihood": F.when(F.col("hit"), F.col("_likelihood"))
                  .otherwise(F.col("likelihood")),
                  "payer_ref": F.col("raw_ref")}))
    return record(joined)


# ------------------------------------------------------------------ the protected lookup


def serial_clock(outcomes: DataFrame) -> DataFrame:
    """Rows timed as one run calls them: batches of a day one after the other, a row a second.

    A day with more rows than seconds has its rows spread evenly, so that none runs past midnight.
    """
    batches = outcomes.groupBy("batch_date", "batch_id").agg(F.max("row_number").alias("_rows"))
    starts = ordered_prefix(batches, ["batch_date"], ["batch_id"], {"_start": F.col("_rows")})
    days = batches.groupBy("batch_date").agg(F.sum("_rows").alias("_day"))
    starts = starts.join(days, "batch_date").select(
        "batch_date", "batch_id", "_day", F.coalesce("_start", F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("row_number")
    micros = F.when(F.col("_day") < 86_400, place * 1_000_000).otherwise(
        F.floor(place.cast("decimal(38,0)") * 86_400_000_000 / (F.col("_day") + 1)).cast("long"))
    midnight = F.unix_micros(F.to_timestamp("batch_date", "yyyy-MM-dd"))
    return (outcomes.join(starts, ["batch_date", "batch_id"])
            .withColumn("requested_at", F.timestamp_micros(midnight + micros))
            .drop("_start", "_day"))


def require_one_order(rows: DataFrame) -> None:
    """Raises unless each provider's rows by batch and number also follow one another in time."""
    block = F.floor(F.col("row_number") / 65_536).alias("block")
    blocks = rows.select("*", block)
    inside = Window.partitionBy("provider", "batch_id", "block").orderBy("row_number")
    late = (blocks.withColumn("_before", F.lag("requested_at").over(inside))
            .filter(F.col("_before") >= F.col("requested_at")))
    # One row for each block of a batch; their order is checked on this small table.
    ends = blocks.groupBy("provider", "batch_id", "block").agg(
        F.min("requested_at").alias("first"), F.max("requested_at").alias("last"))
    gaps = ordered_prefix(ends, ["provider"], ["batch_id", "block"], {"_before": F.col("last")},
                          F.max).filter(F.col("_before") >= F.col("first"))
    found = late.select("provider", "batch_id").limit(1).collect() or gaps.select(
        "provider", "batch_id").limit(1).collect()
    if found:
        raise ValueError(f"calls of {found[0]['provider']} in batch {found[0]['batch_id']} are not "
                         "in the order of batches and rows; see serial_clock")


#: Rows that are settled at once at first; see :func:`settle_calls`.
WINDOW = 1 << 20
_PLACE = ["batch_id", "row_number"]
_POOL = ["provider", "month", "kind"]


@dataclass(frozen=True)
class Settled:
    """What settled calls leave to later ones."""

    spent: DataFrame  # provider, month, kind, spent
    dry: DataFrame  # provider, month, kind, first_402
    paid: DataFrame  # lookup_key, payer
    breakers: DataFrame | None  # provider, failures, until


def _paid(decided: DataFrame) -> DataFrame:
    """The first call of each key whose answer is kept."""
    return (decided.filter((F.col("decision") == "call") & F.col("cacheable"))
            .groupBy("lookup_key").agg(F.min(F.struct(*_PLACE)).alias("payer")))


def _dry(decided: DataFrame) -> DataFrame:
    return (decided.filter((F.col("decision") == "call") & (F.col("http_status") == 402))
            .groupBy(*_POOL).agg(F.min(F.struct(*_PLACE)).alias("first_402")))


def _reaching(calls: DataFrame) -> DataFrame:
    return calls.select("provider", "call_id", "requested_at",
                        (F.coalesce(F.col("http_status"), F.lit(599)) >= 500).alias("failed"))


def settle_calls(outcomes: DataFrame, opening: DataFrame, settings: Settings,
                 window: int = WINDOW, watch: Callable[[int], None] | None = None) -> DataFrame:
    """What happens to every row once cache, exhausted pools, ceilings and breaker interact.

    The rules feed each other row by row: a skipped call spends nothing, a deferred one never
    reaches the breaker, and only a call that was made can fill the cache.  All rules go by one
    order, that of batches and rows, which must be that of time too (checked first).  So each
    decision depends on earlier rows alone, and there is exactly one consistent set of decisions.

    A frontier moves through the batches.  What is behind it is settled and left to later rows as
    state: spend, dry pools, breakers, and paid keys.  The batches of the window before it are
    guessed first (:mod:`forecast`) and then decided all at once from the previous round's
    decisions, until nothing changes; if no row before the first changed one changed, that row is
    settled for good, so this ends.  Mostly one round confirms the guess.  Walks and rounds
    follow the interplay of rules in the window, so it is halved (down to a batch) where they were
    many and doubled where they were few: the rows decided in all stay a small multiple of the input.
    No provider's calls ever pass through one task.

    Rows come back with ``repeat`` and ``block`` for :func:`record`.  ``watch`` is told the rows
    that each round decides.
    """
    spark, place = outcomes.sparkSession, _PLACE
    month = F.substring("batch_date", 1, 7)
    rows = cut_lineage(outcomes.select(
        *place, "provider", month.alias("month"), F.col("call_kind").alias("kind"), "lookup_key",
        "requested_at", "http_status", "credits",
        F.col("status").isin(V.CACHEABLE_STATUSES).alias("cacheable"),
        # No two calls of a provider share a moment, so it tells them apart.
        F.unix_micros("requested_at").alias("call_id"))
        .repartitionByRange(*place).sortWithinPartitions(*place))
    require_one_order(rows)
    spans = cut_lineage(ordered_prefix(
        rows.groupBy("batch_id").agg(F.count("*").alias("n")).withColumn("all", F.lit(0)), ["all"],
        ["batch_id"], {"before": F.col("n")}).withColumn("before", F.coalesce("before", F.lit(0))))
    total = spans.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    path = scratch_path(spark, "settled")
    schema = f"{rows.schema.simpleString()[7:-1]},decision:string,open_until:timestamp"
    schema = ", ".join(x.replace(":", " ", 1) for x in schema.split(","))
    none = spark.createDataFrame([], schema)
    none.write.parquet(f"{path}/window=0")
    state = Settled(opening.select(*_POOL, "spent"), _dry(none), _paid(none), None)
    behind = number = 0
    while behind < total:
        first, last, count = spans.filter(
            (F.col("before") >= behind) & (F.col("before") < behind + window)).agg(
            F.min("batch_id"), F.max("batch_id"), F.sum("n")).first()
        number += 1
        target = f"{path}/window={number}"
        rounds = _settle_window(rows.filter(F.col("batch_id").between(first, last)), state,
                                settings, target, lambda: watch(count) if watch else None)
        settled = spark.read.parquet(target)
        behind += count
        if behind < total:
            state = _left(state, settled, spark.read.parquet(path), settings)
        window = max(1, window // 2 if rounds > 6 else window * 2 if rounds <= 4 else window)
    decided = spark.read.parquet(path)

    kind = F.col("kind")
    limits = settings.limits
    text = "string"
    block = (F.when(F.col("decision") == "exhausted", F.struct(
        F.lit("budget_deferred").alias("status"),
        F.concat(F.lit("provider reported "), kind, F.lit(" credits exhausted (HTTP 402)"))
        .alias("message"), F.lit(402).alias("http_status")))
        .when(F.col("decision") == "month", F.struct(
            F.lit("budget_deferred").alias("status"),
            F.concat(kind, F.lit(" credit budget: monthly ceiling ("),
                     F.when(kind == "enrich", F.lit(limits.enrich).cast(text))
                     .otherwise(F.lit(limits.identify).cast(text)), F.lit(") reached"))
            .alias("message"), F.lit(None).cast("int").alias("http_status")))
        .when(F.col("decision") == "cap", F.struct(
            F.lit("budget_deferred").alias("status"),
            F.lit(f"credit budget: batch cap ({limits.per_batch}) reached").alias("message"),
            F.lit(None).cast("int").alias("http_status")))
        .when(F.col("decision") == "breaker", F.struct(
            F.lit("provider_unavailable").alias("status"),
            breaker.unavailable_message(F.col("open_until")).alias("message"),
            F.lit(None).cast("int").alias("http_status"))))
    payers = _paid(decided)
    refs = outcomes.select(F.struct(*place).alias("payer"), F.col("raw_ref").alias("payer_ref"))
    marks = (decided.select(*place, "lookup_key", (F.col("decision") == "cached").alias("repeat"),
                            block.alias("block"))
             .join(payers.join(refs, "payer").drop("payer"), "lookup_key", "left")
             .drop("lookup_key"))
    return outcomes.join(marks, place)


def _settle_window(rows: DataFrame, state: Settled, settings: Settings, target: str,
                   watch: Callable[[], None]) -> int:
    """Decides the rows until no decision changes, writes them, and tells the number of rounds."""
    guess, rounds = forecast.forecast(rows, state.spent, state.dry, state.paid, state.breakers,
                                      settings.limits, settings.ladder, watch)
    decided = cut_lineage(guess.withColumn("open_until", F.lit(None).cast("timestamp")))
    settled = None
    while True:
        following = cut_lineage(_decide(decided, state, settings))
        rounds += 1
        watch()
        changed = (following.join(decided.select(*_PLACE, F.col("decision").alias("before")), _PLACE)
                   .filter(F.col("decision") != F.col("before"))
                   .agg(F.min(F.struct(*_PLACE))).first()[0])
        discard(decided)
        decided = following
        if changed is None:
            decided.write.parquet(target)
            discard(decided)
            return rounds
        if settled is not None and tuple(changed) <= settled:
            raise AssertionError(f"a settled call changed: {tuple(changed)}")
        settled = tuple(changed)


def _left(state: Settled, settled: DataFrame, everything: DataFrame,
          settings: Settings) -> Settled:
    """The state behind a settled window; ``everything`` are the settled rows of all windows."""
    calls = settled.filter(F.col("decision") == "call")
    spent = (calls.groupBy(*_POOL).agg(F.sum("credits").alias("spent"))
             .unionByName(state.spent).groupBy(*_POOL).agg(F.sum("spent").alias("spent")))
    dry = (_dry(settled).unionByName(state.dry).groupBy(*_POOL)
           .agg(F.min("first_402").alias("first_402")))
    reached = settled.filter(F.col("decision").isin("call", "breaker"))
    _, breakers = breaker.continued(
        _reaching(reached), state.breakers, settings.ladder.breaker_threshold,
        settings.ladder.breaker_cooldown_seconds)
    # Small tables but for the paid keys, which are read from the settled rows.
    return Settled(cut_lineage(spent), cut_lineage(dry), _paid(everything), cut_lineage(breakers))


def _decide(decided: DataFrame, state: Settled, settings: Settings) -> DataFrame:
    """One round: every row's decision, taking the other rows' decisions as given."""
    base = [c for c in decided.columns if c not in ("decision", "open_until")]
    spot = F.struct(*_PLACE)
    called = F.col("decision") == "call"
    # Of the keys paid before only those that are asked for again.
    earlier = state.paid.join(decided.select("lookup_key").distinct(), "lookup_key", "left_semi")
    payers = (_paid(decided).unionByName(earlier).groupBy("lookup_key")
              .agg(F.min("payer").alias("payer")))
    dry = (_dry(decided).unionByName(state.dry).groupBy(*_POOL)
           .agg(F.min("first_402").alias("first_402")))
    marked = (decided.join(payers, "lookup_key", "left")
              .join(dry, _POOL, "left")
              .withColumn("is_cached", F.coalesce(spot > F.col("payer"), F.lit(False)))
              .withColumn("is_dry", F.coalesce(spot > F.col("first_402"), F.lit(False)))
              .withColumn("was_called", called)
              .drop("payer", "first_402", "decision", "open_until"))
    # Spend as decided so far: calls made.  Others ask at the price of nothing.
    priced = marked.withColumn("cost", F.col("credits")).withColumn(
        "credits", F.when(F.col("was_called"), F.col("credits")).otherwise(0))
    budget = credits.budget_admission(cut_lineage(priced), state.spent, settings.limits)
    # The breaker reads these rows several times: keep them instead of deciding them again.
    asked = cut_lineage(budget.withColumn("credits", F.col("cost")).drop("cost").withColumn(
        "gate", F.when(F.col("is_cached"), "cached").when(F.col("is_dry"), "exhausted")
        .when(F.col("reason").contains("monthly ceiling"), "month")
        .when(F.col("reason").isNotNull(), "cap")))
    skips, _ = breaker.continued(
        _reaching(asked.filter(F.col("gate").isNull())), state.breakers,
        settings.ladder.breaker_threshold, settings.ladder.breaker_cooldown_seconds)
    return asked.join(skips.select("provider", "call_id", "skipped", "open_until"),
                      ["provider", "call_id"], "left").select(
        *base, F.coalesce("gate", F.when(F.col("skipped"), "breaker"), F.lit("call"))
        .alias("decision"), "open_until")


def protected_results(valid: DataFrame, people: DataFrame, candidates: DataFrame,
                      opening: DataFrame, settings: Settings,
                      faults: DataFrame | None = None) -> DataFrame:
    """Lookup results under ceilings, exhausted pools and the breaker, across all batches."""
    outcomes = serial_clock(would_answer(valid, people, candidates, settings, faults))
    return record(settle_calls(outcomes, opening, settings))


def run_batches(registrants: DataFrame, people: DataFrame, candidates: DataFrame, at: Column,
                settings: Settings = Settings(), faults: DataFrame | None = None,
                parse_warnings: DataFrame | None = None,
                opening: DataFrame | None = None) -> dict[str, DataFrame]:
    """Raw registrant rows to the four curated tables, all batches in one plan.

    With ``opening`` balances (provider, month, kind, spent; none may have rows) calls are
    protected: ceilings, exhausted pools and the breaker hold, across all batches.
    """
    valid, rejected = validation.split_valid_invalid(registrants, settings.guards)
    if opening is None:
        results = lookup_results(valid, people, candidates, settings, faults)
    else:
        results = cut_lineage(protected_results(valid, people, candidates, opening, settings,
                                                faults))
    return curate.build_tables(results, rejected, at, settings.provider, parse_warnings)


def publish(results: DataFrame, rejected: DataFrame, path: str, at: Column, provider: str,
            parse_warnings: DataFrame | None = None, expected: DataFrame | None = None,
            built: DataFrame | None = None, into: Publication | None = None) -> None:
    """Builds and writes the curated tables of every batch, visible together or not at all.

    ``built`` (batch_date, batch_id) are the batches that are published, by default those with
    results or rejected rows; name them where one may have become empty.

    The report is computed from the files just written aside, so results are read once per table
    and what is reported is what lies there.  ``expected`` (batch_id, rows) turns on the
    consistency checks: contradictions raise before anything is visible.  With ``into`` the tables
    wait for that publication's commit.
    """
    if built is None:
        built = store.batches_of(results, rejected)
    facts = curate.build_facts(results, rejected, at, provider)
    publication = into or Publication(results.sparkSession, path)
    built = publication.batches(built)
    store.write_curated(facts, path, built, publication)
    own = ["batch_date", "batch_id"]
    written = {n: store.read_curated(results.sparkSession, path, n, publication.written(n))
               .join(built, own, "left_semi") for n in facts}
    if expected is not None:
        curate.require_consistent(curate.check_tables(written, expected))
    quality = curate.build_quality(written, at, provider, parse_warnings,
                                   curate.unrecorded_counts(results))
    store.write_curated({"fact_batch_quality": quality}, path, built, publication)
    if into is None:
        publication.commit()


def rebuild(results: DataFrame, rejected: DataFrame, path: str, at: Column, provider: str,
            batch_prefix: str = "", into: Publication | None = None) -> None:
    """Publishes the batches whose id starts with the prefix again, from stored results.

    No call is made, and other batches stay as they are.
    """
    chosen = F.col("batch_id").startswith(batch_prefix)
    publish(results.filter(chosen), rejected.filter(chosen), path, at, provider, into=into)


def uploaded(people: DataFrame, candidates: DataFrame, at: Column,
             settings: Settings = Settings(), faults: DataFrame | None = None
             ) -> Callable[[DataFrame, DataFrame, Publication], None]:
    """What ``curated_stream`` does with a micro-batch: results, rejected rows, curated tables and
    manifest of its batches, all into one publication.

    What the provider knows is brought into its lookup form once, not for each micro-batch.
    """
    @functools.cache
    def known() -> tuple[DataFrame, DataFrame | None]:
        return (cut_lineage(matching.answer_index(people, candidates, settings.ladder)),
                None if faults is None else cut_lineage(faults))

    def build(registrants: DataFrame, built: DataFrame, into: Publication) -> None:
        index, told = known()
        valid, rejected = validation.split_valid_invalid(registrants, settings.guards, kept=True)
        results = cut_lineage(lookup_results(valid, people, candidates, settings, told, index))
        side_by_side(
            into.spark,
            lambda: store.write_lookup_results(results, into.root, built, into),
            lambda: store.rejected_rows_export(rejected, into.root, built, into),
            lambda: identities.add(erasure.identity_entries(valid, rejected, results), into),
            lambda: publish(results, rejected, into.root, at, settings.provider, built=built,
                            into=into))
        quality = store.read_curated(into.spark, into.root, "fact_batch_quality",
                                     into.written("fact_batch_quality"))
        store.manifest(quality.join(built, ["batch_date", "batch_id"], "left_semi"), into.root,
                       built, into)

    return build


def erase(folder: str, matches: DataFrame, items: DataFrame, rejected: DataFrame, at: Column,
          provider: str) -> None:
    """Takes the matched rows out of every layer that lies below ``folder``.

    Layers: ``results``, ``rejected`` (the export), ``raw``, ``cache``, ``curated`` and, where there
    are any, ``manifest`` and ``identities``; only the dates of touched batches are written again, and a batch whose last row goes is emptied.
    ``rejected`` are the parsed rejected rows.  ``cache_gone`` gets the cache entries that went.
    """
    spark = matches.sparkSession
    results = store.lookup_results(spark, f"{folder}/results")
    touched = matches.select("batch_id").distinct()
    built = cut_lineage(store.batches_of(results, rejected).join(touched, "batch_id", "left_semi"))

    def remaining(table: DataFrame, part: str) -> DataFrame:
        return cut_lineage(erasure.affected(erasure.erase_rows(table, matches, part), touched))

    kept, turned_away = remaining(results, "row"), remaining(rejected, "rejected")
    index = f"{folder}/identities"
    if store.exists(spark, index):
        held, rest = ([erasure.affected(t, touched) for t in (rejected, results)],
                      [turned_away, kept])
        # Before the rows they come from are written again.
        entries, staying = (cut_lineage(erasure.identity_entries(r, t, r))
                            for t, r in (held, rest))
    left, gone = erasure.purge_cache(spark.read.parquet(f"{folder}/cache"), items)
    gone.write.mode("overwrite").parquet(f"{folder}/cache_gone")
    cut_lineage(left).write.mode("overwrite").parquet(f"{folder}/cache")
    refs = items.filter(F.col("item") == "raw_ref").select(F.col("value").alias("raw_ref"))
    store.erase_raw_responses(spark, f"{folder}/raw", refs.distinct())
    store.rejected_rows_export(turned_away, f"{folder}/rejected", built)
    store.write_lookup_results(kept, f"{folder}/results", built)
    publish(kept, turned_away, f"{folder}/curated", at, provider, built=built)
    if store.exists(spark, f"{folder}/manifest"):
        quality = store.read_curated(spark, f"{folder}/curated", "fact_batch_quality")
        store.manifest(quality.join(built, ["batch_date", "batch_id"], "left_semi"),
                       f"{folder}/manifest", built)
    if store.exists(spark, index):
        identities.forget(spark, index, entries, staying)
    # What was erased must not stay behind in folders that are read no more.
    for part in ("rejected", "results", "curated", "manifest"):
        snapshots.vacuum(spark, f"{folder}/{part}")
