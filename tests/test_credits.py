"""Ceilings, caps and the interplay of all call rules against sequential simulations."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rosterloom.config import CreditLimits, LadderConfig
from rosterloom.operators import credits, forecast, prefix
from rosterloom.operators.prefix import ordered_prefix
from rosterloom.plans import pipeline

CALLS = ("provider string, month string, batch_id string, row_number int, kind string, "
         "credits int")


def admit_in_turn(rows, opening, limits):
    month, batch, decided = dict(opening), {}, {}
    for provider, period, batch_id, number, kind, cost in sorted(rows, key=lambda r: r[:4]):
        ceiling = limits.ceilings()[kind]
        spent = month.get((provider, period, kind), 0)
        used = batch.get((provider, batch_id), 0)
        reason = None
        if ceiling is not None and spent >= ceiling:
            reason = f"{kind} credit budget: monthly ceiling ({ceiling}) reached"
        elif limits.per_batch is not None and used >= limits.per_batch:
            reason = f"credit budget: batch cap ({limits.per_batch}) reached"
        else:
            month[provider, period, kind] = spent + cost
            batch[provider, batch_id] = used + cost
        decided[batch_id, number] = reason
    return decided


@pytest.mark.parametrize("seed,limits", [
    (1, CreditLimits(enrich=30, identify=12, per_batch=9)),
    (3, CreditLimits(enrich=None, identify=None, per_batch=5)),
    (5, CreditLimits()),
])
def test_admission_agrees_with_a_loop(spark, monkeypatch, seed, limits):
    monkeypatch.setattr(prefix, "ROWS_PER_BLOCK", 4)
    rng = random.Random(seed)
    rows = [("p", f"2024-0{m}", f"2024-0{m}-b{b}", n, rng.choice(["enrich", "identify"]),
             rng.choice([0, 1, 1, 3])) for m in (1, 2) for b in range(5) for n in range(1, 16)]
    opening = {("p", "2024-02", "enrich"): 4, ("p", "2024-02", "identify"): 40}
    brought = spark.createDataFrame([(*k, v) for k, v in opening.items()],
                                    "provider string, month string, kind string, spent long")
    got = credits.budget_admission(spark.createDataFrame(rows, CALLS), brought, limits).collect()
    assert {(r.batch_id, r.row_number): r.reason for r in got} == admit_in_turn(
        rows, opening, limits)


def test_running_sums_over_blocks(spark):
    rows = [("g", i, i % 7) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "g string, row_number int, v int")
    got = prefix.running_sums(df, ["g"], prefix.row_block(size=8), ["row_number"],
                              {"before": F.col("v")}).orderBy("row_number").collect()
    total = 0
    for r in got:
        assert r.before == total
        total += r.v


def test_prefixes_over_ranges(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7)
               .cast("string"))).alias("g"), F.xxhash64("id").alias("at"),
        F.pmod(F.hash("id"), F.lit(100)).alias("v"))
    for combine, plain in ((F.sum, sum), (F.max, max), (F.min, min)):
        got = ordered_prefix(rows, ["g"], ["at"], {"before": F.col("v")}, combine).collect()
        seen = {}
        for r in sorted(got, key=lambda r: (r.g, r.at)):
            before = seen.setdefault(r.g, [])
            assert r.before == (plain(before) if before else None)
            seen[r.g] = [plain([*before, r.v])]


def test_a_day_with_more_rows_than_seconds(spark):
    """90,000 rows on one day and 10 on the next: rows stay on their day, in order."""
    rows = spark.range(90_010).select(
        F.when(F.col("id") < 60_000, "b1").when(F.col("id") < 90_000, "b2").otherwise("b3")
        .alias("batch_id"),
        F.when(F.col("id") < 90_000, "2024-01-31").otherwise("2024-02-01").alias("batch_date"),
        (F.when(F.col("id") < 60_000, F.col("id")).when(F.col("id") < 90_000, F.col("id") - 60_000)
         .otherwise(F.col("id") - 90_000) + 1).cast("int").alias("row_number"),
        F.lit("p").alias("provider"))
    timed = pipeline.serial_clock(rows)
    pipeline.require_one_order(timed)
    off = timed.filter(F.to_date("requested_at") != F.to_date("batch_date")).count()
    assert off == 0 and timed.select("requested_at").distinct().count() == 90_010


def call_in_turn(rows, limits, ladder):
    """Cache, exhausted pools, ceilings, breaker, call: row by row."""
    cached, dry, month, batch = set(), set(), {}, {}
    failures, until, decided = 0, None, {}
    for r in sorted(rows, key=lambda r: (r["batch_id"], r["row_number"])):
        place, kind, period = (r["batch_id"], r["row_number"]), r["call_kind"], r["batch_date"][:7]
        ceiling = limits.ceilings()[kind]
        if r["lookup_key"] in cached:
            decided[place] = "cached"
        elif (period, kind) in dry:
            decided[place] = "exhausted"
        elif ceiling is not None and month.get((period, kind), 0) >= ceiling:
            decided[place] = "month"
        elif limits.per_batch is not None and batch.get(r["batch_id"], 0) >= limits.per_batch:
            decided[place] = "cap"
        elif until is not None and until > r["requested_at"]:
            decided[place] = "breaker"
        else:
            decided[place] = "call"
            if r["http_status"] >= 500:
                failures += 1
                if failures >= ladder.breaker_threshold:
                    failures = 0
                    until = r["requested_at"] + dt.timedelta(
                        seconds=ladder.breaker_cooldown_seconds)
            else:
                failures, until = 0, None
            if r["http_status"] == 402:
                dry.add((period, kind))
            month[period, kind] = month.get((period, kind), 0) + r["credits"]
            batch[r["batch_id"]] = batch.get(r["batch_id"], 0) + r["credits"]
            if r["status"] in ("matched", "not_found", "ambiguous"):
                cached.add(r["lookup_key"])
    return decided


def label(row):
    if row["repeat"]:
        return "cached"
    if row["block"] is None:
        return "call"
    message = row["block"]["message"]
    return ("exhausted" if "HTTP 402" in message else "month" if "ceiling" in message
            else "cap" if "cap" in message else "breaker")


OUTCOMES = ("batch_id string, batch_date string, row_number int, provider string, call_kind string, "
            "lookup_key string, requested_at timestamp, http_status int, status string, credits int, "
            "raw_ref string")
STATUS = {200: "matched", 404: "not_found", 402: "budget_deferred"}
NO_OPENING = "provider string, month string, kind string, spent long"


def outcome(batch, day, number, kind, http, key, provider="p"):
    return {"batch_id": batch, "batch_date": day, "row_number": number, "provider": provider,
            "call_kind": kind, "lookup_key": key, "http_status": http,
            "requested_at": dt.datetime.fromisoformat(day) + dt.timedelta(seconds=number),
            "status": STATUS.get(http, "error"), "raw_ref": f"raw/{batch}/{number}",
            "credits": int(http == 200 or (kind == "identify" and http == 404))}


def in_turn_times(rows):
    """The moments of :func:`pipeline.serial_clock`, worked out in a loop."""
    start, timed = {}, []
    for batch in sorted({r["batch_id"] for r in rows}):
        own = [r for r in rows if r["batch_id"] == batch]
        day = own[0]["batch_date"]
        for r in own:
            at = dt.datetime.fromisoformat(day) + dt.timedelta(
                seconds=start.get(day, 0) + r["row_number"])
            timed.append(r | {"requested_at": at})
        start[day] = start.get(day, 0) + max(r["row_number"] for r in own)
    return timed


@pytest.mark.parametrize("window", [1 << 20, 90])
def test_rules_settle_as_in_turn(spark, window):
    # One provider for each seed, so that all seeds settle in one run; batches share days.
    limits, ladder = CreditLimits(enrich=14, identify=8, per_batch=6), LadderConfig(
        breaker_cooldown_seconds=12)
    seeds, rows = [], []
    for seed in range(8 if window > 1000 else 2):
        rng, own = random.Random(seed), []
        for b in range(6):
            for n in sorted(rng.sample(range(1, 60), 15)):
                kind = rng.choice(["enrich", "enrich", "identify"])
                http = rng.choice([200, 200, 404, 500, 500, 500, 402 if b == 4 else 200])
                own.append(outcome(f"s{seed:02d}-b{b}", f"2024-0{b // 3 + 1}-0{b % 3 // 2 + 1}", n,
                                   kind, http, f"{seed}-{kind}-{rng.randrange(25)}-{http}",
                                   f"p{seed}"))
        seeds.append(own)
        rows += own
    # Each seed is a provider with days of its own, as batches of one day run one after another.
    clocked = [pipeline.serial_clock(spark.createDataFrame(own, OUTCOMES)) for own in seeds]
    outcomes = clocked[0]
    for more in clocked[1:]:
        outcomes = outcomes.unionByName(more)
    # In one window, and in windows of a few batches, whose state goes on.
    counted = []
    settled = pipeline.settle_calls(outcomes, spark.createDataFrame([], NO_OPENING),
                                    pipeline.Settings(limits=limits, ladder=ladder), window,
                                    counted.append).collect()
    got = {(r["batch_id"], r["row_number"]): label(r) for r in settled}
    assert len(counted) > 1 and (window < 1000) == (counted[0] < len(rows))
    want = {}
    for own in seeds:
        want |= call_in_turn(in_turn_times(own), limits, ladder)
    assert got == want
    kinds = {"call", "cached", "exhausted", "month", "cap", "breaker"}
    assert kinds - set(got.values()) <= ({"month"} if window < 1000 else set())


def test_deep_interplay_takes_one_round_of_the_rules(spark, monkeypatch):
    # Caps, breaker and paid keys wait for one another in every few rows, over many stretches.
    monkeypatch.setattr(forecast, "STRETCH_BITS", 6)
    limits, ladder = CreditLimits(enrich=20, identify=12, per_batch=9), LadderConfig(
        breaker_threshold=2, breaker_cooldown_seconds=7)
    rng, rows = random.Random(5), []
    for b in range(10):
        rows += [outcome(f"b{b}", f"2024-0{b // 7 + 1}-0{b % 3 + 1}", n,
                         kind := rng.choice(["enrich", "enrich", "identify"]),
                         http := rng.choice([200, 404, 500, 500, 402 if b in (5, 9) else 200]),
                         f"{kind}-{rng.randrange(90)}-{http}") for n in range(1, 41)]
    rows = sorted(rows, key=lambda r: (r["batch_id"], r["row_number"]))
    for i, r in enumerate(rows):  # in the order of batches, a row each second
        at = dt.datetime(2024, 1 + (r["batch_id"] > "b6"), 1) + dt.timedelta(seconds=i)
        r |= {"batch_date": at.date().isoformat(), "requested_at": at}
    rounds, decide = [], pipeline._decide
    monkeypatch.setattr(pipeline, "_decide", lambda *a: (rounds.append(1), decide(*a))[1])
    settled = pipeline.settle_calls(
        spark.createDataFrame(rows, OUTCOMES), spark.createDataFrame([], NO_OPENING),
        pipeline.Settings(limits=limits, ladder=ladder)).collect()
    want = call_in_turn(rows, limits, ladder)
    assert {(r["batch_id"], r["row_number"]): label(r) for r in settled} == want
    assert set(want.values()) == {"call", "cached", "exhausted", "month", "cap", "breaker"}
    assert len(rounds) == 1


def test_two_orders_are_refused_and_serial_times_settle(spark):
    rows = [outcome("a", "2024-01-01", 1, "identify", 500, "k1"),
            outcome("a", "2024-01-01", 3, "identify", 500, "k2"),
            outcome("a", "2024-01-01", 4, "enrich", 200, "k3"),
            outcome("b", "2024-01-01", 2, "enrich", 200, "k4")]
    limits, ladder = CreditLimits(enrich=1), LadderConfig(breaker_threshold=2)
    settings = pipeline.Settings(limits=limits, ladder=ladder)
    outcomes, opening = spark.createDataFrame(rows, OUTCOMES), spark.createDataFrame([], NO_OPENING)
    with pytest.raises(ValueError, match="not in the order"):
        pipeline.settle_calls(outcomes, opening, settings)
    settled = pipeline.settle_calls(pipeline.serial_clock(outcomes), opening, settings).collect()
    assert {(r["batch_id"], r["row_number"]): label(r) for r in settled} == call_in_turn(
        in_turn_times(rows), limits, ladder)


def test_first_402_dries_its_pool(spark):
    at = dt.datetime(2024, 1, 1)
    calls = spark.createDataFrame(
        [("p", "2024-01", "enrich", at + dt.timedelta(seconds=i), i, s)
         for i, s in enumerate([200, 402, 200, 402])]
        + [("p", "2024-01", "identify", at, 9, 200)],
        "provider string, month string, kind string, requested_at timestamp, call_id long, "
        "http_status int")
    got = {r.call_id: r.message for r in credits.pool_exhausted(calls).collect()}
    assert got == {0: None, 1: None, 9: None,
                   2: "provider reported enrich credits exhausted (HTTP 402)",
                   3: "provider reported enrich credits exhausted (HTTP 402)"}
