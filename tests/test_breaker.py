"""The sliced breaker against a plain sequential walk."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from rosterloom.operators import breaker
from rosterloom.operators.breaker import circuit_breaker
from rosterloom.streaming import jobs

SCHEMA = "provider string, call_id long, requested_at timestamp, failed boolean"


def walk(rows, threshold, cooldown):
    decided, states = {}, {}
    for provider, call, at, failed in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        failures, until = states.get(provider, (0, None))
        if until is not None and until > at:
            decided[provider, call] = (True, until)
            continue
        if not failed:
            failures, until = 0, None
        elif failures + 1 >= threshold:
            failures, until = 0, at + dt.timedelta(seconds=cooldown)
        else:
            failures += 1
        states[provider] = (failures, until)
        decided[provider, call] = (False, None)
    return decided


@pytest.mark.parametrize("seed", range(3))
def test_slices_agree_with_a_walk(spark, monkeypatch, seed):
    # Slices of 32 calls, composed three at a time: four levels.
    monkeypatch.setattr(breaker, "SLICE_BITS", 5)
    monkeypatch.setattr(breaker, "FAN", 3)
    rng = random.Random(seed)
    rows = []
    for provider in ("a", "b"):
        at, failing = dt.datetime(2024, 1, 1), 0.5
        for call in range(800):
            at += dt.timedelta(seconds=rng.choice([0, 0.5, 3, 20, 200]) * rng.random())
            if call % 100 == 0:
                failing = rng.choice([0.05, 0.5, 0.97, 1.0])
            rows.append((provider, call, at, rng.random() < failing))
    threshold, cooldown = rng.choice([1, 2, 3, 4]), rng.choice([0, 60, 300])
    width = rng.choice([60, 300, 900])
    calls = spark.createDataFrame(rows, SCHEMA)
    got = {(r.provider, r.call_id): (r.skipped, r.open_until)
           for r in circuit_breaker(calls, threshold, cooldown, width).collect()}
    assert got == walk(rows, threshold, cooldown)


def made(rng, calls, failing):
    at = dt.datetime(2024, 1, 1)
    rows = []
    for call in range(calls):
        at += dt.timedelta(microseconds=rng.randrange(7000))
        rows.append(("only", call, at, rng.random() < failing))
    return rows


@pytest.mark.parametrize("failing", [0.5, 1.0])
def test_a_million_calls_of_one_provider_in_an_hour(spark, failing):
    rng = spark.range(1_000_000, numPartitions=16)
    at = F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 3600)
    failed = F.pmod(F.xxhash64("id"), F.lit(1000)) < int(failing * 1000)
    calls = rng.select(F.lit("only").alias("provider"), F.col("id").alias("call_id"),
                       at.alias("requested_at"), failed.alias("failed"))
    rows = [tuple(r) for r in calls.collect()]
    want = walk(rows, 3, 20)
    wanted = sorted((c, u) for (_, c), (skipped, u) in want.items() if skipped)
    got = sorted((r.call_id, r.open_until) for r in circuit_breaker(calls, 3, 20, 300).filter(
        "skipped").select("call_id", "open_until").collect())
    assert got == wanted and len(got) > 100_000


def test_a_stream_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(breaker, "SLICE_BITS", 5)
    rng = random.Random(9)
    rows = sorted(made(rng, 600, 0.6) + [("other", 10_000 + i, dt.datetime(2024, 1, 1) + dt.timedelta(
        seconds=i / 100), i % 5 > 0) for i in range(200)], key=lambda r: r[2])
    source, target, state = (str(tmp_path / n) for n in ("calls", "out", "state"))
    for low in range(0, 800, 200):
        spark.createDataFrame(rows[low:low + 200], SCHEMA).coalesce(1).write.mode(
            "append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        jobs.breaker_stream(stream, target, state, 3, 1).awaitTermination()
    got = spark.read.parquet(f"{target}/decisions").collect()
    assert {(r.provider, r.call_id): (r.skipped, r.open_until) for r in got} == walk(rows, 3, 1)
    assert spark.read.parquet(f"{target}/states").select("epoch").distinct().count() == 4


def test_opens_after_three_failures_and_closes_on_time(spark):
    at = dt.datetime(2024, 1, 1, 12)
    steps = [(0, True), (1, True), (2, True), (3, False), (301, True), (302, True), (303, False)]
    calls = spark.createDataFrame(
        [("p", i, at + dt.timedelta(seconds=s), f) for i, (s, f) in enumerate(steps)],
        "provider string, call_id long, requested_at timestamp, failed boolean")
    got = [r.skipped for r in circuit_breaker(calls, 3, 300).orderBy("call_id").collect()]
    assert got == [False, False, False, True, True, False, False]
