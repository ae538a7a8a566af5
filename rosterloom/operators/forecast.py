"""A good guess at what happens to calls once all protective rules interact.

The rules (cache, exhausted pools, ceilings, cap, breaker) feed each other row by row.  Rounds over all
rows settle them from whatever decisions they start with, yet need as many rounds as the rules' interplay is
deep.  Here rows are cut into *stretches*, a bounded number of rows that follow one another.
Each stretch is walked row by row in a task of its own from the state it is believed to be entered
in; what it leaves is passed on to the stretches behind it, which are walked again until none decides
otherwise.  The first stretch is right after one walk and every walk settles one more at least; mostly a few
walks do, as a state (a month's spend, a breaker, the keys paid) is seldom swayed by what lies far back.

No provider's calls meet in one task.  The driver sees a state for each stretch: spend by provider,
month and kind, breakers by provider, and the spend of one batch.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.config import CreditLimits, LadderConfig
from rosterloom.session import cut_lineage, discard

#: Rows of a stretch at most (as a power of two).
STRETCH_BITS = 16
_PLACE = ["batch_id", "row_number"]
MICROS = 1_000_000


def _walk(calls: pa.Table, entry: dict, limits: CreditLimits,
          ladder: LadderConfig) -> tuple[list[str], dict]:
    """The decisions on calls in their order, and the state that they leave.

    State: ``spent`` and ``dry`` by (provider, month, kind), ``used`` by (provider, month, batch) for
    the last batch, ``breakers`` (failures, until) by provider.  ``paid`` tells keys paid before.
    """
    ceilings, threshold = limits.ceilings(), max(1, ladder.breaker_threshold)
    cooldown = max(0, ladder.breaker_cooldown_seconds) * MICROS
    spent, dry = dict(entry["spent"]), set(entry["dry"])
    used, breakers = dict(entry["used"]), dict(entry["breakers"])
    own, seen, keys, decisions = {}, set(), set(), []
    names = ["provider", "month", "batch_id", "kind", "lookup_key", "at", "http_status", "credits",
             "cacheable", "paid"]
    for provider, month, batch, kind, key, at, http, credits, cacheable, paid in zip(
            *[calls[n].to_pylist() for n in names], strict=True):
        pool, place = (provider, month, kind), (provider, month, batch)
        failures, until = breakers.get(provider, (0, 0))
        ceiling = ceilings.get(kind)
        if paid or key in keys:
            decision = "cached"
        elif pool in dry:
            decision = "exhausted"
        elif ceiling is not None and spent.get(pool, 0) >= ceiling:
            decision = "month"
        elif limits.per_batch is not None and used.get(place, 0) >= limits.per_batch:
            decision = "cap"
        else:
            seen.add(provider)
            decision = "breaker" if until > at else "call"
        decisions.append(decision)
        if decision != "call":
            continue
        if http is None or http >= 500:
            failures += 1
            if failures >= threshold:
                failures, until = 0, at + cooldown
            breakers[provider] = (failures, until)
        else:
            breakers[provider] = (0, 0)
            if http == 402:
                dry.add(pool)
        if credits:
            spent[pool] = spent.get(pool, 0) + credits
            own[pool] = own.get(pool, 0) + credits
            used[place] = used.get(place, 0) + credits
        if cacheable and key is not None:
            keys.add(key)
    last = calls["batch_id"][-1].as_py()
    return decisions, {
        "spent": sorted(own.items(), key=repr), "dry": sorted(dry - set(entry["dry"]), key=repr),
        "used": sorted(((k, v) for k, v in used.items() if k[2] == last), key=repr),
        "breakers": sorted(((p, breakers[p]) for p in seen if p in breakers), key=repr)}


def _tuples(pairs: list) -> dict:
    """Of JSON lists of pairs: keys and breaker states are tuples."""
    def frozen(x):
        return tuple(x) if isinstance(x, list) else x
    return {frozen(k): frozen(v) for k, v in pairs}


def _entries(before: dict, exits: dict[int, dict]) -> dict[int, dict]:
    """The state each stretch is entered in, from what the stretches before it leave."""
    entries, spent, dry = {}, dict(before["spent"]), set(before["dry"])
    breakers, used = dict(before["breakers"]), {}
    for number in sorted(exits):
        entries[number] = {"spent": dict(spent), "dry": set(dry), "used": used,
                           "breakers": dict(breakers)}
        left = exits[number]
        for pool, credits in _tuples(left["spent"]).items():
            spent[pool] = spent.get(pool, 0) + credits
        dry |= {tuple(p) for p in left["dry"]}
        breakers |= _tuples(left["breakers"])
        used = _tuples(left["used"])
    return entries


def forecast(rows: DataFrame, spent: DataFrame, dry: DataFrame, paid: DataFrame,
             breakers: DataFrame | None, limits: CreditLimits, ladder: LadderConfig,
             watch: Callable[[], None]) -> tuple[DataFrame, int]:
    """(rows with ``decision``, walks): what the rules decide on calls, mostly right.

    ``rows``: batch_id, row_number, provider, month, kind, lookup_key, requested_at, http_status,
    credits, cacheable.  The other tables are the state before: ``spent`` and ``dry`` by provider,
    month and kind, ``paid`` by lookup_key, ``breakers`` by provider.
    """
    pool = ["provider", "month", "kind"]
    before = {"spent": {tuple(r[:3]): r[3] for r in spent.select(*pool, "spent").collect()},
              "dry": {tuple(r) for r in dry.select(*pool).collect()},
              "breakers": {} if breakers is None else {
                  r[0]: (r[1], r[2]) for r in breakers.select("provider", "failures", "until")
                  .collect()}}
    number = F.shiftright(F.monotonically_increasing_id(), STRETCH_BITS)
    laid = cut_lineage(rows.repartitionByRange(*_PLACE).sortWithinPartitions(*_PLACE)
                       .withColumn("stretch", number)
                       .withColumn("at", F.coalesce(F.unix_micros("requested_at"),
                                                    F.lit(0).cast("long")))
                       .join(paid.select("lookup_key", F.lit(True).alias("held")).distinct(),
                             "lookup_key", "left"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in laid.schema
                          if f.name not in ("at", "held")),
                        "decision string", "leaves string"])
    base = [f.name for f in laid.schema if f.name not in ("at", "held")]
    empty = {n: [] for n in ("spent", "dry", "used", "breakers")}
    # The first walk starts everywhere from the state before.
    entries = _entries(before, {r[0]: empty for r in laid.select("stretch").distinct().collect()})
    decided, known, walks = None, None, 0

    def walker(entries: dict[int, dict]) -> Callable[[pa.Table], pa.Table]:
        def walked(group: pa.Table) -> pa.Table:
            calls = group.sort_by([(n, "ascending") for n in _PLACE])
            entry = entries[calls["stretch"][0].as_py()]
            decisions, left = _walk(calls, entry, limits, ladder)
            mark = zlib.crc32("".join(d[:2] for d in decisions).encode())
            leaves = [json.dumps(left | {"mark": mark}), *[None] * (len(decisions) - 1)]
            return (calls.select(base).append_column("decision", pa.array(decisions, pa.string()))
                    .append_column("leaves", pa.array(leaves, pa.string())))

        return walked

    while True:
        marked = laid
        if decided is None:
            marked = laid.withColumn("paid", F.coalesce("held", F.lit(False)))
        else:
            # Keys that a stretch before this one has paid; its own it finds itself.
            first = (decided.filter((F.col("decision") == "call") & F.col("cacheable"))
                     .groupBy("lookup_key").agg(F.min("stretch").alias("payer")))
            marked = laid.join(first, "lookup_key", "left").withColumn("paid", F.coalesce(
                F.col("held") | (F.col("payer") < F.col("stretch")), F.col("held"),
                F.col("payer") < F.col("stretch"), F.lit(False)))
        following = cut_lineage(marked.groupBy("stretch").applyInArrow(walker(entries), schema))
        walks += 1
        watch()
        if decided is not None:
            discard(decided)
        decided = following
        exits = {r["stretch"]: json.loads(r["leaves"]) for r in decided.filter(
            F.col("leaves").isNotNull()).select("stretch", "leaves").collect()}
        if exits == known or len(exits) == 1:
            discard(laid)
            return decided.drop("stretch", "leaves"), walks
        known, entries = exits, _entries(before, exits)
