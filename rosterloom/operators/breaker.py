"""The provider circuit breaker over recorded calls.

After ``threshold`` consecutive failures a provider is left alone for ``cooldown`` seconds;
calls in that time are skipped and change nothing, a success resets the count.

The rule is sequential per provider, yet one provider may hold most of the calls, even of an
hour, so its history is cut into slices of a bounded number of calls:

1. per slice, side by side: which state leaves the slice for each state that may enter it (its
   *moves*).  A state is a failure count or the moment the breaker closes again.  Closing moments
   up to the slice's last call fall into stretches with one exit each; later ones pass through;
2. moves of consecutive slices are composed, ``FAN`` at a time, in a tree, until one is left per
   provider: composition is associative, and stretches that lead to the same exit merge.  Only
   moments within one cooldown of a slice's first call can enter it, which bounds its moves;
3. from the top of the tree down each slice is told the state it is entered in;
4. per slice, side by side: the openings that follow from the known entry state.

The openings (a handful in each time bucket) are joined back to the calls natively.  Python sees
three narrow columns, and jumps from opening to opening instead of looping over rows.  A stream
does the same with every micro-batch, whose entry states are the last one's exits.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.session import cut_lineage

MICROS = 1_000_000
#: Calls of a slice (as a power of two), and slices whose moves are composed at once.
SLICE_BITS, FAN = 16, 32
_NODE = "provider string, slice long"
_MOVES = f"{_NODE}, first long, last long, bounds array<long>, failures array<int>, until array<long>"
_ENTRY = f"{_NODE}, entry_failures int, entry_until long"
_OPENINGS = "provider string, opened_at long, opened_id long, until long"
_STATE = "provider string, failures int, until long"
_MOVES_ARROW = pa.schema([
    ("provider", pa.string()), ("slice", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
    ("bounds", pa.list_(pa.int64())), ("failures", pa.list_(pa.int32())),
    ("until", pa.list_(pa.int64()))])
_ENTRY_ARROW = pa.schema([("provider", pa.string()), ("slice", pa.int64()),
                          ("entry_failures", pa.int32()), ("entry_until", pa.int64())])
_OPENINGS_ARROW = pa.schema([("provider", pa.string()), ("opened_at", pa.int64()),
                             ("opened_id", pa.int64()), ("until", pa.int64())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                    schema=schema)


class _Slice:
    """Times and failures of one slice in call order, with the jumps between openings."""

    def __init__(self, calls: pa.Table, threshold: int, cooldown: int) -> None:
        at, ids = calls["at"].to_numpy(), calls["call_id"].to_numpy()
        order = np.lexsort((ids, at))
        self.at, self.ids = at[order], ids[order]
        failed = calls["failed"].to_numpy()[order].astype(bool)
        self.threshold, self.cooldown, self.size = threshold, cooldown, len(failed)
        index = np.arange(self.size)
        last_success = np.maximum.accumulate(np.where(failed, -1, index))
        self.streak = index - last_success
        self.leading = int(np.argmin(failed)) if not failed.all() else self.size
        self.hot = np.flatnonzero(self.streak >= threshold)

    def opening(self, start: int, failures: int = 0) -> int:
        """Row that opens the breaker when calls resume at ``start``; ``size`` if none does."""
        if failures and start == 0 and self.leading >= self.threshold - failures:
            return self.threshold - failures - 1
        k = int(np.searchsorted(self.hot, start + self.threshold - 1))
        return int(self.hot[k]) if k < len(self.hot) else self.size

    def resume(self, until: int) -> int:
        return int(np.searchsorted(self.at, until, side="left"))

    def walk(self, failures: int, until: int) -> tuple[list[tuple[int, int, int]], int, int]:
        """Openings from an entry state, and the exit state."""
        opened = []
        start = self.resume(until)
        carried = failures if until == 0 else 0
        while start < self.size:
            row = self.opening(start, carried)
            if row == self.size:
                run = int(self.streak[-1])
                if start == 0 and run == self.size:
                    run += carried
                return opened, min(run, self.size - start + carried), 0
            until = int(self.at[row]) + self.cooldown
            opened.append((int(self.at[row]), int(self.ids[row]), until))
            start, carried = max(row + 1, self.resume(until)), 0
        return opened, carried if not self.size else 0, until


class Moves:
    """Where a stretch of one provider's calls leads, for each state that may enter it.

    ``closed`` has the exit of every failure count.  ``bounds`` are ascending closing moments: an
    entry that is open until u leaves by the exit of the last bound not above u, unless u lies
    behind the last call; then the breaker is still open until u.  A state is (failures, until).
    """

    def __init__(self, first: int, last: int, closed: list[tuple], bounds: list[int],
                 exits: list[tuple]) -> None:
        self.first, self.last, self.closed = first, last, closed
        self.bounds, self.exits = bounds, exits

    def leave(self, state: tuple[int, int]) -> tuple[int, int]:
        failures, until = state
        if until == 0:
            return self.closed[failures]
        if until > self.last:
            return state
        return self.exits[bisect_right(self.bounds, until) - 1]

    def then(self, other: Moves, cooldown: int) -> Moves:
        """Both, one after the other."""
        bounds, exits = list(self.bounds), [other.leave(e) for e in self.exits]
        # Moments that pass through the first part enter the second one as they are.
        limit = min(other.last, self.first + cooldown)
        if limit > self.last:
            low = bisect_right(other.bounds, self.last + 1) - 1
            high = bisect_right(other.bounds, limit)
            bounds += [self.last + 1, *other.bounds[low + 1:high]]
            exits += other.exits[low:high]
        return Moves(self.first, other.last, [other.leave(e) for e in self.closed],
                     *_merged(bounds, exits))

    def row(self, provider: str, number: int) -> tuple:
        states = [*self.closed, *self.exits]
        return (provider, number, self.first, self.last, self.bounds,
                [f for f, _ in states], [u for _, u in states])


def _moves(row: dict) -> Moves:
    states = list(zip(row["failures"], row["until"], strict=True))
    closed = len(states) - len(row["bounds"])
    return Moves(row["first"], row["last"], states[:closed], row["bounds"], states[closed:])


def _merged(bounds: list[int], exits: list[tuple]) -> tuple[list[int], list[tuple]]:
    """Without bounds at which the exit stays the same."""
    kept = [i for i in range(len(exits)) if i == 0 or exits[i] != exits[i - 1]]
    return [bounds[i] for i in kept], [exits[i] for i in kept]


def _slice_moves(part: _Slice) -> Moves:
    closed = [part.walk(failures, 0)[1:] for failures in range(part.threshold)]
    bounds, exits = [], []
    known: dict[int, tuple[int, int]] = {}
    # Closing moments between the same two calls resume at the same one.
    limit = int(np.searchsorted(part.at, part.at[0] + part.cooldown, side="left"))
    for start in range(min(limit, part.size - 1) + 1):
        if start and part.at[start] == part.at[start - 1]:
            continue  # calls resume at the first of several at one moment
        opens = part.opening(start)
        if opens == part.size:
            here = (min(int(part.streak[-1]), part.size - start), 0)
        else:
            if opens not in known:
                known[opens] = part.walk(0, int(part.at[start]))[1:]
            here = known[opens]
        bounds.append(int(part.at[start - 1]) + 1 if start else 0)
        exits.append(here)
    return Moves(int(part.at[0]), int(part.at[-1]), closed, *_merged(bounds, exits))


def find_openings(calls: DataFrame, entry: DataFrame | None, threshold: int,
                  cooldown: int) -> tuple[DataFrame, DataFrame]:
    """(openings, states): when the breaker opened, and each provider's state after all calls.

    ``entry`` (provider, failures, until) are the states before, by default closed.  Providers
    without calls are not in ``states``.  Times are in microseconds.
    """
    def laid_moves(calls: pa.Table) -> pa.Table:
        part = _Slice(calls, threshold, cooldown)
        row = _slice_moves(part).row(calls["provider"][0].as_py(), calls["slice"][0].as_py())
        return _table([row], _MOVES_ARROW)

    def composed(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["slice"])
        moves = _moves(rows[0])
        for row in rows[1:]:
            moves = moves.then(_moves(row), cooldown)
        return _table([moves.row(rows[0]["provider"], rows[0]["slice"] // FAN)], _MOVES_ARROW)

    def told(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["slice"])
        state, out = (rows[0]["entry_failures"], rows[0]["entry_until"]), []
        for row in rows:
            out.append((row["provider"], row["slice"], *state))
            state = _moves(row).leave(state)
        return _table(out, _ENTRY_ARROW)

    def openings(calls: pa.Table) -> pa.Table:
        part = _Slice(calls, threshold, cooldown)
        opened = part.walk(calls["entry_failures"][0].as_py(), calls["entry_until"][0].as_py())[0]
        return _table([(calls["provider"][0].as_py(), *o) for o in opened], _OPENINGS_ARROW)

    # Ranges of time cut a provider wherever a task has enough calls; numbers follow time.
    keys = ["provider", "at", "call_id"]
    number = F.shiftright(F.monotonically_increasing_id(), SLICE_BITS)
    laid = cut_lineage(calls.repartitionByRange(*keys).sortWithinPartitions(*keys)
                       .withColumn("slice", number))
    # Slices are numbered from 0 in each provider, through one small row a slice.
    order = Window.partitionBy("provider").orderBy("slice")
    numbers = cut_lineage(laid.select("provider", "slice").distinct().select(
        "provider", "slice", (F.row_number().over(order) - 1).cast("long").alias("number")))
    placed = laid.join(numbers, ["provider", "slice"]).select(
        "provider", F.col("number").alias("slice"), "at", "call_id", "failed")
    levels = [cut_lineage(placed.groupBy("provider", "slice").applyInArrow(laid_moves, _MOVES))]
    while not levels[-1].filter("slice > 0").isEmpty():
        above = F.floor(F.col("slice") / FAN).alias("above")
        levels.append(cut_lineage(levels[-1].groupBy("provider", above)
                                  .applyInArrow(composed, _MOVES)))
    known = levels[-1].select("provider", "slice")
    if entry is None:
        known = known.withColumns({"entry_failures": F.lit(0), "entry_until": F.lit(0).cast("long")})
    else:
        known = known.join(entry, "provider", "left").select(
            "provider", "slice", F.coalesce("failures", F.lit(0)).alias("entry_failures"),
            F.coalesce("until", F.lit(0)).cast("long").alias("entry_until"))
    known = cut_lineage(known)
    top = levels[-1].join(known, ["provider", "slice"])

    def left(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        return _table([(r["provider"], *_moves(r).leave((r["entry_failures"], r["entry_until"])))
                       for r in rows], _STATE_ARROW)

    states = top.groupBy("provider").applyInArrow(left, _STATE)
    for level in reversed(levels[:-1]):
        below = level.withColumn("above", F.floor(F.col("slice") / FAN)).join(
            known.withColumnRenamed("slice", "above"), ["provider", "above"])
        known = cut_lineage(below.groupBy("provider", "above").applyInArrow(told, _ENTRY))
    found = (placed.join(known, ["provider", "slice"])
             .groupBy("provider", "slice").applyInArrow(openings, _OPENINGS))
    return found, states


_STATE_ARROW = pa.schema([("provider", pa.string()), ("failures", pa.int32()),
                          ("until", pa.int64())])


def narrowed(calls: DataFrame) -> DataFrame:
    """What the rule needs of calls: provider, call_id, at (microseconds), failed."""
    return calls.select("provider", F.col("call_id").cast("long").alias("call_id"),
                        F.unix_micros("requested_at").alias("at"),
                        F.coalesce("failed", F.lit(False)).alias("failed"))


def decided_by(calls: DataFrame, openings: DataFrame, cooldown: int, bucket: int) -> DataFrame:
    """Adds ``skipped`` and ``open_until`` to calls: those behind an opening, until it ends."""
    width = max(bucket, cooldown, 1)
    # An opening reaches into two buckets at most, and a bucket holds few: they lie a cooldown
    # apart, apart from those that close at once.
    number = F.explode(F.sequence(F.floor(F.col("opened_at") / width),
                                  F.floor(F.col("until") / width)))
    listed = (openings.filter("until > opened_at").withColumn("bucket", number)
              .groupBy("provider", "bucket").agg(F.collect_list(
                  F.struct("opened_at", "opened_id", "until")).alias("openings")))
    marked = (calls.withColumn("_at", F.unix_micros("requested_at"))
              .withColumn("bucket", F.floor(F.col("_at") / width))
              .join(listed, ["provider", "bucket"], "left"))
    moment = F.struct("_at", F.col("call_id").cast("long"))
    covering = F.filter("openings", lambda o: (moment > F.struct(o["opened_at"], o["opened_id"]))
                        & (F.col("_at") < o["until"]))
    until = F.array_max(F.transform(covering, lambda o: o["until"]))
    return marked.select(*calls.columns, until.isNotNull().alias("skipped"),
                         F.timestamp_micros(until).alias("open_until"))


def circuit_breaker(calls: DataFrame, threshold: int = 3, cooldown_seconds: int = 300,
                    slice_seconds: int = 3600) -> DataFrame:
    """Adds ``skipped`` and ``open_until`` to calls (provider, call_id, requested_at, failed).

    ``slice_seconds`` is the width of the time buckets in which openings meet their calls.
    """
    cooldown = max(0, cooldown_seconds) * MICROS
    openings, _ = find_openings(narrowed(calls), None, max(1, threshold), cooldown)
    return decided_by(calls, openings, cooldown, slice_seconds * MICROS)


def continued(calls: DataFrame, entry: DataFrame | None, threshold: int = 3,
              cooldown_seconds: int = 300,
              slice_seconds: int = 3600) -> tuple[DataFrame, DataFrame]:
    """(decided calls, states after them) from the states (provider, failures, until) before."""
    cooldown = max(0, cooldown_seconds) * MICROS
    openings, states = find_openings(narrowed(calls), entry, max(1, threshold), cooldown)
    if entry is not None:
        # A breaker that was open before covers calls like an opening in front of them all.
        openings = openings.unionByName(entry.filter("until > 0").select(
            "provider", (F.col("until") - cooldown).alias("opened_at"),
            F.lit(-(1 << 63)).cast("long").alias("opened_id"), "until"))
        states = states.unionByName(entry.join(states, "provider", "left_anti"))
    return decided_by(calls, openings, cooldown, slice_seconds * MICROS), states


def unavailable_message(open_until: Column) -> Column:
    return F.concat(
        F.lit("provider circuit breaker open after consecutive failures; skipped without a "
              "call, retry after "), F.date_format(open_until, "yyyy-MM-dd HH:mm:ss"),
        F.lit(" UTC"))
