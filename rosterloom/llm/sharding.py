"""Sharding by balanced label propagation, in DataFrame operations only.

Links are rows (member, hub): documents that share a hub are linked, so a group costs a row for
each document and never a row for each pair.  Every linked document starts in a shard dealt by
hash.  Then, in turns,

1. a hub looks at the shards of its members and names the one that holds most of them,
2. a document wants to move to the shard that most of its hubs' members are in,
3. moves from shard i to shard j are granted up to a quota: as many as want to move from j to i,
   plus a share of the room that j has left below its capacity,

until no edge is cut, or the edges cut don't get fewer; the best state counts.  Then every shard gets
its exact count: groups are placed whole, those a shard has no place for in others with room, and
the unlinked documents fill up (see :func:`settle`).

The law is ``rows``: document counts of any two shards differ by one at most.  A hub larger than a
part of a shard is split beforehand by the hash of its members, for it can't stay whole anyway.
Ranks are dealt by hash buckets (see :func:`deal_ranks`), so neither a hub with a third of all rows
nor a shard is one task's work.

Null texts are in no group.  Repeated rows are documents of their own, in one group with their
copies.  Documents without an id are placed like others.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterloom.llm.common import deal_ranks, deal_sums, read
from rosterloom.session import cut_lineage

SHARDS = 40
TURNS = 8
#: A hub is split into parts of at most about this share of a shard.
LARGEST_PART = 0.5


def _capacity(shard: Column, total: int, shards: int) -> Column:
    """How many documents a shard holds under the law ``rows``."""
    return F.lit(total // shards).cast("long") + (shard < total % shards).cast("long")


def split_hubs(links: DataFrame, largest: int) -> DataFrame:
    """Links without hubs of one member, large hubs split into parts by their members' hashes."""
    sizes = links.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(largest)).cast("long")
    return (links.join(sizes, "hub")
            .select("member", F.xxhash64("hub", F.pmod(F.xxhash64("member"), parts)).alias("hub")))


def _start(members: DataFrame, shards: int) -> DataFrame:
    return members.select("member", F.pmod(F.xxhash64("member", F.lit("start")), F.lit(shards))
                          .cast("int").alias("shard"))


def _cut(counts: DataFrame) -> int:
    """Links between a hub's members in other shards than the one with most of them."""
    row = counts.groupBy("hub").agg((F.sum("n") - F.max("n")).alias("away")).agg(
        F.sum("away")).first()
    return int(row[0] or 0)


def propagate(links: DataFrame, total: int, shards: int = SHARDS, turns: int = TURNS) -> DataFrame:
    """Shards (member, shard) of the linked members; ``links`` is a stored table."""
    state = best = cut_lineage(_start(links.select("member").distinct(), shards))
    least = None
    for turn in range(turns + 1):
        counts = cut_lineage(links.join(state, "member").groupBy("hub", "shard").agg(
            F.count("*").alias("n")))
        cut = _cut(counts)
        if least is not None and cut >= least:
            break
        least, best = cut, state
        if cut == 0 or turn == turns:
            break
        # Ties go by a hash, so that not all hubs prefer the same shards.
        favourite = counts.groupBy("hub").agg(F.max(F.struct(
            "n", F.xxhash64("hub", "shard").alias("tie"), "shard")).alias("top")).select(
            "hub", F.col("top.shard").alias("wanted"), F.col("top.n").alias("n"))
        votes = links.join(favourite, "hub").groupBy("member", "wanted").agg(
            F.sum("n").alias("n"))
        wishes = (votes.groupBy("member").agg(F.max(F.struct(
                      "n", (-F.col("wanted")).alias("low"))).alias("top"))
                  .select("member", (-F.col("top.low")).alias("wanted"))
                  .join(state, "member").where("wanted <> shard"))
        wishes = cut_lineage(wishes)
        # At most shards * shards rows.
        asked = wishes.groupBy("shard", "wanted").agg(F.count("*").alias("n"))
        held = state.groupBy("shard").agg(F.count("*").alias("held"))
        back = asked.select(F.col("shard").alias("wanted"), F.col("wanted").alias("shard"),
                            F.col("n").alias("back"))
        room = F.greatest(_capacity(F.col("wanted"), total, shards)
                          - F.coalesce("held", F.lit(0)), F.lit(0))
        into = Window.partitionBy("wanted")
        quota = (asked.join(back, ["shard", "wanted"], "left")
                 .join(held.withColumnRenamed("shard", "wanted"), "wanted", "left")
                 .withColumn("even", F.least("n", F.coalesce("back", F.lit(0))))
                 .withColumn("more", F.col("n") - F.col("even"))
                 .withColumn("quota", (F.col("even") + F.floor(F.when(
                     F.sum("more").over(into) <= room, F.col("more")).otherwise(
                     room * F.col("more") / F.greatest(F.sum("more").over(into), F.lit(1)))))
                     .cast("long"))
                 .select("shard", "wanted", "quota"))
        moved = (deal_ranks(wishes, ["shard", "wanted"], [F.col("member")], "rank")
                 .join(F.broadcast(quota), ["shard", "wanted"]).where("rank < quota")
                 .select("member", F.col("wanted").alias("to")))
        state = cut_lineage(state.join(moved, "member", "left").select(
            "member", F.coalesce("to", "shard").cast("int").alias("shard")))
    return best


def settle(members: DataFrame, total: int, shards: int = SHARDS) -> DataFrame:
    """Adds ``shard`` under the law ``rows``.

    ``members`` is a stored table with member, hub (null if unlinked) and wish (null if unlinked).
    Groups are placed whole: first in the shard that most of their members wish for, as many as
    fit; then along the line of the rooms that are left, where a group that lies across the end of a
    room (at most one for each end) goes to any other room that holds it.  Only one that
    fits nowhere is split.  Last, unlinked rows fill the shards.
    """
    linked = members.where("wish is not null")
    wishes = linked.groupBy("hub", "wish").agg(F.count("*").alias("n"))
    groups = cut_lineage(wishes.groupBy("hub").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "wish")).alias("top")).select(
        "hub", F.col("n"), F.col("top.wish").alias("home")))
    at_home = deal_sums(groups, ["home"], F.col("n"), [F.col("hub")], "before")
    at_home = cut_lineage(at_home.withColumn("stays", F.col("before") + F.col("n")
                                             <= _capacity(F.col("home"), total, shards)))
    # One row for each shard comes to the driver.
    held = {r["home"]: r["n"] for r in at_home.where("stays").groupBy("home").agg(
        F.sum("n").alias("n")).collect()}
    rooms = [total // shards + (s < total % shards) - held.get(s, 0) for s in range(shards)]
    ends = _ends(rooms)
    others = cut_lineage(at_home.where("not stays").select(
        "hub", "n", F.lit(0).alias("all")))
    line = deal_sums(others, ["all"], F.col("n"), [F.col("hub")], "before").withColumns({
        "shard": _room(ends, F.col("before")),
        "last": _room(ends, F.col("before") + F.col("n") - 1)})
    line = cut_lineage(line.withColumn("whole", F.col("shard") == F.col("last")))
    for row in line.where("whole").groupBy("shard").agg(F.sum("n").alias("n")).collect():
        rooms[row["shard"]] -= row["n"]
    # No more groups than rooms have ends.
    cuts = _fit([(r["hub"], r["n"]) for r in line.where("not whole").select("hub", "n").collect()],
                rooms)
    homes = at_home.where("stays").select("hub", F.col("home").alias("shard")).unionByName(
        line.where("whole").select("hub", "shard"))
    placed = linked.select("member", "hub").join(homes, "hub").select("member", "shard")
    if cuts:
        hubs = sorted({hub for hub, _, _ in cuts})
        across = cut_lineage(linked.where(F.col("hub").isin(hubs)).select("member", "hub"))
        ranked = deal_ranks(across, ["hub"], [F.col("member")], "rank")
        shard = F.coalesce(*[F.when((F.col("hub") == hub) & (F.col("rank") < end), to)
                             for hub, end, to in cuts])
        placed = placed.unionByName(ranked.select("member", shard.alias("shard")))
    ends = _ends(rooms)
    filling = cut_lineage(members.where("wish is null").select("member", F.lit(0).alias("all")))
    ranked = deal_ranks(filling, ["all"], [F.col("member")], "rank")
    return placed.unionByName(ranked.select("member", _room(ends, F.col("rank")).alias("shard")))


def _ends(rooms: list[int]) -> list[int]:
    """Where each shard's room ends when the rooms lie one after the other."""
    return list(accumulate(rooms))


def _room(ends: list[int], place: Column) -> Column:
    """The shard in whose room a place of the line lies."""
    return F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]),
                           lambda e: e <= place)).cast("int")


def _fit(groups: list[tuple[int, int]], rooms: list[int]) -> list[tuple[int, int, int]]:
    """Rooms for a few groups: (hub, ranks below this and above the entry before, shard).

    The largest group first, in the smallest room that holds it, else over the largest
    rooms.  Takes the places from ``rooms``.
    """
    cuts = []
    for hub, n in sorted(groups, key=lambda g: (-g[1], g[0])):
        done = 0
        while done < n:
            fitting = [s for s, room in enumerate(rooms) if room >= n - done]
            to = (min(fitting, key=lambda s: rooms[s]) if fitting
                  else max(range(len(rooms)), key=lambda s: rooms[s]))
            taken = min(rooms[to], n - done)
            rooms[to] -= taken
            done += taken
            cuts.append((hub, done, to))
    return cuts


def shard_documents(docs: DataFrame, group: Column, keep: list[str], shards: int = SHARDS,
                    turns: int = TURNS) -> DataFrame:
    """The kept columns of every row with ``shard`` and ``slot``, linked rows near each other.

    ``group`` is a column whose equal values link rows; null links nothing.
    """
    rows = cut_lineage(docs.select(*keep, group.alias("__group")).withColumn(
        "__member", F.monotonically_increasing_id()))
    total = rows.count()
    links = split_hubs(rows.where("__group is not null")
                       .select(F.col("__member").alias("member"), F.col("__group").alias("hub")),
                       max(2, int(total / shards * LARGEST_PART)))
    links = cut_lineage(links)
    state = propagate(links, total, shards, turns)
    hubs = links.groupBy("member").agg(F.min("hub").alias("hub"))
    members = cut_lineage(rows.select(F.col("__member").alias("member")).join(hubs, "member", "left").join(
        state.withColumnRenamed("shard", "wish"), "member", "left"))
    placed = cut_lineage(settle(members, total, shards))
    slots = deal_ranks(placed, ["shard"], [F.col("member")], "slot")
    return rows.join(slots.withColumnRenamed("member", "__member"), "__member").select(
        *keep, "shard", "slot")


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.sha2("text", 256).alias("digest"))
    placed = shard_documents(docs, F.col("digest"), ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))
