"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

1. Documents become token ids with an end token; longer ones are cut into pieces of full length,
   of which only the first may be shorter.
2. Pieces of one length are interchangeable, so the packing problem of any corpus is a histogram
   with one count for each length: at most ``CAPACITY`` rows, whatever the size of the corpus.
   A solution is a set of *groups* of equal bins: the lengths in the bin, and how many such bins.
3. Islands, one task each, evolve populations of solutions.  Crossover injects whole well-filled
   bins of one parent into the other, removes the receiver's bins that hold an item twice, and
   best-fits the displaced items; mutation empties badly filled bins.  After every epoch the
   islands' elites migrate to the next island; the population is a table in the shared folder.
4. The pieces of each length are ranked without one task per length, and the best solution's
   groups say at which ranks which bin and offset begin.

Null and empty texts are the end token alone.  Repeated rows are packed each.  Ties between
pieces of equal length are broken by their other columns.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import json
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.common import deal_ranks, read, slices
from rosterloom.session import cut_lineage

CAPACITY = 1024
END = 2
ISLANDS, POPULATION, EPOCHS, GENERATIONS = 6, 6, 3, 5
SEED = 11
SLICE_BYTES = 2_000_000

#: Bins of a solution: the lengths inside, longest first, and how many bins are like that.
Bins = dict[tuple[int, ...], int]


# ------------------------------------------------------------------ tokens

class Tokenizer:
    """Ids of the byte-level vocabulary.

    ``ranks`` is the vocabulary as ranks for the faster library, ``full`` the same vocabulary
    for the library ``tokenizers``; both give the same ids (tested).  The second takes over
    for texts that the first one can't split, such as endless runs of white space.
    """

    def __init__(self, ranks: str | None = None, full: str | None = None) -> None:
        import public_tokenizers
        import tiktoken

        self._full_path = full or public_tokenizers.path("byte_bpe_50k.json")
        self._full = None
        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=merges, special_tokens={})

    def ids(self, text: str) -> list[int]:
        try:
            return self._fast.encode_ordinary(text)
        except BaseException as problem:  # a panic of the library is no Exception
            if isinstance(problem, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return self.full_ids(text)

    def full_ids(self, text: str) -> list[int]:
        if self._full is None:
            from tokenizers import Tokenizer as Full
            self._full = Full.from_file(self._full_path)
            self._full.encode_special_tokens = True
        return self._full.encode(text, add_special_tokens=False).ids


def pieces(docs: DataFrame, keep: list[str], text: str = "text", with_ids: bool = False,
           capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: the kept columns, piece, start, length, ids_crc32 (and ids)."""
    chosen = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                         F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer()
        for part in slices(batches, "text", SLICE_BYTES):
            source, number, start, length, check, own = [], [], [], [], [], []
            for row, text_ in enumerate(part.column(len(keep)).to_pylist()):
                ids = np.array([*tokenizer.ids(text_ or ""), END], dtype="<u4")
                first = (len(ids) - 1) % capacity + 1
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for k in range(len(edges) - 1):
                    cut = ids[edges[k]:edges[k + 1]]
                    source.append(row)
                    number.append(k)
                    start.append(edges[k])
                    length.append(len(cut))
                    check.append(zlib.crc32(cut.tobytes()))
                    if with_ids:
                        own.append(cut.astype(np.int32))
            columns = [c.take(pa.array(source, pa.int32())) for c in part.columns[:len(keep)]]
            columns += [pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(check, pa.int64())]
            names = [*part.schema.names[:len(keep)], "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(own, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "".join(f"k{i} {f.dataType.simpleString()}, "
                     for i, f in enumerate(chosen.schema.fields[:-1]))
    done = chosen.mapInArrow(run, schema + "piece int, start bigint, length bigint, "
                                           "ids_crc32 bigint" + ", ids array<int>" * with_ids)
    return done.withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})


# ------------------------------------------------------------------ solutions

class Packing:
    """Open bins in groups, found by their free room."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.rooms: list[Bins] = [{} for _ in range(capacity + 1)]
        self.open = 0  # bit r: some bins have room r

    def add(self, lengths: tuple[int, ...], count: int) -> None:
        room = self.capacity - sum(lengths)
        group = self.rooms[room]
        group[lengths] = group.get(lengths, 0) + count
        self.open |= 1 << room

    def best_fit(self, length: int, count: int) -> None:
        """Puts items into the bins with the least sufficient room, all equal bins at once."""
        while count:
            fitting = self.open >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                group = self.rooms[room]
                lengths, bins = group.popitem()
                if not group:
                    self.open &= ~(1 << room)
            else:
                room, lengths, bins = self.capacity, (), count
            copies = min(room // length, count)
            filled = min(bins, count // copies)
            if lengths and bins > filled:
                self.add(lengths, bins - filled)
            self.add(tuple(sorted(lengths + (length,) * copies, reverse=True)), filled)
            count -= copies * filled

    def bins(self) -> Bins:
        return {lengths: n for group in self.rooms for lengths, n in group.items()}


def fill(items: dict[int, int], capacity: int, bins: Bins | None = None,
         draw: random.Random | None = None) -> Bins:
    """Best-fit decreasing of items, into given bins first; ``draw`` disturbs the order."""
    packing = Packing(capacity)
    for lengths, n in (bins or {}).items():
        packing.add(lengths, n)
    order = [(length, n) for length, n in items.items() if n > 0]
    if draw:
        spread = capacity * draw.choice([0.02, 0.05, 0.1])
        order.sort(key=lambda x: -x[0] + draw.uniform(-spread, spread))
    else:
        order.sort(reverse=True)
    for length, n in order:
        packing.best_fit(length, n)
    return packing.bins()


def fitness(bins: Bins, capacity: int) -> tuple[int, float]:
    """Fewer bins first; of equal numbers the one whose bins are filled more unevenly."""
    return (sum(bins.values()),
            -sum(n * (sum(p) / capacity) ** 2 for p, n in bins.items()))


def _use(left: dict[int, int], lengths: tuple[int, ...], wanted: int) -> int:
    """Takes the items of up to ``wanted`` bins out of ``left``; returns how many bins."""
    need: dict[int, int] = {}
    for length in lengths:
        need[length] = need.get(length, 0) + 1
    taken = min([wanted, *(left.get(k, 0) // n for k, n in need.items())])
    if taken:
        for k, n in need.items():
            left[k] -= n * taken
    return taken


def crossover(receiver: Bins, donor: Bins, items: dict[int, int], capacity: int,
              draw: random.Random) -> Bins:
    """Whole well-filled bins of the donor, then what the receiver still can keep whole, then
    the displaced items by best fit."""
    left, child = dict(items), {}
    good = sorted(donor, key=lambda p: (-sum(p), p))
    for lengths in good[:max(1, int(len(good) * draw.uniform(0.2, 0.8)))]:
        if draw.random() < 0.7:
            taken = _use(left, lengths, max(1, int(donor[lengths] * draw.random())))
            if taken:
                child[lengths] = child.get(lengths, 0) + taken
    for lengths in sorted(receiver, key=lambda p: (-sum(p), p)):
        taken = _use(left, lengths, receiver[lengths])
        if taken:
            child[lengths] = child.get(lengths, 0) + taken
    return fill(left, capacity, child)


def mutate(bins: Bins, items: dict[int, int], capacity: int, draw: random.Random) -> Bins:
    """Empties the worst-filled bins and some others, and packs their items anew."""
    left, kept = dict(items), {}
    order = sorted(bins, key=lambda p: (-sum(p), p))
    worst = set(order[int(len(order) * draw.uniform(0.6, 0.95)):])
    for lengths in order:
        n = 0 if lengths in worst or draw.random() < 0.1 else bins[lengths]
        taken = _use(left, lengths, n)
        if taken:
            kept[lengths] = taken
    return fill(left, capacity, kept, draw)


def evolve(population: list[Bins], items: dict[int, int], capacity: int, generations: int,
           draw: random.Random) -> list[Bins]:
    """The population after some generations, best first."""
    least = -(-sum(k * n for k, n in items.items()) // capacity)
    size = len(population)

    def rank(bins: Bins) -> tuple[int, float]:
        return fitness(bins, capacity)

    population = sorted(population, key=rank)
    for _ in range(generations):
        if rank(population[0])[0] <= least:
            break
        children = []
        for _ in range(size):
            a, b = (min(draw.sample(population, min(2, size)), key=rank) for _ in range(2))
            child = crossover(a, b, items, capacity, draw)
            if draw.random() < 0.5:
                child = mutate(child, items, capacity, draw)
            children.append(child)
        population = sorted(population + children, key=rank)[:size]
    return population


def _written(bins: Bins) -> str:
    return json.dumps([[n, p] for p, n in sorted(bins.items())])


def _read(text: str) -> Bins:
    return {tuple(p): n for n, p in json.loads(text)}


def solve(spark: SparkSession, items: dict[int, int], capacity: int = CAPACITY,
          islands: int = ISLANDS, population: int = POPULATION, epochs: int = EPOCHS,
          generations: int = GENERATIONS) -> Bins:
    """The best bins that the islands find for a histogram of lengths."""
    if not items:
        return {}
    items = dict(sorted(items.items()))  # draws go by this order

    def step(epoch: int):
        def run(table: pa.Table) -> pa.Table:
            island = table.column("island")[0].as_py()
            draw = random.Random(f"{SEED} {epoch} {island}")
            members = [_read(x) for x in table.column("bins").to_pylist() if x]
            while len(members) < population:
                members.append(fill(items, capacity,
                                    draw=draw if members or island else None))
            members = evolve(sorted(members, key=lambda m: fitness(m, capacity))[:population],
                             items, capacity, generations, draw)
            ranks = [fitness(m, capacity) for m in members]
            return pa.table({"island": pa.array([island] * len(members), pa.int64()),
                             "place": pa.array(range(len(members)), pa.int32()),
                             "n_bins": pa.array([r[0] for r in ranks], pa.int64()),
                             "evenness": pa.array([r[1] for r in ranks], pa.float64()),
                             "bins": [_written(m) for m in members]})
        return run

    schema = "island bigint, place int, n_bins bigint, evenness double, bins string"
    state = spark.range(islands).select(F.col("id").alias("island"), F.lit("").alias("bins"))
    for epoch in range(epochs):
        state = cut_lineage(state.select("island", "bins").repartition(islands, "island")
                            .groupBy("island").applyInArrow(step(epoch), schema))
        elites = state.where("place = 0").withColumn(
            "island", (F.col("island") + 1) % F.lit(islands))
        if epoch < epochs - 1:
            state = state.unionByName(elites)
    return _read(state.orderBy("n_bins", "evenness", "island").select("bins").first()[0])


# ------------------------------------------------------------------ placing

def _slots(bins: Bins) -> dict[int, np.ndarray]:
    """For each length rows (first rank, copies in a bin, first bin, offset), by first rank."""
    used: dict[int, int] = {}
    slots: dict[int, list] = {}
    base = 0
    for lengths, n in sorted(bins.items()):
        offset = 0
        for length in dict.fromkeys(lengths):
            copies = lengths.count(length)
            slots.setdefault(length, []).append((used.get(length, 0), copies, base, offset))
            used[length] = used.get(length, 0) + copies * n
            offset += copies * length
        base += n
    return {k: np.array(v, dtype=np.int64) for k, v in slots.items()}


def place(cut: DataFrame, bins: Bins, keys: list[str]) -> DataFrame:
    """Adds sequence_id and offset to stored pieces."""
    ranked = deal_ranks(cut, ["length"], [F.col(c) for c in keys], "__rank")
    slots = _slots(bins)
    columns = [c for c in ranked.columns if c != "__rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("__rank")).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for own in np.unique(length).tolist():
                rows = np.nonzero(length == own)[0]
                first, copies, base, start = slots[own].T
                at = np.searchsorted(first, rank[rows], side="right") - 1
                beyond = rank[rows] - first[at]
                sequence[rows] = base[at] + beyond // copies[at]
                offset[rows] = start[at] + beyond % copies[at] * own
            kept = [batch.column(batch.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)],
                                             [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                       for f in ranked.schema.fields if f.name != "__rank")
    return ranked.mapInArrow(run, schema + ", sequence_id bigint, offset bigint")


def pack(docs: DataFrame, keep: list[str], text: str = "text", with_ids: bool = False,
         capacity: int = CAPACITY) -> DataFrame:
    """Every piece with the sequence and offset it is packed at."""
    cut = cut_lineage(pieces(docs, keep, text, with_ids, capacity))
    # One row for each length: at most ``capacity`` rows come to the driver.
    histogram = {r["length"]: r["n"] for r in
                 cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bins = solve(docs.sparkSession, histogram, capacity)
    return place(cut, bins, [*keep, "piece", "start", "ids_crc32"])


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of every sequence, from pieces packed ``with_ids``."""
    return packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack(read(spark, folder, "documents", "doc_id", "text"), ["doc_id"])
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                         "offset")
