"""SimHash near-duplicates, compared bit-sliced.

1. Every text becomes a fingerprint: bit i is set where over half of its shingles' hashes have
   bit i set.  A first 64-bit word is the XXH64 of the shingle; wider fingerprints mix further
   words from it.
2. Equal fingerprints are one node.  Nodes meet in *tables*: a table looks at some of the bits,
   and nodes that agree on all of them share a bucket.  For a radius of up to 3 the tables are
   all choices of two out of (radius + 2) blocks, so two fingerprints within the radius always
   agree in some table and the search is exact.
3. Sorted by bucket, nodes are laid into tiles.  A tile stores its bit planes vertically: plane
   i holds bit i of 64 fingerprints in one machine word.  The distances of one fingerprint to
   64 others are counted together, by carry-save adders whose counters are bit planes too; words
   in which every distance has passed the radius are abandoned.
4. A task reports its links as a star to the least fingerprint of each local component, never
   as all pairs; a distributed component search joins the stars.

A bucket of more than ``HOT_BUCKET`` nodes is dealt to cells (i, j) of node parts, so that all
its pairs still meet, each in one of many tasks.

The stage that removes near-duplicates (:func:`deduplicated`) asks for a Jaccard similarity of 0.8,
which fingerprints only estimate: their links are confirmed by the sets, and shared rare shingles
bring together what fingerprints leave apart.  Its texts move only where they may be in a group.

Null and empty texts, and texts without words, have fingerprint zero and are linked like any
other.  Repeated rows and rows with a null id stay rows of the result.  A null id never becomes
a component id unless a whole component has none.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.common import components, read, screen, slices
from rosterloom.session import cut_lineage, discard

SEED = 42
TILE = 256
HOT_BUCKET = 16_384
#: Texts are read in slices of so many bytes, which bounds a task's memory.
SLICE_BYTES = 4_000_000
PLANES_AT_ONCE = 16


# ------------------------------------------------------------------ fingerprints

def fingerprint(text: str | None, words: int, width: int = 1) -> bytes:
    """The fingerprint of a text: ``width`` big-endian 64-bit words, zero without words."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return bytes(8 * width)
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    span = min(words, len(tokens))
    stops = ends[span - 1:].tolist()
    starts = [0, *(ends[:len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    first = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype=np.uint64)
    parts = []
    for k in range(width):
        # Sums of bits by blocks of shingles: memory stays bounded for very long texts.
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(first), 65_536):
            h = first[at:at + 65_536] if k == 0 else _mixed(first[at:at + 65_536], k)
            ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(
                axis=0, dtype=np.int64)
        parts.append(np.packbits(ones * 2 > len(first)).tobytes())
    return b"".join(parts)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """A further 64-bit hash from the first one (the splitmix64 finaliser)."""
    x = h + np.uint64(k * 0x9E3779B97F4A7C15 % 2 ** 64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                 words: int = 3, width: int = 1) -> DataFrame:
    """The columns ``keep`` of every row plus its binary ``fp``."""
    keep = keep or []
    chosen = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                         F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            fps = [fingerprint(t, words, width) for t in part.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:len(keep)], pa.array(fps, pa.binary())],
                [*part.schema.names[:len(keep)], "fp"])

    schema = "".join(f"k{i} {t}, " for i, t in enumerate(
        f.dataType.simpleString() for f in chosen.schema.fields[:-1]))
    done = chosen.mapInArrow(run, schema + "fp binary")
    return done.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "fp")


# ------------------------------------------------------------------ tables

def exact_tables(bits: int, radius: int) -> list[list[int]]:
    """Bit positions of tables in which any two fingerprints within the radius agree once."""
    blocks = np.array_split(np.arange(bits), radius + 2)
    return [[int(x) for block in pair for x in block]
            for pair in itertools.combinations(blocks, 2)]


def _entries(nodes: DataFrame, tables: list[list[int]]) -> DataFrame:
    """One row (t, key, fp) for each node and table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            n = len(column)
            if not n:
                continue
            bits = np.unpackbits(np.frombuffer(b"".join(column.to_pylist()), np.uint8)
                                 .reshape(n, -1), axis=1)
            for t, positions in enumerate(tables):
                power = np.int64(1) << np.arange(len(positions), dtype=np.int64)
                key = bits[:, positions].astype(np.int64) @ power
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, t, np.int32)), pa.array(key), column],
                    ["t", "key", "fp"])

    return nodes.mapInArrow(run, "t int, key bigint, fp binary")


# ------------------------------------------------------------------ bit-sliced comparison

class Tile:
    """Fingerprints with their bit planes: plane i holds bit i of 64 fingerprints a word."""

    def __init__(self, fps: np.ndarray) -> None:
        self.fps, self.n = fps, len(fps)
        bits = np.unpackbits(fps, axis=1)
        self.bits = bits
        padded = np.zeros((-(-self.n // 64) * 64, bits.shape[1]), np.uint8)
        padded[:self.n] = bits
        packed = np.packbits(padded.T, axis=1, bitorder="little")
        self.planes = np.ascontiguousarray(packed).view(np.uint64)


def near(queries: Tile, block: Tile, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (query, member of the block) of all pairs within the radius.

    A unit is one query against one word of 64 members.  Counters are bit planes: planes
    c[0], c[1], ... hold the distance so far, ``over`` the members whose count has run over.
    Planes are added by a tree of carry-save adders: two planes and a counter give the counter
    and one carry, so the counter of level k is touched once for 2 ** k planes.  Units whose
    members have all passed the radius are abandoned, and when hardly any member is left the
    rest are compared whole.
    """
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    words = block.planes.shape[1]
    query = np.repeat(np.arange(queries.n, dtype=np.int32), words)
    word = np.tile(np.arange(words, dtype=np.int32), queries.n)
    depth = max(1, int(radius).bit_length())
    counters = [np.zeros(len(query), np.uint64) for _ in range(depth)]
    over = np.zeros(len(query), np.uint64)
    tail = block.n % 64
    if tail:
        over[word == words - 1] = ones << np.uint64(tail)
    # Row i: all bits set for the queries whose bit i is set.
    flips = np.where(queries.bits.T == 1, ones, np.uint64(0))

    def add(level: int, planes: list[np.ndarray]) -> None:
        if level == depth:
            for plane in planes:
                np.bitwise_or(over, plane, out=over)
            return
        counter, carries = counters[level], []
        for x, y in zip(planes[::2], planes[1::2]):
            half = x ^ y
            np.bitwise_and(x, y, out=x)
            np.bitwise_and(half, counter, out=y)
            np.bitwise_or(x, y, out=x)
            np.bitwise_xor(counter, half, out=counter)
            carries.append(x)
        if len(planes) % 2:
            x = planes[-1]
            carries.append(counter & x)
            np.bitwise_xor(counter, x, out=counter)
        add(level + 1, carries)

    total = len(flips)
    for at in range(0, total, PLANES_AT_ONCE):
        several = range(at, min(at + PLANES_AT_ONCE, total))
        if len(query) == queries.n * words:
            add(0, [(block.planes[i][None, :] ^ flips[i][:, None]).ravel() for i in several])
        else:
            add(0, [block.planes[i][word] ^ flips[i][query] for i in several])
        if several.stop <= radius:
            continue  # no distance can have passed it
        left = ~(over | _above(counters, radius))
        if int(np.bitwise_count(left).sum()) <= 4 * queries.n:
            break  # so few that they are told apart one by one
        alive = left != 0
        if alive.sum() < 0.7 * len(query):
            query, word, over = query[alive], word[alive], over[alive]
            counters = [c[alive] for c in counters]
    hits = ~(over | _above(counters, radius))
    found = np.nonzero(hits)[0]
    member = np.unpackbits(hits[found].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    unit, bit = np.nonzero(member)
    a, b = query[found[unit]], word[found[unit]] * 64 + bit
    near_ = np.bitwise_count(queries.fps[a] ^ block.fps[b]).sum(axis=1) <= radius
    return a[near_], b[near_]


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Where the counter planes hold more than the radius."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for level in range(len(counters) - 1, -1, -1):
        if radius >> level & 1:
            equal = equal & counters[level]
        else:
            above |= equal & counters[level]
            equal = equal & ~counters[level]
    return above


def _least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n-1 the least node of their component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        differ = label[a] != label[b]
        if not differ.any():
            break
        a, b = a[differ], b[differ]
    while True:
        jumped = label[label]
        if (jumped == label).all():
            return label
        label = jumped


def _stars(fps: np.ndarray, keys: np.ndarray, radius: int) -> list[tuple[bytes, bytes]]:
    """Links among fingerprints sorted by bucket, as stars to each component's least one.

    A tile is compared with itself, and with later tiles as long as they begin inside the
    bucket in which it ends.
    """
    tiles = [Tile(fps[i:i + TILE]) for i in range(0, len(fps), TILE)]
    label = np.arange(len(fps))
    for i, tile in enumerate(tiles):
        last = keys[min((i + 1) * TILE, len(fps)) - 1]
        for j in range(i, len(tiles)):
            if j > i and keys[j * TILE] != last:
                break
            a, b = near(tile, tiles[j], radius)
            a, b = a + i * TILE, b + j * TILE
            a, b = a[a != b], b[a != b]
            if len(a):
                low = _least_labels(len(fps), np.concatenate([a, label]),
                                    np.concatenate([b, np.arange(len(fps))]))
                label = low
    rows = np.nonzero(label != np.arange(len(fps)))[0]
    return [(fps[r].tobytes(), fps[label[r]].tobytes()) for r in rows.tolist()]


def _compare(radius: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; the last bucket of a batch waits for the next batch."""
        keys, fps = np.zeros(0, np.int64), None

        def links(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            shared = np.zeros(len(k), bool)
            same = k[1:] == k[:-1]
            shared[1:] |= same
            shared[:-1] |= same
            found = set(_stars(f[shared], k[shared], radius)) if shared.any() else set()
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = batch.column(0).to_numpy(zero_copy_only=False)
            fp = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, -1)
            keys = np.concatenate([keys, key])
            fps = fp if fps is None else np.concatenate([fps, fp])
            open_at = int(np.argmax(keys == keys[-1]))  # buckets are runs of equal keys
            if open_at:
                yield from links(keys[:open_at], fps[:open_at])
                keys, fps = keys[open_at:], fps[open_at:]
        if len(keys) > 1:
            yield from links(keys, fps)
    return run


def links(nodes: DataFrame, radius: int, tables: list[list[int]],
          hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Stars (a, b) whose components are those of all pairs of nodes within the radius.

    ``nodes`` is a stored table with distinct fingerprints ``fp``.
    """
    entries = _entries(nodes, tables)
    sizes = (entries.groupBy("t", "key").count().where(F.col("count") > hot_bucket)
             .select("t", "key", F.ceil(F.col("count") / F.lit(hot_bucket / 2)).cast("int")
                     .alias("parts")))
    sizes = cut_lineage(sizes)
    if sizes.limit(1).count():
        # Hot buckets: parts of nodes meet pairwise in cells.
        part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        cells = F.when(F.col("parts").isNull(), F.array(F.lit(-1))).otherwise(F.transform(
            F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1),
            lambda j: F.least(part, j) * F.col("parts") + F.greatest(part, j)))
        entries = entries.join(sizes, ["t", "key"], "left").withColumn("cell", F.explode(cells))
    else:
        entries = entries.withColumn("cell", F.lit(-1))
    # Buckets are compared within a task by one number that stands for (table, key, cell).
    placed = (entries.select(F.xxhash64("t", "key", "cell").alias("bucket"), "fp")
              .repartition("bucket").sortWithinPartitions("bucket", "fp"))
    return placed.mapInArrow(_compare(radius), "a binary, b binary")


def groups(rows: DataFrame, id_column: str, radius: int, tables: list[list[int]]) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of the stored ``rows``."""
    least = cut_lineage(rows.groupBy("fp").agg(F.min(id_column).alias("least")))
    roots = components(links(least.select("fp"), radius, tables))
    joined = least.join(roots, least.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(lowest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                    words: int = 3, radius: int = 3, width: int = 1,
                    tables: list[list[int]] | None = None) -> DataFrame:
    """Every row's id, binary ``fp`` and ``component_id``.

    The component id is the least id among all rows that links can reach.
    """
    rows = cut_lineage(fingerprints(docs, text, [id_column], words, width))
    by_fp = groups(rows, id_column, radius, tables or exact_tables(64 * width, radius))
    return rows.join(by_fp, "fp").select(id_column, "fp", "component_id")


# ------------------------------------------------------------------ the dedup stage

#: Fingerprints of the stage: as in the query.
FP_WORDS, FP_RADIUS = 3, 3
#: Five-word shingles, whose sets are compared.
STAGE_WORDS = 5
SIMILARITY = 0.8
#: Members of a group that one cell compares with as many others, and shingles at once.
PART, COLUMNS = 256, 20_000
#: The same for bitmaps, which are smaller, and rows compared at once.
WIDE_PART, ROWS = 1024, 32
#: Pairs that a rare shingle may make for each of its texts before these are handed on as members.
CROWDED = 8
#: Texts that may share a rare shingle before what it ties is sought in cells.
HOT_SHINGLE = 4096
#: Shingles are counted by their top bits, in so many counters, which travel in chunks.
COUNTER_BITS, CHUNK_BITS = 20, 14


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """The distinct hashes of a text's shingles; a text without words has one, for it is empty."""
    tokens = (text or "").encode().lower().split()
    span = max(1, min(words, len(tokens)))
    found = {xxhash.xxh64_intdigest(b" ".join(tokens[i:i + span]), SEED)
             for i in range(len(tokens) - span + 1)} or {0}
    return np.fromiter(found, np.uint64, len(found)).view(np.int64)


def _similar(sets: list[np.ndarray], low: np.ndarray, own: bool,
             least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets with at least so much Jaccard similarity, by products of 0/1 matrices.

    In a cell of two parts, pairs inside a part are left to the part's own cell.
    """
    sizes = np.array([len(x) for x in sets])
    member = np.repeat(np.arange(len(sets)), sizes)
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    # Shingles of a single set are shared with none.
    wide = np.bincount(code) > 1
    column = np.cumsum(wide) - 1
    keep = wide[code]
    member, code = member[keep], column[code[keep]]
    order = np.argsort(code, kind="stable")
    member, code = member[order], code[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    total = int(wide.sum())
    for at in range(0, total, COLUMNS):
        lo, hi = np.searchsorted(code, [at, at + COLUMNS])
        holds = np.zeros((len(sets), min(COLUMNS, total - at)), np.float32)
        holds[member[lo:hi], code[lo:hi] - at] = 1
        shared += holds @ holds.T
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared >= least * union - 1e-6
    if not own:
        linked &= low[:, None] != low[None, :]
    a, b = np.nonzero(np.triu(linked, 1))
    return a, b


def verified(members: DataFrame, words: int = STAGE_WORDS, least: float = SIMILARITY,
             every: bool = True) -> DataFrame:
    """Stars (a, b) of the nodes whose shingle sets are similar, within each group.

    ``members`` has root (the group), parts, lead, node and text, one row for each node.  Groups are
    cut into that many parts by the hash of their nodes, and every two parts meet in a cell.
    Without ``every`` a part meets only itself and the nodes that lead their group, so that the
    rows grow with the members alone.
    """
    kind = members.schema["node"].dataType.simpleString()
    group = members.schema["root"].dataType.simpleString()

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            sets = [shingle_hashes(t, words) for t in part.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:4], pa.array(sets, pa.list_(pa.int64()))],
                ["root", "parts", "lead", "node", "shingles"])

    sets = members.select("root", "parts", "lead", "node", "text").mapInArrow(
        shingle, f"root {group}, parts int, lead boolean, node {kind}, shingles array<bigint>")
    all_parts = F.sequence(F.lit(0), F.col("parts") - 1)
    if every:
        cells = F.transform(all_parts, lambda j: F.struct(
            F.least(F.col("part"), j).alias("i"), F.greatest(F.col("part"), j).alias("j")))
    else:
        cells = F.transform(F.when(F.col("lead"), all_parts).otherwise(F.array("part")),
                            lambda j: F.struct(j.alias("i"), j.alias("j")))
    laid = (sets.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
            .withColumn("cell", F.explode(cells))
            .select(F.xxhash64("root", "cell").alias("key"), "node",
                    (F.col("part") == F.col("cell.i")).alias("low"),
                    (F.col("cell.i") == F.col("cell.j")).alias("own"), "shingles")
            .repartition("key").sortWithinPartitions("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def star(nodes: list, low: list, own: bool, sets: list) -> Iterator[tuple]:
            if len(nodes) > 1:
                label = _least_labels(len(nodes), *_similar(sets, np.array(low), own, least))
                for i in np.nonzero(label != np.arange(len(nodes)))[0].tolist():
                    yield nodes[i], nodes[label[i]]

        def stars() -> Iterator[tuple]:
            key, nodes, low, own, sets = None, [], [], False, []
            for batch in batches:
                lists = batch.column(4)
                flat = lists.values.to_numpy(zero_copy_only=False)
                offsets = lists.offsets.to_numpy()
                for i, (k, node, is_low, is_own) in enumerate(zip(*(
                        batch.column(c).to_pylist() for c in range(4)))):
                    if k != key:
                        yield from star(nodes, low, own, sets)
                        key, nodes, low, sets = k, [], [], []
                    own = is_own
                    nodes.append(node)
                    low.append(is_low)
                    sets.append(flat[offsets[i]:offsets[i + 1]].copy())
            yield from star(nodes, low, own, sets)

        found = list(stars())  # no more than the rows of a task
        if found:
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found])

    return laid.mapInArrow(run, f"a {kind}, b {kind}")


def _commonness(texts: DataFrame, words: int) -> np.ndarray:
    """A small number for each counter of shingles: how often they occur, as a power of two.

    The counters only order the shingles of a text, so what shares one does no harm.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in slices(batches, "text", SLICE_BYTES):
            if total is None:
                total = np.zeros(1 << COUNTER_BITS, np.uint32)
            for text in part.column(0).to_pylist():
                # Hashes of one text that share a counter count once, which is near enough.
                total[_counter(shingle_hashes(text, words))] += np.uint32(1)
        if total is not None:
            chunks = total.reshape(-1, 1 << CHUNK_BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(chunks)), pa.int32()),
                 pa.array([c.tobytes() for c in chunks], pa.binary())], ["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # one for each chunk at most
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(counts, np.uint32)
                sums[chunk] = sums[chunk] + own if chunk in sums else own.astype(np.uint64)
        if sums:
            ranks = [np.frexp(c.astype(np.float64))[1].astype(np.uint8).tobytes()
                     for c in sums.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array(ranks, pa.binary())],
                ["chunk", "ranks"])

    summed = texts.select("text").mapInArrow(count, "chunk int, counts binary").repartition(
        "chunk").mapInArrow(add, "chunk int, ranks binary")
    ranks = np.zeros((1 << COUNTER_BITS - CHUNK_BITS, 1 << CHUNK_BITS), np.uint8)
    for row in summed.collect():  # one byte a counter
        ranks[row["chunk"]] = np.frombuffer(row["ranks"], np.uint8)
    return ranks.ravel()


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def prefix(hashes: np.ndarray, ranks: np.ndarray, least: float = SIMILARITY) -> np.ndarray:
    """The rarest of a text's shingles, as many as any similar set must share one of.

    Of n shingles a set with a Jaccard similarity of ``least`` holds n * least at least.  With all
    shingles in one order, the first ones that two such sets share lies among the first
    n - ceil(n * least) + 1 of either.
    """
    n = len(hashes)
    size = n - int(np.ceil(n * least - 1e-6)) + 1
    return hashes[np.lexsort((hashes, ranks[_counter(hashes)]))[:size]]


def described(texts: DataFrame, words: int = STAGE_WORDS,
              least: float = SIMILARITY) -> DataFrame:
    """(node, fp, size, prefix, bits) of the texts; ``texts`` has key and text.

    The fingerprint, the size of the shingle set, its rarest shingles in order, its bitmap.  Copies
    in different tasks have a row each.
    """
    ranks = texts.sparkSession.sparkContext.broadcast(_commonness(texts, words))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies inside a task enter once
        for part in slices(batches, "text", SLICE_BYTES):
            nodes, fps, sizes, first, bits = [], [], [], [], []
            for node, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if node not in seen:
                    seen.add(node)
                    hashes = shingle_hashes(text, words)
                    nodes.append(node)
                    fps.append(fingerprint(text, FP_WORDS))
                    sizes.append(len(hashes))
                    first.append(prefix(hashes, ranks.value, least))
                    bits.append(parity(hashes).tobytes())
            if nodes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(fps, pa.binary()),
                     pa.array(sizes, pa.int32()), pa.array(first, pa.list_(pa.int64())),
                     pa.array(bits, pa.binary())], ["node", "fp", "size", "prefix", "bits"])

    # Each text is read and cut into shingles once; what follows reads this table.
    return cut_lineage(texts.select("key", "text").mapInArrow(
        describe, "node bigint, fp binary, size int, prefix array<bigint>, bits binary"))


def fingerprint_groups(table: DataFrame) -> DataFrame:
    """(short, root, lead) of the nodes in groups that links between fingerprints make.

    ``table`` is that of :func:`described`; the links are those of :func:`near_duplicates`.
    """
    nodes = cut_lineage(table.select("node", "fp").dropDuplicates(["node"]))
    found = groups(nodes, "node", FP_RADIUS, exact_tables(64, FP_RADIUS))
    grouped = nodes.join(found, "fp").select(
        F.col("node").alias("short"), F.col("component_id").alias("root"),
        (F.col("node") == F.col("component_id")).alias("lead"))
    several = grouped.groupBy("root").count().where("count > 1").select("root")
    return grouped.join(several, "root", "left_semi")


MET = ["a", "b", "hot", "shingle", "label"]


def _meetings(least: float) -> Callable:
    """Pairs (a, b) of nodes with other labels that share a shingle of their prefixes.

    A shingle with more than ``CROWDED`` pairs a node gives a row for each node instead: a, its
    label, the shingle, and in b one node that it may be similar to, if there is one.  So the rows
    grow with the nodes alone.  Neighbours in a shingle with more than ``HOT_SHINGLE`` are marked hot.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shingle and size; the last shingle of a batch waits for the next."""
        def pairs(shingle: np.ndarray, place: np.ndarray, node: np.ndarray,
                  label: np.ndarray) -> Iterator[pa.RecordBatch]:
            # A text that several tasks described is one node.
            new = np.append(True, (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1]))
            shingle, place, node, label = (x[new] for x in (shingle, place, node, label))
            size, at = place >> 32, place & 0xFFFFFFFF
            most = len(shingle)
            starts = np.nonzero(np.append(True, shingle[1:] != shingle[:-1]))[0]
            length = np.diff(np.append(starts, most))
            # Where all have one label, there is nothing left to tie.
            mixed = np.maximum.reduceat(label, starts) != np.minimum.reduceat(label, starts)
            hot = np.repeat(length > HOT_SHINGLE, length)
            bucket = np.repeat(np.arange(len(starts)), length)
            made, crowded = np.zeros(len(starts), np.int64), np.zeros(len(starts), bool)
            stop = np.repeat(starts + length, length)

            def fits(here: np.ndarray, other: np.ndarray) -> np.ndarray:
                return size[here] >= least * size[other] - 1e-6

            def may_share(here: np.ndarray, other: np.ndarray) -> np.ndarray:
                shared = np.minimum(size[here] - at[here], size[other] - at[other])
                return shared >= least / (1 + least) * (size[here] + size[other]) - 1e-6

            def members(here: np.ndarray) -> pa.RecordBatch:
                # Each is tied to the next one with another label.
                ends = np.nonzero(np.append(
                    (shingle[1:] != shingle[:-1]) | (label[1:] != label[:-1]), True))[0] + 1
                other = ends[np.searchsorted(ends, here, side="right")]
                tied = other < stop[here]
                other = np.where(tied, other, here)
                tied &= fits(here, other) & may_share(here, other)
                return pa.RecordBatch.from_arrays(
                    [pa.array(node[here]), pa.array(node[other], mask=~tied),
                     pa.array(np.zeros(len(here), bool)), pa.array(shingle[here]),
                     pa.array(label[here])], MET)

            here = np.nonzero(np.repeat(mixed, length))[0]
            kept: list[tuple] = []
            total = step = 0
            while len(here):
                step += 1
                here = here[here + step < stop[here]]
                other = here + step
                fit = fits(here, other)
                here, other = here[fit], other[fit]  # later ones are larger still
                # In a hot bucket neighbours are tied, whatever their labels and places.
                may = hot[here] | may_share(here, other) & (label[here] != label[other])
                if may.any():
                    a, b = node[here[may]], node[other[may]]
                    own = bucket[here[may]]
                    kept.append((np.minimum(a, b), np.maximum(a, b), hot[here[may]], own))
                    np.add.at(made, own, 1)
                    crowded = made > CROWDED * length
                    total += len(a)
                    if total > 1 << 20:
                        yield from packed(kept, crowded)
                        kept, total = [], 0
                here = here[~(hot[here] | crowded[bucket[here]])]
            if kept:
                yield from packed(kept, crowded)
            if crowded.any():
                yield members(np.nonzero(crowded[bucket])[0])

        def packed(kept: list[tuple], crowded: np.ndarray) -> Iterator[pa.RecordBatch]:
            a, b, hot, own = (np.concatenate(x) for x in zip(*kept))
            a, b, hot = (x[~crowded[own]] for x in (a, b, hot))
            if not len(a):
                return
            order = np.lexsort((hot, b, a))
            a, b, hot = a[order], b[order], hot[order]
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (hot[1:] != hot[:-1]))
            none = pa.nulls(int(new.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[new]), pa.array(b[new]), pa.array(hot[new]), none, none], MET)

        waiting: list[list[np.ndarray]] = []  # rows of the open shingle
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if waiting and rows[0][0] == waiting[0][0][-1] == rows[0][-1]:
                waiting.append(rows)  # a shingle that fills batches
                continue
            waiting.append(rows)
            held = [np.concatenate(x) for x in zip(*waiting)]
            open_at = int(np.searchsorted(held[0], held[0][-1]))
            if open_at:
                yield from pairs(*(x[:open_at] for x in held))
            waiting = [[x[open_at:] for x in held]]
        if waiting:
            yield from pairs(*(np.concatenate(x) for x in zip(*waiting)))
    return run


def _allowed(least: float) -> Callable:
    """Keeps the pairs (a, b) whose sizes and bitmaps allow them to be similar."""
    share = (1 - least) / (1 + least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            for x, y, both in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(),
                                  sizes.tolist()):
                x, y = np.frombuffer(x, np.uint64)[None, :], np.frombuffer(y, np.uint64)[None, :]
                words = min(x.shape[1], y.shape[1])
                differ = int(np.bitwise_count(_fold(x, words) ^ _fold(y, words)).sum())
                keep.append(differ <= share * both + 1e-6)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(
                pa.array(keep, pa.bool_()))
    return run


def _parts() -> Column:
    return F.ceil(F.count("*") / F.lit(WIDE_PART)).cast("int").alias("parts")


def _crowds(crowds: DataFrame, joined: DataFrame, own: DataFrame) -> DataFrame | None:
    """(root, parts, node, label, joined) for the comparison of crowded shingles, None without any.

    ``crowds`` has root (the shingle), node and label, ``joined`` node and root of what is joined,
    ``own`` the bits.  Shingles of which all nodes have one label, or are joined, are left out.  What
    the others reach is one group, in which a pair meets once, or else remains a group for each
    shingle: whichever moves fewer bytes of bitmaps.
    """
    known = crowds.join(joined.toDF("node", "joined"), "node", "left").withColumn(
        "joined", F.coalesce("joined", "node"))
    known = cut_lineage(known)
    # Where labels differ, and so do joined groups, some pair is apart in both ways.
    apart = known.groupBy("root").agg(_parts(), F.min("node").alias("first"), *(
        (F.min(c) != F.max(c)).alias(f"{c}_apart") for c in ("label", "joined")))
    members = cut_lineage(known.join(
        apart.where("label_apart and joined_apart").select("root", "parts", "first"), "root"))
    discard(known)
    if not members.limit(1).count():
        discard(members)
        return None
    reached = cut_lineage(components(members.select(
        F.col("node").alias("a"), F.col("first").alias("b"))))
    # For each node: the bytes that its shingles would move, and its group.
    nodes = cut_lineage(
        members.groupBy("node", "label", "joined").agg(F.sum("parts").alias("times"))
        .join(reached.withColumnRenamed("root", "whole"), "node")
        .join(own.select("node", F.length("bits").alias("bytes")), "node"))
    whole = cut_lineage(nodes.groupBy("whole").agg(
        _parts(), F.sum(F.col("bytes") * F.col("times")).alias("split"),
        F.sum("bytes").alias("bytes"))
        .select("whole", "parts", (F.col("bytes") * F.col("parts") <= F.col("split"))
                .alias("at_once")))
    at_once = nodes.join(whole.where("at_once"), "whole").select(
        F.col("whole").alias("root"), "parts", "node", "label", "joined")
    split = nodes.join(whole.where("not at_once"), "whole").select("node")
    chosen = cut_lineage(at_once.unionByName(
        members.join(split, "node").select("root", "parts", "node", "label", "joined")))
    discard(members, reached, nodes, whole)
    return chosen


def proposed_groups(table: DataFrame, labels: DataFrame,
                    least: float = SIMILARITY) -> DataFrame:
    """(node, root) of groups that hold every pair of similar texts with different labels.

    ``table`` is that of :func:`described`, ``labels`` has short and label of the nodes that are
    joined with others already; each other node has a label of its own.  Texts that share a
    shingle of their prefixes meet, sorted by the sizes of their sets.  The first shingle that a
    similar pair shares leaves enough shingles behind it on both sides; sizes and bitmaps must allow the
    similarity too.  A shingle that would make many pairs a text makes none: each is tied to one
    other, and where such ties leave the shingle's texts in several groups, their bitmaps are
    compared in cells (:func:`_crowds`).  Where very many share one, each is tied to the one before,
    unless that is too small to be similar, and what all such ties reach is compared in cells.
    """
    known = screen(labels, "short")
    placed = table.select("node", "size", "prefix")
    labelled = (placed.where(known("node")).join(
        labels.select(F.col("short").alias("node"), "label"), "node", "left")
        .unionByName(placed.where(~known("node")).withColumn("label", F.lit(None).cast("long"))))
    met = cut_lineage(
        labelled.select("node", "size", "label", F.posexplode("prefix").alias("at", "shingle"))
        .select("shingle", F.shiftleft(F.col("size").cast("long"), 32).bitwiseOR(
            F.col("at").cast("long")).alias("place"), "node", "label")
        .repartition("shingle").sortWithinPartitions("shingle", "place", "node")
        .select("shingle", "place", "node", F.coalesce("label", "node").alias("label"))
        .mapInArrow(_meetings(least),
                    "a bigint, b bigint, hot boolean, shingle bigint, label bigint"))
    own = table.select("node", "size", "bits").dropDuplicates(["node"])
    pairs = met.where("not hot and b is not null").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for side in "ab":
        pairs = pairs.join(own.toDF(side, f"size_{side}", f"bits_{side}"), side)
    near = pairs.select("a", "b", "size_a", "size_b", "bits_a", "bits_b").mapInArrow(
        _allowed(least), "a bigint, b bigint")
    stored = [met]
    crowds = met.where("shingle is not null").select(
        F.col("shingle").alias("root"), F.col("a").alias("node"), "label")
    if crowds.limit(1).count():
        joined = cut_lineage(components(near))
        stored.append(joined)
        members = _crowds(crowds, joined, own)
        near = joined.toDF("a", "b")
        if members is not None:
            stored.append(members)
            near = near.unionByName(_near(members.join(own, "node"), least))
    hot = met.where("hot").select("a", "b")
    if hot.limit(1).count():
        loose = cut_lineage(components(hot))
        alike = loose.join(loose.groupBy("root").agg(_parts()), "root").withColumns(
            {"label": F.col("node"), "joined": F.col("node")})
        near = near.unionByName(_near(alike.join(own, "node"), least))
        stored.append(loose)
    found = cut_lineage(components(near))
    discard(*stored)
    return found


def parity(hashes: np.ndarray) -> np.ndarray:
    """A bitmap of a set: each hash flips one bit.  Twice as many bits as hashes, a power of two.

    Sets that differ in d hashes have bitmaps that differ in d bits at most.  Folding a bitmap's
    halves onto each other gives that of half the width.
    """
    width = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    at = (hashes.view(np.uint64) & np.uint64(width - 1)).astype(np.int64)
    flipped = np.bincount(at, minlength=width).astype(np.uint8) & 1
    return np.packbits(flipped, bitorder="little").view(np.uint64)


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _close(sizes: np.ndarray, bits: list[np.ndarray], low: np.ndarray, own: bool,
           least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose sizes and bitmaps allow a Jaccard similarity of ``least``.

    Such sets differ in (1 - least) / (1 + least) of their sizes' sum at most, and so do bitmaps.
    """
    order = np.argsort(sizes, kind="stable")
    sizes, low = sizes[order], low[order]
    bits = [bits[i] for i in order.tolist()]
    share = (1 - least) / (1 + least)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(sizes), ROWS):
        end = min(at + ROWS, len(sizes))
        # Larger ones only: each pair is met from its smaller side.
        upto = int(np.searchsorted(sizes, sizes[end - 1] / least + 1e-6, side="right"))
        words = len(bits[at])  # the narrowest of all that follow
        a = _fold_all(bits[at:end], words)
        b = _fold_all(bits[at:upto], words)
        most = share * (sizes[at:end, None] + sizes[None, at:upto]) + 1e-6
        distance = np.zeros((end - at, upto - at), np.int32)
        for w in range(words):
            distance += np.bitwise_count(a[:, w, None] ^ b[None, :, w])
        linked = (distance <= most) & (np.arange(at, upto)[None, :] > np.arange(at, end)[:, None])
        if not own:
            linked &= low[at:end, None] != low[None, at:upto]
        x, y = np.nonzero(linked)
        found.append((order[x + at], order[y + at]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _fold_all(bits: list[np.ndarray], words: int) -> np.ndarray:
    return np.concatenate([_fold(x[None, :], words) for x in bits])


def _near(members: DataFrame, least: float) -> DataFrame:
    """Stars (a, b) of the nodes that sizes and bitmaps allow to be similar, within each group.

    ``members`` has root, parts, node, label, joined, size and bits.  Nodes with one label, or joined
    already, are no pair.  Bitmaps are a sixteenth of the sets or less, so every two parts of a
    large group can meet.
    """
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least(F.col("part"), j).alias("i"), F.greatest(F.col("part"), j).alias("j")))
    laid = (members.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
            .withColumn("cell", F.explode(cells))
            .select(F.xxhash64("root", "cell").alias("key"), "node",
                    (F.col("part") == F.col("cell.i")).alias("low"),
                    (F.col("cell.i") == F.col("cell.j")).alias("own"), "label", "joined", "size",
                    "bits")
            .repartition("key").sortWithinPartitions("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def star(rows: list) -> Iterator[tuple]:
            if len(rows) > 1:
                _, nodes, low, own, labels, joined, sizes, bits = zip(*rows)
                a, b = _close(np.array(sizes), [np.frombuffer(x, np.uint64) for x in bits],
                              np.array(low), own[0], least)
                labels, joined = np.array(labels), np.array(joined)
                apart = (labels[a] != labels[b]) & (joined[a] != joined[b])
                label = _least_labels(len(rows), a[apart], b[apart])
                for i in np.nonzero(label != np.arange(len(rows)))[0].tolist():
                    yield nodes[i], nodes[label[i]]

        rows: list[tuple] = []
        found: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and row[0] != rows[0][0]:
                    found += star(rows)
                    rows = []
                rows.append(row)
        found += star(rows)  # no more than the rows of a task
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)],
                                             ["a", "b"])

    return laid.mapInArrow(run, "a bigint, b bigint")


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                 least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, one of each group of near-duplicates.

    Texts whose sets of five-word shingles have a Jaccard similarity of ``least`` or more are
    linked, and what links reach is a group.  SimHash fingerprints propose links first; those that
    the sets confirm join most of a large group.  Shared rare shingles then propose groups that no
    similar pair still apart escapes, whatever its length, and there the sets are compared too.
    The row with the least id stays (rows without an id come last, ties go by the text's digest).
    Rows equal in id and text count as one.  All texts without words, nulls among them, are one
    group.
    """
    marked = docs.withColumns({
        "__digest": F.coalesce(F.sha2(text, 256), F.lit("")), "__key": F.xxhash64(id_column),
        "__short": F.xxhash64(text)})
    order = F.struct(F.col(id_column).isNull().alias("late"), F.col(id_column).alias("id"),
                     F.col("__digest").alias("node"), F.col("__key").alias("key"))
    texts = cut_lineage(marked.groupBy(F.col("__digest").alias("node")).agg(
        F.min(order).alias("best"), F.min("__short").alias("short"), F.count("*").alias("n")))

    def compared(chosen: DataFrame, every: bool) -> DataFrame:
        """Links between the texts of groups; ``chosen`` has short, root and lead."""
        # Texts are grouped by a short key; if two ever share one, they are told apart here.
        candidates = cut_lineage(texts.join(chosen, "short").select(
            "node", "root", "lead", "short", F.col("best.key").alias("key")))
        # Sizes of groups are counted without the texts, so each set of shingles moves only once.
        parts = candidates.groupBy("root").agg(
            F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
        proposed = screen(candidates, "short")
        # One row of each text: that with the least id.  Id and text together are no hot key.  Texts
        # in no proposed group stay where they are.
        members = (marked.where(proposed("__short"))
                   .select("__digest", "__key", F.col(text).alias("text"))
                   .join(candidates.join(parts, "root"),
                         (F.col("__digest") == F.col("node")) & (F.col("__key") == F.col("key")))
                   .dropDuplicates(["__digest", "__key"])
                   .select("root", "parts", "lead", "node", "text"))
        return cut_lineage(verified(members, STAGE_WORDS, least, every))

    table = described(marked.select(F.col("__short").alias("key"), F.col(text).alias("text")),
                      STAGE_WORDS, least)
    alike = compared(fingerprint_groups(table), every=False)
    joined = components(alike)
    labels = cut_lineage(texts.join(joined, "node").select(
        "short", F.xxhash64("root").alias("label")).dropDuplicates(["short"]))
    rest = proposed_groups(table, labels, least)
    others = compared(rest.toDF("short", "root").withColumn("lead", F.lit(False)), every=True)
    roots = cut_lineage(components(alike.unionByName(others)))
    discard(table, labels, rest, alike, others)
    told = cut_lineage(texts.join(roots, "node", "left"))
    # Rows alone with their text, which is in no group, are kept without being moved.
    grouped = told.where("n > 1 or root is not null")
    kept = (grouped.groupBy(F.coalesce("root", "node").alias("group"))
            .agg(F.min("best").alias("best"))
            .select(F.col("best.key").alias("__key"), F.col("best.node").alias("__digest")))
    doubtful = screen(grouped, "short")
    own = docs.columns
    # A row that passes without being in a group is alone with its text: both keys are its own.
    single = told.where("n = 1 and root is null").where(doubtful("short")).select(
        F.col("best.key").alias("__key"), F.col("node").alias("__digest"))
    settled = (marked.where(doubtful("__short"))
               .join(kept.unionByName(single), ["__key", "__digest"], "left_semi")
               .dropDuplicates(["__key", "__digest"]))
    return marked.where(~doubtful("__short")).select(*own).unionByName(settled.select(*own))


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(read(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")
