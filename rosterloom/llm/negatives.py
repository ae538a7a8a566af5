"""Hard negatives by exact integer scores, multiplied in a residue number system.

1. Components become integers, floor(256 x).  Their largest absolute value and the longest vector
   bound every inner product, and that bound says how many primes are needed: their product
   exceeds twice the bound, so residues tell signed scores apart.
2. Rows stay where they are stored.  Anchors are dealt into blocks of bounded bytes; each block in
   turn is sent to all tasks and meets all rows, in tiles.  Per prime, both matrices are reduced to
   residues around zero and multiplied in float32: a product of ``CHUNK`` terms below (p / 2)^2 stays
   under 2^24, so every sum is exact.  Longer vectors are multiplied chunk by chunk.
3. Chinese remaindering (in mixed radix, so no step leaves 64 bits) gives back the exact scores.
4. Selection: each task keeps an anchor's best rows over all its tiles, at most as many as are asked
   for, and a window over tasks ranks these.  First the positives; then, for each positive's window of
   scores, the negatives.

The query set goes through the driver one block at a time, so its memory doesn't grow; a task holds a
block and a tile.  A hot label only sets which scores are looked at; no group meets in one task.

Rows with a null label, a null vector, or a null or non-finite component take no part.  Shorter vectors
count as filled with zeros; empty ones score 0.  Repeated rows each take part: one that repeats an
anchor is another row and may be its positive, and each anchor row gives its own results.  Rows without
an id are no anchors, keep their label, and come last among equal scores.  Scores that don't fit in
64 bits are an error.  An empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterloom.llm.common import read
from rosterloom.session import cut_lineage

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: Negatives score at least this share (in percent) of the positive's score.
LEAST_PERCENT = 80
#: Primes below 512, largest first: 256 products of residues around zero stay below 2^24.
CHUNK, LARGEST = 256, 512
#: Bytes of a block of anchors, which every task gets, and rows of a tile.
BLOCK_BYTES, TILE, ANCHORS = 16 << 20, 2048, 1024
LOWEST = np.iinfo(np.int64).min


def primes(bound: int) -> list[int]:
    """The largest small primes whose product exceeds twice the bound."""
    chosen, product = [], 1
    for p in range(LARGEST - 1, 2, -1):
        if product > 2 * bound:
            break
        if all(p % d for d in range(2, int(p ** 0.5) + 1)):
            chosen.append(p)
            product *= p
    if product >= 1 << 63:
        raise ValueError(f"scores up to {bound} don't fit in 64 bits")
    return chosen


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Integers modulo a prime, around zero, as float32."""
    r = x % p
    r[r > p // 2] -= p
    return r.astype(np.float32)


def products(a: np.ndarray, b: np.ndarray, moduli: list[int]) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices, through their residues."""
    digits: list[np.ndarray] = []  # of the score in mixed radix
    for p in moduli:
        left, right = residues(a, p), residues(b, p)
        r = np.zeros((len(a), len(b)), np.int64)
        for low in range(0, a.shape[1], CHUNK):
            r += (left[:, low:low + CHUNK] @ right[:, low:low + CHUNK].T).astype(np.int64)
        radix = 1
        for digit, q in zip(digits, moduli):
            r -= digit * radix
            r %= p
            radix = radix * q % p
        digits.append(r * pow(radix, -1, p) % p if digits else r % p)
    score, radix = np.zeros((len(a), len(b)), np.int64), 1
    for digit, p in zip(digits, moduli):
        score += digit * radix
        radix *= p
    score[score > radix // 2] -= radix
    return score


def best(scores: np.ndarray, count: int) -> np.ndarray:
    """Positions of the highest scores of each row, highest first, ties in order of position."""
    down = -np.maximum(scores, LOWEST + 1)
    count = min(count, scores.shape[1])
    last = np.partition(down, count - 1, axis=1)[:, count - 1, None]
    # All above the last chosen score, and of those equal to it the first ones.
    equal = down == last
    spare = count - (down < last).sum(axis=1, keepdims=True)
    chosen = (down < last) | (equal & (np.cumsum(equal, axis=1) <= spare))
    at = np.nonzero(chosen)[1].reshape(len(scores), count)
    order = np.argsort(np.take_along_axis(down, at, axis=1), axis=1, kind="stable")
    return np.take_along_axis(at, order, axis=1)


class Kept:
    """The best rows of each anchor (and window) that a task has seen: score, id, row."""

    def __init__(self, anchors: int, count: int) -> None:
        self.score = np.full((anchors, count), LOWEST, np.int64)
        self.id = np.zeros((anchors, count), np.int64)
        self.row = np.zeros((anchors, count), np.int64)
        self.count = count

    def add(self, at: slice, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Scores of further rows, in ascending order of ids; ineligible ones are lowest."""
        near = best(scores, self.count)
        score = np.concatenate([self.score[at], np.take_along_axis(scores, near, axis=1)], axis=1)
        id_ = np.concatenate([self.id[at], ids[near]], axis=1)
        row = np.concatenate([self.row[at], rows[near]], axis=1)
        order = np.lexsort((id_, -np.maximum(score, LOWEST + 1)))[:, :self.count]
        self.score[at], self.id[at], self.row[at] = (
            np.take_along_axis(x, order, axis=1) for x in (score, id_, row))


def _padded(column: pa.Array, dim: int) -> np.ndarray:
    """Integer vectors as rows of one matrix, shorter ones filled with zeros."""
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    x = np.zeros((len(column), dim), np.int64)
    if len(column):
        x[np.arange(dim) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return x


def _tiles(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple]:
    """Rows in tiles in ascending order of ids: row numbers, ids, labels, vectors."""
    for batch in batches:
        for low in range(0, batch.num_rows, TILE):
            part = batch.slice(low, TILE)
            row, id_, label = (part.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            order = np.argsort(id_, kind="stable")
            yield row[order], id_[order], label[order], _padded(part.column(3), dim)[order]


def _met(rows: DataFrame, block: dict, moduli: list[int], dim: int, positives: int,
         negatives: int) -> DataFrame:
    """One block of anchors against all rows: (anchor, place, score, id, row).

    Without windows in the block these are candidates for positives, else for negatives of the
    positive in each place.
    """
    windows = block.get("windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(block["row"])
        places = 1 if windows is None else positives
        kept = [Kept(n, positives if windows is None else negatives) for _ in range(places)]
        seen = False
        for row, id_, label, x in _tiles(batches, dim):
            seen = True
            for low in range(0, n, ANCHORS):
                at = slice(low, low + ANCHORS)
                scores = products(block["vector"][at], x, moduli)
                same = block["label"][at, None] == label[None, :]
                if windows is None:
                    own = block["row"][at, None] == row[None, :]
                    scores[~same | own] = LOWEST
                    kept[0].add(at, scores, id_, row)
                    continue
                scores[same] = LOWEST
                for place in range(places):
                    most, least = windows[at, place, 0], windows[at, place, 1]
                    fits = (scores <= most[:, None]) & (scores >= least[:, None])
                    if fits.any():
                        kept[place].add(at, np.where(fits, scores, LOWEST), id_, row)
        if not seen:
            return
        for place, k in enumerate(kept):
            a, b = np.nonzero(k.score > LOWEST)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block["row"][a]), pa.array(np.full(len(a), place, np.int32)),
                 pa.array(k.score[a, b]), pa.array(k.id[a, b]), pa.array(k.row[a, b])],
                ["anchor", "place", "score", "id", "row"])

    return rows.mapInArrow(run, "anchor bigint, place int, score bigint, id bigint, row bigint")


def _ranked(found: DataFrame, count: int) -> DataFrame:
    """The first ``count`` candidates of each anchor and place, with their rank from 0."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < count)


def integers(vector: Column, scale: int = SCALE) -> Column:
    """Scaled components, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def hard_negatives(vectors: DataFrame, anchors: Column, id_column: str = "vec_id",
                   vector: str = "embedding", label: Column | str = "label",
                   positives: int = POSITIVES, negatives: int = NEGATIVES,
                   percent: int = LEAST_PERCENT, scale: int = SCALE,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` says which rows are anchors.
    """
    spark = vectors.sparkSession
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = F.col(label) if isinstance(label, str) else label
    last = np.iinfo(np.int64).max
    # Rows without an id come last among equal scores.
    rows = cut_lineage(vectors.where(own.isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(id_column).cast("long").alias("id"), own.cast("long").alias("label"),
        integers(F.col(vector), scale).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
        .withColumn("row", F.monotonically_increasing_id()))
    high, low, dim = rows.agg(F.max(F.array_max("vector")), F.min(F.array_min("vector")),
                              F.max(F.size("vector"))).first()
    largest, dim = max(abs(high or 0), abs(low or 0)), dim or 0
    moduli = primes(dim * largest * largest)
    table = rows.select("row", F.coalesce("id", F.lit(last)).alias("id"), "label", "vector")

    per_block = max(1, block_bytes // (8 * (max(dim, 1) + 2 * positives)))
    asked = rows.where("is_anchor").select("row", "id", "label", "vector")
    blocks = -(-asked.count() // per_block)
    out, begin = None, -1
    for _ in range(blocks):
        # The next block by row number; never more than ``per_block`` anchors are in the driver.
        part = asked.where(F.col("row") > begin).orderBy("row").limit(per_block).toArrow()
        begin = part.column("row")[-1].as_py()
        block = {"row": part.column("row").to_numpy(), "label": part.column("label").to_numpy(),
                 "vector": _padded(part.column("vector").combine_chunks(), dim)}
        near = cut_lineage(_ranked(_met(table, block, moduli, dim, positives, negatives),
                               positives))
        windows = np.empty((len(block["row"]), positives, 2), np.int64)
        windows[:, :, 0], windows[:, :, 1] = -1, 0  # places without a positive hold nothing
        at = np.searchsorted(block["row"], (chosen := near.select(
            "anchor", "rank", "score").toArrow()).column("anchor").to_numpy())
        place, score = chosen.column("rank").to_numpy(), chosen.column("score").to_numpy()
        windows[at, place, 0] = score
        windows[at, place, 1] = [-((-percent * s) // 100) for s in score.tolist()]
        far = _ranked(_met(table, block | {"windows": windows}, moduli, dim, positives,
                           negatives), negatives)
        pairs = cut_lineage(far.select("anchor", F.col("place"), F.col("rank").alias("n"),
                                       F.col("score").alias("negative_score"),
                                       F.col("row").alias("negative")).join(
            near.select("anchor", F.col("rank").alias("place"),
                        F.col("score").alias("positive_score"), F.col("row").alias("positive")),
            ["anchor", "place"]))
        out = pairs if out is None else out.unionByName(pairs)
    if out is None:
        out = spark.createDataFrame([], "anchor long, place int, n int, negative_score long, "
                                        "negative long, positive_score long, positive long")
    for name in ("anchor", "positive", "negative"):
        out = out.join(rows.select(F.col("row").alias(name), F.col("id").alias(f"{name}_id")),
                       name)
    return out.select("anchor_id", "positive_id", (F.col("n") + 1).cast("int").alias("rank"),
                      "negative_id", "positive_score", "negative_score")


def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, label=moved)


#: The query as DuckDB SQL.  Integers up to 2^53 are exact in a double.
ORACLE = f"""
with rows as (
  select row_number() over () as r, vec_id,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.r as a, a.vec_id as anchor_id, b.r as b, b.vec_id as vec_id,
         a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from rows a, rows b where a.vec_id % 100 = 0 and a.r <> b.r),
positives as (
  select a, anchor_id, b, vec_id as positive_id, score as positive_score from (
    select *, row_number() over (partition by a order by score desc, vec_id, b) as place
    from scored where same) where place <= {POSITIVES})
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from (
  select p.anchor_id, positive_id, s.vec_id as negative_id, positive_score,
         s.score as negative_score,
         row_number() over (partition by p.a, p.b order by s.score desc, s.vec_id, s.b) as rank
  from positives p join scored s on p.a = s.a and not s.same
    and {LEAST_PERCENT} * positive_score <= 100 * s.score
    and s.score <= positive_score) where rank <= {NEGATIVES}
"""
