"""Embedding near-duplicates by NN-descent.

1. Equal vectors of one label are one class with a multiplicity; classes are compared only within
   their label and dimension, by cosine in double precision.
2. The neighbour graph starts from random projections: sorted by the signs of random hyperplanes,
   classes are laid into leaves, several times; each keeps its nearest ones in its leaves.
3. Each turn joins every class's neighbours (both directions) with each other, for a
   neighbour's neighbour is likely a neighbour.  A class whose list is saturated, which
   means that its last neighbour still is a link, gets a list twice as long.
4. The audit compares a fixed set of classes with all others of their label, in blocks, and
   measures which share of their links the graph holds, in the label where it holds least.  Below
   ``RECALL`` there is another turn, up to ``TURNS``.
5. Lists that are full of a class's own component hide links to others.  So the descent goes on
   between components: from new hyperplanes, with lists that only take classes of other
   components.  Links found join components, and it goes on while any are found or the
   audit asks for more.  A recall below ``LEAST_RECALL`` after ``AUDITS`` fruitless rounds is an error.
6. Edges at or above the threshold are links; they join components.  Within components, classes
   meet once more in tiles, so that saturated lists lose nothing and link counts are exact.
   Tiles report counts, not pairs.

Vectors that are null, zero or hold null or non-finite components, and rows with a null label, link
with nothing and are their own component.  Repeated rows link with each other like any equal
vectors.  The component id is the least id; rows without an id can't name a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterloom.llm.common import components, read
from rosterloom.session import cut_lineage

THRESHOLD = 0.98
LIST, TURNS, STARTS = 8, 3, 8
LEAF = 256
PLANES = 24
TILE = 512
RECALL, LEAST_RECALL, AUDITED, AUDITS = 0.99, 0.9, 1000, 3
EDGE = "a bigint, b bigint, sim double"


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of an array column as vectors of length one, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _edges(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                       pa.array(sim, pa.float64())], ["a", "b", "sim"])


# ------------------------------------------------------------------ start

def start(classes: DataFrame, length: int = LIST, first_seed: int = 0,
          starts: int = STARTS) -> DataFrame:
    """Edges (a, b, sim) of the nearest classes in leaves of random projections.

    ``classes`` has label, id, root and vector; classes of one root make no edge.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, ids, roots, vectors = batch.columns
            sizes = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                rows = pa.array(np.nonzero(sizes == dim)[0])
                own = vectors.take(rows)
                x = _unit(own)
                for s in range(first_seed, first_seed + starts):
                    planes = np.random.default_rng([s, dim]).standard_normal((dim, PLANES))
                    bits = (x @ planes > 0).astype(np.int64)
                    code = bits @ (np.int64(1) << np.arange(PLANES)[::-1].astype(np.int64))
                    n = len(code)
                    yield pa.RecordBatch.from_arrays(
                        [label.take(rows), pa.array(np.full(n, dim, np.int32)),
                         pa.array(np.full(n, s, np.int32)), pa.array(code),
                         ids.take(rows), roots.take(rows), own],
                        ["label", "dim", "start", "code", "id", "root", "vector"])

    kind = classes.schema["vector"].dataType.simpleString()
    signed = classes.select("label", "id", "root", "vector").mapInArrow(
        sign, f"label {classes.schema['label'].dataType.simpleString()}, dim int, start int, "
              f"code bigint, id bigint, root bigint, vector {kind}")
    keys = ["start", "label", "dim", "code"]
    # By ranges, not by hash: a large label is cut wherever a task has enough of it.
    laid = signed.repartitionByRange(*keys).sortWithinPartitions(*keys, "id").select(
        F.xxhash64("start", "label", "dim").alias("block"), "id", "root", "vector")

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids, roots), vectors in _runs(batches, LEAF):
            if len(ids) < 2:
                continue
            sims = vectors @ vectors.T
            sims[roots[:, None] == roots[None, :]] = -2
            k = min(length, len(ids) - 1)
            near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            a, b = np.repeat(np.arange(len(ids)), k), near.ravel()
            a, b = a[sims[a, b] > -2], b[sims[a, b] > -2]
            yield _edges(ids[a], ids[b], sims[a, b])

    return laid.mapInArrow(leaves, EDGE)


def _runs(batches: Iterator[pa.RecordBatch], limit: int | None = None,
          ) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Runs of equal first columns, cut at ``limit`` rows: the columns between as arrays, and the
    last column as unit vectors."""
    key, held, size = None, [], 0

    def done() -> tuple[list[np.ndarray], np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*held)]
        return columns[:-1], columns[-1]

    for batch in batches:
        keys, *rest = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1])
        edges = [0, *(np.nonzero(keys[1:] != keys[:-1])[0] + 1).tolist(), len(keys)]
        for low, high in zip(edges, edges[1:]):
            if low == high:
                continue
            if keys[low] != key:
                if held:
                    yield done()
                key, held, size = keys[low], [], 0
            while low < high:
                upto = high if limit is None else min(high, low + limit - size)
                held.append([*(c[low:upto] for c in rest),
                             _unit(batch.columns[-1].slice(low, upto - low))])
                size += upto - low
                low = upto
                if size == limit:
                    yield done()
                    held, size = [], 0
    if held:
        yield done()


# ------------------------------------------------------------------ descent

def merged(edges: DataFrame, lengths: DataFrame | None, length: int) -> DataFrame:
    """The best edges of each class, as many as its list is long."""
    best = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    if lengths is None:
        best = best.withColumn("length", F.lit(length))
    else:
        best = best.join(lengths, "a", "left").withColumn(
            "length", F.coalesce("length", F.lit(length)))
    order = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    return best.withColumn("place", F.row_number().over(order)).where("place <= length")


def joined(graph: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """New edges among the neighbours of every class, where they improve a list."""
    lists = graph.groupBy("a").agg(F.min("sim").alias("worst"), F.max("length").alias("length"))
    both = graph.select(F.col("a").alias("at"), F.col("b").alias("id"), "sim").unionByName(
        graph.select(F.col("b").alias("at"), F.col("a").alias("id"), "sim"))
    order = Window.partitionBy("at").orderBy(F.desc("sim"), "id")
    # Two lists' length of neighbours for each class; later turns reach the others.
    around = (both.distinct().withColumn("place", F.row_number().over(order))
              .join(lists.select(F.col("a").alias("at"), "length"), "at", "left")
              .where(F.col("place") <= 2 * F.coalesce("length", F.lit(length))).drop("length")
              .join(lists.select(F.col("a").alias("id"), "worst"), "id", "left")
              .join(classes.select("id", "root", "vector"), "id"))
    laid = (around.select("at", "id", F.coalesce("worst", F.lit(-2.0)).alias("worst"), "root",
                          "vector")
            .repartition("at").sortWithinPartitions("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[np.ndarray]] = []
        for (ids, worst, roots), vectors in _runs(batches):
            sims = vectors @ vectors.T
            a, b = np.nonzero((sims > worst[:, None]) & (roots[:, None] != roots[None, :]))
            found.append([ids[a], ids[b], sims[a, b]])
            if len(found) == 1000:
                yield _edges(*map(np.concatenate, zip(*found)))
                found = []
        if found:
            yield _edges(*map(np.concatenate, zip(*found)))

    return laid.mapInArrow(run, EDGE)


def refine(classes: DataFrame, graph: DataFrame, threshold: float = THRESHOLD,
           length: int = LIST) -> DataFrame:
    """One turn of descent on the stored neighbour graph (a, b, sim, length, place)."""
    new = joined(graph, classes, length)
    # Saturated: the list is full and its last neighbour still is a link.
    lengths = graph.groupBy("a").agg(
        F.first("length").alias("length"), F.count("*").alias("n"),
        F.min("sim").alias("worst")).select("a", F.when(
            (F.col("n") >= F.col("length")) & (F.col("worst") >= threshold),
            F.col("length") * 2).otherwise(F.col("length")).alias("length"))
    return cut_lineage(merged(graph.select("a", "b", "sim").unionByName(new), lengths, length))


def audit(classes: DataFrame, roots: DataFrame, threshold: float = THRESHOLD,
          audited: int = AUDITED) -> float:
    """The share of links whose ends share a component (node, root), as the mean over those of
    a fixed set of classes that have links, in the label where it is least.

    Links inside a component are all counted later, so these are the links that are found.
    """
    # At most ``audited`` vectors go to every task.
    probes = classes.orderBy(F.xxhash64("id"), "id").limit(audited).select(
        "label", "id", "vector").collect()
    by: dict[tuple, list] = {}
    for p in probes:
        by.setdefault((p["label"], len(p["vector"])), []).append(p)
    table = {k: (np.array([p["id"] for p in v]),
                 np.array([p["vector"] for p in v], dtype=np.float64)) for k, v in by.items()}
    table = {k: (i, x / np.linalg.norm(x, axis=1, keepdims=True)) for k, (i, x) in table.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(0).to_pylist()
            sizes = pa.compute.list_value_length(batch.column(2)).to_pylist()
            rows: dict[tuple, list[int]] = {}
            for i, k in enumerate(zip(labels, sizes)):
                if k in table:
                    rows.setdefault(k, []).append(i)
            for k, own in rows.items():
                ids = batch.column(1).take(pa.array(own)).to_numpy(zero_copy_only=False)
                sims = table[k][1] @ _unit(batch.column(2).take(pa.array(own))).T
                a, b = np.nonzero((sims >= threshold) & (table[k][0][:, None] != ids[None, :]))
                yield _edges(table[k][0][a], ids[b], sims[a, b])

    true = classes.select("label", "id", "vector").mapInArrow(run, EDGE)
    held = (true.join(roots.toDF("a", "root_a"), "a", "left")
            .join(roots.toDF("b", "root_b"), "b", "left").groupBy("a").agg(F.avg(
                F.when(F.col("root_a") == F.col("root_b"), 1.0).otherwise(0.0)).alias("held")))
    shares: dict = {}
    named = {p["id"]: p["label"] for p in probes}
    for row in held.collect():  # one row for each audited class
        shares.setdefault(named[row["a"]], []).append(row["held"])
    return min((sum(x) / len(x) for x in shares.values()), default=1.0)


def between(classes: DataFrame, roots: DataFrame, seed: int, threshold: float,
            length: int) -> DataFrame:
    """Links (a, b) between classes of different components (node, root), by one round of descent
    whose lists take no class of the own component."""
    own = cut_lineage(classes.drop("root").join(roots.withColumnRenamed("node", "id"), "id", "left")
                      .withColumn("root", F.coalesce("root", "id")))
    graph = cut_lineage(merged(start(own, length, first_seed=seed), None, length))
    near = graph.select("a", "b", "sim").unionByName(joined(graph, own, length))
    return cut_lineage(near.where(F.col("sim") >= threshold).select("a", "b").distinct())


# ------------------------------------------------------------------ links

def counted(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, linked): how many rows of other classes of its component each class links to.

    ``members`` has root, id, n (multiplicity) and vector.  Components are cut into parts by the
    hash of ids, and every two parts meet in one cell.
    """
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("int")
                                        .alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least(F.col("part"), j).alias("i"), F.greatest(F.col("part"), j).alias("j")))
    laid = (members.join(sizes, "root").withColumn("part", part)
            .withColumn("cell", F.explode(cells))
            .select(F.xxhash64("root", "cell").alias("key"), "id", "n",
                    (F.col("part") == F.col("cell.i")).alias("low"),
                    (F.col("cell.i") == F.col("cell.j")).alias("own"), "vector")
            .repartition("key").sortWithinPartitions("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[np.ndarray]] = []
        for (ids, n, low, own), vectors in _runs(batches):
            linked = vectors @ vectors.T >= threshold
            if own[0]:
                np.fill_diagonal(linked, False)
            else:  # pairs inside a part are counted where the part meets itself
                linked &= low[:, None] != low[None, :]
            found.append([ids, linked @ n.astype(np.int64)])
            if len(found) == 1000:
                yield _sums(*map(np.concatenate, zip(*found)))
                found = []
        if found:
            yield _sums(*map(np.concatenate, zip(*found)))

    return laid.mapInArrow(run, "id bigint, linked bigint").groupBy("id").agg(
        F.sum("linked").alias("linked"))


def _sums(ids: np.ndarray, linked: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(linked, pa.int64())],
                                      ["id", "linked"])


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
                    label: str = "label", threshold: float = THRESHOLD, length: int = LIST,
                    recall: float = RECALL, turns: int = TURNS,
                    audits: int = AUDITS) -> DataFrame:
    """Every row's id, n_links, component_id and kept."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = (F.col(label).isNotNull() & F.col(vector).isNotNull() & finite
             & F.exists(vector, lambda x: x != 0))
    rows = cut_lineage(vectors.select(
        F.col(id_column).alias("vec_id"), F.col(label).alias("label"),
        F.col(vector).alias("vector"), F.coalesce(valid, F.lit(False)).alias("valid"))
        .withColumn("digest", F.sha2(F.col("vector").cast("string"), 256)))
    classes = cut_lineage(rows.where("valid").groupBy("label", "digest").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("n"),
        F.first("vector").alias("vector")).withColumn("id", F.monotonically_increasing_id()))

    classes = classes.withColumn("root", F.col("id"))
    graph = cut_lineage(merged(start(classes, length), None, length))
    for _ in range(turns):
        graph = refine(classes, graph, threshold, length)
        roots = cut_lineage(components(
            graph.where(F.col("sim") >= threshold).select("a", "b")))
        found = audit(classes, roots, threshold)
        if found >= recall:
            break
    idle, seed = 0, STARTS
    while idle < audits:
        links = between(classes, roots, seed, threshold, length)
        seed += STARTS
        if links.isEmpty():
            if found >= recall:
                break
            idle += 1
            continue
        # Components only grow, so this ends.
        roots = cut_lineage(components(links.unionByName(
            roots.where("node <> root").toDF("a", "b"))))
        found = audit(classes, roots, threshold)
    if found < LEAST_RECALL:
        raise RuntimeError(f"only {found:.3f} of the audited links were found")
    classes = classes.drop("root")
    inside = classes.join(roots.withColumnRenamed("node", "id"), "id")
    linked = counted(inside.select("root", "id", "n", "vector"), threshold)
    least = inside.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = (classes.join(roots.withColumnRenamed("node", "id"), "id", "left")
                .join(least, "root", "left").join(linked, "id", "left")
                .select("label", "digest", F.coalesce("component_id", "least")
                        .alias("component_id"),
                        (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    loose = rows.where("not valid").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    tied = rows.where("valid").select("vec_id", "label", "digest").join(
        by_class, ["label", "digest"]).select("vec_id", "n_links", "component_id")
    return tied.unionByName(loose).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_nndescent(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "embeddings", "vec_id", "embedding", "label"))
