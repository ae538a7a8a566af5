"""Merkle manifest of a dataset with proofs by pointer jumping.

1. Every row is a leaf: the digest of its fields.  Texts stay where they are read; only digests move.
2. Leaves get gapless positions within their source, by ranges: sorted into many tasks, counted per
   task and source, and shifted by the sums of the counts before.  No task holds a whole source.
3. Nodes: every ``FAN`` consecutive nodes of a level become one of the next, one grouping per level for
   all sources at once, until each source has its subroot; then likewise the subroots, in the order
   of their sources, until there is one root.
4. Proofs: each node points at its parent and holds the segment of the way there: its siblings on
   the left and on the right.  A self-join with the pointed-at nodes doubles the distance and
   appends their segment, so d levels need log2(d) joins.  Of inner nodes only those are carried
   on that a later join can ask for, and leaves that have reached the root are laid aside.
5. Folding a segment over a leaf gives the root it leads to: the proof's check.

A node's many leaves meet one pointed-at row.  The farther the pointer, the fewer such rows: where
Spark finds their table small it sends it to every task, otherwise it splits the hot ones.  Segments
are binary and grow with the depth, which is the logarithm of the number of rows.

Null fields have a digest input of their own (``-``), so null and empty differ.  Rows without a source
form a source, which comes first.  Rows of one id within a source stand in the order of their
leaves, null ids first; rows equal in everything hashed are interchangeable, and each has its place.
Texts of any length are digested whole.  An empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterloom.llm.common import read
from rosterloom.session import cut_lineage

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FAN = 3
#: The tree of subroots.
TOP = -1


def field(value: Column) -> Column:
    """A field's part of the leaf's input: ``-`` if null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)).cast("binary"), 256)


def positions(rows: DataFrame, group: str, order: list[str], name: str = "k") -> DataFrame:
    """Adds a gapless position from 0 within ``group``, by ``order``; ``rows`` is a stored table."""
    keys = [group, *order]
    laid = cut_lineage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                       .withColumn("__task", F.spark_partition_id())
                       .withColumn("__at", F.monotonically_increasing_id()))
    counts = laid.groupBy(group, "__task").agg(F.min("__at").alias("__first"),
                                               F.count("*").alias("__n"))
    # One row per task that holds some of the group.
    before = Window.partitionBy(group).orderBy("__task").rowsBetween(
        Window.unboundedPreceding, -1)
    shifts = counts.select(F.col(group).alias("__g"), F.col("__task").alias("__t"), (
        F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    return (laid.join(shifts, laid[group].eqNullSafe(shifts["__g"])
                      & (laid["__task"] == shifts["__t"]))
            .withColumn(name, F.col("__at") + F.col("__shift"))
            .drop("__task", "__at", "__g", "__t", "__shift"))


def levels(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level, and the last node of every tree.

    ``nodes`` has (tree, k, digest, n), n the number of nodes of its tree's level; ``most`` is the
    largest n.  A run is (tree, level, k, n, digest, parts): a node, the number of nodes on its
    level, and the digests below it.
    """
    runs, ended, level = [], nodes.where("n = 1").select("tree", "digest"), 0
    while most > 1:
        level += 1
        most = -(-most // FAN)
        run = cut_lineage(nodes.where("n > 1").groupBy(
            "tree", F.floor(F.col("k") / FAN).alias("k")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("k", "digest"))),
                        lambda x: x["digest"]).alias("parts"),
            F.first("n").alias("n")).select(
            "tree", F.lit(level).alias("level"), "k", F.ceil(F.col("n") / FAN).alias("n"),
            F.sha2(F.array_join("parts", "").cast("binary"), 256).alias("digest"), "parts"))
        runs.append(run)
        nodes = run.select("tree", "k", "digest", "n")
        ended = ended.unionByName(nodes.where("n = 1").select("tree", "digest"))
    return runs, ended


def _pointers(runs: list[DataFrame]) -> DataFrame:
    """(tree, level, k) -> parent (up_tree, up_level, up_k) with the segment on the way.

    A source's subroot is the node of its number on the lowest level of the top tree.
    """
    def joined(digests: Column) -> Column:
        return F.unhex(F.array_join(digests, ""))

    every = runs[0]
    for run in runs[1:]:
        every = every.unionByName(run)
    last = (F.col("n") == 1) & (F.col("tree") != TOP)
    return every.select(
        "tree", "level", (F.col("k") * FAN).alias("first"),
        F.when(last, F.lit(TOP)).otherwise(F.col("tree")).cast("long").alias("up_tree"),
        F.when(last, F.lit(0)).otherwise(F.col("level")).alias("up_level"),
        F.when(last, F.col("tree")).otherwise(F.col("k")).alias("up_k"),
        "parts", F.posexplode("parts").alias("pos", "own")).select(
        "tree", (F.col("level") - 1).alias("level"), (F.col("first") + F.col("pos")).alias("k"),
        "up_tree", "up_level", "up_k",
        F.array(F.struct(joined(F.slice("parts", F.lit(1), F.col("pos"))).alias("left"),
                         joined(F.slice("parts", F.col("pos") + 2, F.lit(FAN))).alias("right")))
        .alias("way"))


def _jump(rows: DataFrame, ahead: DataFrame) -> DataFrame:
    """Every row's pointer goes on to where the pointed-at node points; a root stays."""
    steps = ahead.select(F.col("tree").alias("up_tree"), F.col("level").alias("up_level"),
                         F.col("k").alias("up_k"), F.col("up_tree").alias("next_tree"),
                         F.col("up_level").alias("next_level"), F.col("up_k").alias("next_k"),
                         F.col("way").alias("rest"))
    own = [c for c in rows.columns if c not in ("up_tree", "up_level", "up_k", "way")]
    return rows.join(steps, ["up_tree", "up_level", "up_k"], "left").select(
        *own, F.coalesce("next_tree", "up_tree").alias("up_tree"),
        F.coalesce("next_level", "up_level").alias("up_level"),
        F.coalesce("next_k", "up_k").alias("up_k"),
        F.when(F.col("rest").isNull(), F.col("way")).otherwise(F.concat("way", "rest"))
        .alias("way"))


def proofs(leaves: DataFrame, pointers: DataFrame, root_level: int) -> DataFrame:
    """Every leaf with its whole way to the root, by doubling.

    ``leaves`` has (tree, k, ...), their node (tree, level, k) as in ``pointers``.
    """
    done = (F.col("up_tree") == TOP) & (F.col("up_level") == root_level)
    inner = (F.col("level") > 0) | (F.col("tree") == TOP)
    at = leaves.join(pointers, ["tree", "level", "k"], "left").select(
        *leaves.columns, F.coalesce("up_tree", "tree").alias("up_tree"),
        F.coalesce("up_level", "level").alias("up_level"), F.coalesce("up_k", "k").alias("up_k"),
        F.coalesce("way", F.array().cast(pointers.schema["way"].dataType)).alias("way"))
    moving, ahead, distance, arrived = cut_lineage(at), cut_lineage(pointers.where(inner)), 1, None
    while True:
        home = moving.where(done)
        arrived = home if arrived is None else arrived.unionByName(home)
        away = moving.where(~done)
        if away.isEmpty():
            return arrived
        # Pointers now span ``distance`` levels, so only these levels are asked for.
        moving = cut_lineage(_jump(away, ahead))
        distance *= 2
        wanted = (F.col("tree") == TOP) | (F.col("level") % distance == 0)
        ahead = cut_lineage(_jump(ahead.where(wanted), ahead))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def folded(start: Column, way: Column) -> Column:
    """The digest that a leaf and its siblings lead to."""
    return F.aggregate(way, start, lambda at, step: F.sha2(F.concat(
        _hex(step["left"]), at, _hex(step["right"])).cast("binary"), 256))


def manifest(rows: DataFrame, fields: list[str], id_column: str = "doc_id",
             source: str = "source", presented: dict[str, Column] | None = None) -> DataFrame:
    """A proof for every row: id, leaf, subroot, root, proof_sha256, folded_root, verified, way.

    ``fields`` are hashed in this order.  ``presented`` replaces columns as they are when proofs
    are checked, so ``folded_root`` is recomputed from those, with the siblings of ``rows``.
    ``way`` lists the siblings on the left and on the right (binary digests) from leaf to root.
    """
    now = {c: F.col(c) for c in fields} | (presented or {})
    leaves = cut_lineage(rows.select(
        F.col(id_column).alias("id"), F.col(source).cast("string").alias("source"),
        leaf([F.col(c) for c in fields]).alias("leaf"),
        leaf([now[c] for c in fields]).alias("shown")))
    placed = cut_lineage(positions(leaves, "source", ["id", "leaf"]))
    sources = cut_lineage(placed.groupBy("source").agg(F.count("*").alias("n"))
                          .withColumn("all", F.lit(0)))
    trees = cut_lineage(positions(sources, "all", ["source"], "tree").drop("all"))
    count, most = trees.agg(F.count("*"), F.max("n")).first()
    named = trees.select(F.col("source").alias("__s"), "tree", "n")
    ranked = cut_lineage(placed.join(named, placed["source"].eqNullSafe(named["__s"]))
                         .drop("__s", "source"))

    inside, subroots = levels(ranked.select("tree", "k", F.col("leaf").alias("digest"), "n"),
                              most or 0)
    subroots = cut_lineage(subroots.withColumnRenamed("digest", "subroot"))
    above, roots = levels(subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("k"),
        F.col("subroot").alias("digest"), F.lit(count).cast("long").alias("n")), count)
    first = roots.first()
    root = first["digest"] if first else None

    single = F.col("n") == 1
    at = ranked.select(F.when(single, F.lit(TOP)).otherwise(F.col("tree")).cast("long")
                       .alias("tree"), F.lit(0).alias("level"),
                       F.when(single, F.col("tree")).otherwise(F.col("k")).alias("k"),
                       F.col("tree").alias("own_tree"), "id", "leaf", "shown")
    if inside or above:
        found = proofs(at, _pointers(inside + above), len(above))
    else:  # one leaf at most
        found = at.withColumn("way", F.array().cast(
            "array<struct<left:binary,right:binary>>"))
    steps = F.transform("way", lambda s: F.concat(_hex(s["left"]), _hex(s["right"])))
    told = found.join(subroots.withColumnRenamed("tree", "own_tree"), "own_tree").withColumn(
        "folded_root", folded(F.col("shown"), F.col("way")))
    return told.select(
        F.col("id").alias(id_column), "leaf", "subroot", F.lit(root).alias("root"),
        F.sha2(F.array_join(steps, "").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified"), "way")


def tampered(text: Column, id_column: Column) -> Column:
    """Texts of every other id, by checksum, without their line ends."""
    chosen = F.crc32(id_column.cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", *FIELDS)
    return manifest(docs, FIELDS, presented={
        "text": tampered(F.col("text"), F.col("doc_id"))}).drop("way")


#: The query as DuckDB SQL: levels and proofs by recursion, the checksum bit by bit.
ORACLE = f"""
with recursive docs as (
  select *, row_number() over () as r, dense_rank() over (order by source nulls first) - 1 as t,
    case when xor(4294967295, list_reduce(
      list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''),
                                                       lambda c: ascii(c)::bigint)),
      lambda x, c: list_reduce(list_concat([xor(x, c)], range(8)),
        lambda y, i: case when y & 1 = 1 then xor(y >> 1, 3988292384::bigint)
                          else y >> 1 end))) % 2 = 0
    then replace(text, chr(10), '') else text end as shown_text from documents),
leaves as (
  select r, t, doc_id, sha256(
{" || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}, '-')" for c in FIELDS)}) as leaf,
    sha256({" || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}, '-')" for c in
                        FIELDS[:-1] + ["shown_text"])}) as shown from docs),
placed as (
  select *, row_number() over (partition by t order by doc_id nulls first, leaf) - 1 as k,
         count(*) over (partition by t) as n from leaves),
nodes as (
  select t, 0 as level, k, n, leaf as digest from placed
  union all
  select t, any_value(level) + 1, k // {FAN}, (any_value(n) + {FAN - 1}) // {FAN},
         sha256(string_agg(digest, '' order by k)) from nodes where n > 1 group by t, k // {FAN}),
subroots as (select t, digest as subroot from nodes where n = 1),
tops as (
  select 0 as level, t as k, count(*) over () as n, subroot as digest from subroots
  union all
  select any_value(level) + 1, k // {FAN}, (any_value(n) + {FAN - 1}) // {FAN},
         sha256(string_agg(digest, '' order by k)) from tops where n > 1 group by k // {FAN}),
every as (select * from nodes union all select -1, * from tops),
siblings as (
  select t, level, k,
    coalesce(lag(digest, 2) over w, '') || coalesce(lag(digest) over w, '') as before,
    coalesce(lead(digest) over w, '') || coalesce(lead(digest, 2) over w, '') as after
  from every where n > 1 window w as (partition by t, level, k // {FAN} order by k)),
inside as (
  select r, t, 0 as level, k, shown as folded, '' as proof from placed
  union all
  select i.r, i.t, i.level + 1, i.k // {FAN}, sha256(before || folded || after),
         proof || before || after
  from inside i join siblings s on i.t = s.t and i.level = s.level and i.k = s.k),
above as (
  select r, 0 as level, t as k, arg_max(folded, level) as folded, arg_max(proof, level) as proof
  from inside group by r, t
  union all
  select i.r, i.level + 1, i.k // {FAN}, sha256(before || folded || after),
         proof || before || after
  from above i join siblings s on s.t = -1 and i.level = s.level and i.k = s.k),
ended as (select r, arg_max(folded, level) as folded_root, sha256(arg_max(proof, level)) as p
          from above group by r)
select doc_id, leaf, subroot, digest as root, p as proof_sha256, folded_root,
       folded_root = digest as verified
from leaves join ended using (r) join subroots using (t) join tops on n = 1
"""
