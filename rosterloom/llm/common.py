"""What several operators share: reading tables, byte-level words, spreading ranks over tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterloom.session import cut_lineage, discard

#: XXH64 of 1 row in so many counts as one task's share when ranks are dealt out.
RANK_BUCKETS = 256


def read(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    """The named columns of a supplied table."""
    return spark.read.parquet(f"{folder}/{table}.parquet").select(*columns)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        begin = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(begin, i - begin)
                begin = i
                total = 0
            total += size
        if begin < len(sizes):
            yield batch.slice(begin)


def deal_ranks(df: DataFrame, keys: list[str], order: list[Column], name: str,
               buckets: int = RANK_BUCKETS) -> DataFrame:
    """Adds a gapless rank from 0 within ``keys`` without one task per key.

    Rows of a key are dealt into ``buckets`` by the hash of the ordering columns; the small
    table of bucket sizes is summed up, and rows are numbered inside their buckets only.  So
    the order of ranks is by bucket and then by ``order``.  ``df`` must be a stored table.
    Rows equal in every ordering column may swap their ranks.
    """
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    dealt = df.withColumn("__b", bucket)
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*keys, "__b").agg(F.count("*").alias("__n"))
    starts = sizes.select(*keys, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0))
                          .cast("long").alias("__start"))
    inside = Window.partitionBy(*keys, "__b").orderBy(*order)
    return (dealt.withColumn("__r", F.row_number().over(inside))
            .join(starts, [*keys, "__b"])
            .withColumn(name, (F.col("__start") + F.col("__r") - 1).cast("long"))
            .drop("__b", "__r", "__start"))


def deal_sums(df: DataFrame, keys: list[str], value: Column, order: list[Column], name: str,
              buckets: int = RANK_BUCKETS) -> DataFrame:
    """Adds the sum of ``value`` over the rows before, within ``keys``; else like :func:`deal_ranks`.

    ``order`` tells the rows of a key apart.
    """
    dealt = df.withColumn("__v", value).withColumn(
        "__b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*keys, "__b").agg(F.sum("__v").alias("__n")).select(
        *keys, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*keys, "__b").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    return (dealt.withColumn("__r", F.coalesce(F.sum("__v").over(inside), F.lit(0)))
            .join(starts, [*keys, "__b"])
            .withColumn(name, (F.col("__start") + F.col("__r")).cast("long"))
            .drop("__v", "__b", "__r", "__start"))


#: Bits of a screen at most: 32 MB, which every task gets.
SCREEN_BITS = 1 << 28


def screen(keys: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test that holds for every key in ``column`` (a long, not null), and for few others.

    A bitmap with 16 bits a key, up to a fixed size, is put together by Spark and goes to every task.
    With more keys than that it lets more others pass, but never turns a key away: use it to
    spare rows a shuffle, before an exact join.
    """
    count = keys.count()
    bits = 1 << 15
    while bits < 16 * count and bits < SCREEN_BITS:
        bits *= 2
    place = F.pmod(F.col(column), F.lit(bits))
    chunk = F.floor(place / 32_768)
    rows = keys.groupBy(chunk.cast("int").alias("chunk")).agg(F.expr(
        f"bitmap_construct_agg(pmod({column}, {bits}) % 32768)").alias("bitmap")).collect()
    table = np.zeros((bits // 32_768, 4096), np.uint8)
    for row in rows:
        table[row["chunk"]] = np.frombuffer(row["bitmap"], np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(table.ravel())

    @F.pandas_udf("boolean")
    def passes(key: pd.Series) -> pd.Series:
        at = key.to_numpy() % bits
        return pd.Series((shared.value[at >> 3] >> (at & 7) & 1).astype(bool))

    return passes


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: (node, root), root the least node.

    ``edges`` has columns a and b of one orderable type.  Each round points every node at the
    least node among its neighbours and itself (large-star, then small-star), which joins trees
    in a logarithmic number of rounds.  Minima are combined before the shuffle, and the joins
    are plain equi-joins that adaptive execution may split, so a hub is not one task's work.
    Every round is written to the shared folder.  Nodes without an edge do not appear.
    """
    pairs = cut_lineage(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def minima(directed: DataFrame) -> DataFrame:
        return directed.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))

    def summary(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")),
                            F.sum(F.crc32(F.concat_ws(",", "a", "b").cast("binary")))).first())

    state = summary(pairs)
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (both.join(minima(both), "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        large = cut_lineage(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").union(least.select("a", F.col("m").alias("b"))).distinct())
        done, pairs = pairs, cut_lineage(small)
        discard(done, large)
        after = summary(pairs)
        if after == state:
            roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
        state = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
