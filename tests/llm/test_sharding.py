import pytest
from helpers import documents, prose
from pyspark.sql import functions as F

from rosterloom.llm import sharding


def shard(docs, **options):
    marked = docs.withColumn("member", F.lit("clash"))
    return sharding.shard_documents(marked, F.sha2("text", 256), ["doc_id", "member"],
                                    **options).toPandas()


def lawful(rows, n, shards):
    assert len(rows) == n
    counts = rows.groupby("shard").size().reindex(range(shards), fill_value=0)
    assert counts.max() - counts.min() <= 1
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))


def test_groups_move_together_and_counts_stay_even(spark):
    texts = [prose(8, i // 3) for i in range(120)] + [prose(9, 500 + i) for i in range(83)] + [
        None] * 5 + [""] * 3
    rows = shard(documents(spark, texts), shards=7)
    lawful(rows, len(texts), 7)
    where = dict(zip(rows.doc_id, rows.shard))
    assert sum(len({where[i + k] for k in range(3)}) > 1 for i in range(0, 120, 3)) <= 2


def test_groups_that_fill_shards_exactly_are_never_split(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"),
                                    F.floor(F.col("id") / 5).cast("string").alias("text"))
    rows = shard(docs)
    lawful(rows, 4000, 40)
    assert (rows.groupby(rows.doc_id // 5).shard.nunique() == 1).all()


def test_groups_of_many_sizes_are_split_at_the_ends_of_rooms_only(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.floor(
        F.sqrt(F.col("id") * 2.0)).cast("string").alias("text"))  # sizes 1, 2, 3, ...
    rows = shard(docs, shards=12)
    lawful(rows, 3000, 12)
    split = rows.groupby(((rows.doc_id * 2.0) ** 0.5).astype(int)).shard.nunique() > 1
    assert split.sum() <= 11


def test_rooms_for_a_few_groups():
    rooms = [4, 7, 2]
    assert sharding._fit([(1, 3), (2, 6), (3, 4)], rooms) == [
        (2, 6, 1), (3, 4, 0), (1, 2, 2), (1, 3, 1)]
    assert rooms == [0, 0, 0]


def test_propagation_returns_the_best_state(spark):
    links = spark.range(900).select(F.col("id").alias("member"), (F.col("id") % 60).alias("hub"))

    def cut(state):
        return sharding._cut(links.join(state, "member").groupBy("hub", "shard").agg(
            F.count("*").alias("n")))

    start = cut(sharding._start(links.select("member"), 6))
    ends = [cut(sharding.propagate(links, 900, 6, turns)) for turns in (1, 3, 8)]
    assert start > ends[0] >= ends[1] >= ends[2]


@pytest.mark.parametrize("texts", [
    ["same"] * 60, ["same"] * 40 + [prose(5, i) for i in range(20)],
    [prose(5, i // 2) for i in range(60)], [prose(5, i) for i in range(60)], ["a", "b", None]])
def test_law_holds_for_hot_groups_and_few_rows(spark, texts):
    lawful(shard(documents(spark, texts), shards=8), len(texts), 8)


def test_repeated_rows_and_null_ids(spark):
    docs = documents(spark, ["t", "t", "u", "v"], ids=[1, 1, None, None])
    lawful(shard(docs.union(docs), shards=3), 8, 3)


def test_empty_table(spark):
    assert len(shard(documents(spark, ["a"]).limit(0), shards=4)) == 0
