"""Which batches hold whom: an index from identities to batches, kept up by publications.

An entry is (key, batch_date, batch_id), ``key`` being a hash of an id, an e-mail or a name.  Entries lie
by buckets of their keys, in levels: a publication fills the first level that is free with its own
entries and those of the levels below, as a binary counter carries.  So an entry is written again a
logarithmic number of times, and a request opens one bucket for each of its identities in each of
at most log2(publications) + 1 levels, however many batches there are.

The index may name too much (hashes that collide, batches that were built again), never too little:
what it names is opened and compared by ``erasure.subject_match``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.operators import erasure
from rosterloom.session import cut_lineage
from rosterloom.sources import snapshots
from rosterloom.sources.snapshots import Publication, Snapshot
from rosterloom.tables import PARTITION_COLUMN

BUCKETS = 64
BUCKET = "bucket"
ENTRY = f"key long, {PARTITION_COLUMN} string, batch_id string"


def _bucket():
    return F.lpad(F.pmod("key", F.lit(BUCKETS)).cast("string"), 3, "0")


def _level(number: int) -> str:
    return f"identities_{number}"


def _levels(at: Snapshot) -> list[int]:
    return sorted({int(name.rsplit("_", 1)[1]) for name, _ in at.writes
                   if name.startswith("identities_")})


def _entries(spark: SparkSession, folders: list[str], base: str) -> DataFrame:
    return (spark.read.schema(f"{ENTRY}, {BUCKET} string").option("basePath", base)
            .parquet(*folders).drop("write"))


def _whole(spark: SparkSession, root: str, level: int, at: Snapshot) -> DataFrame:
    return _entries(spark, snapshots.flat(at.folders(root, _level(level))),
                    f"{root}/data/{_level(level)}").drop(BUCKET)


def entries(spark: SparkSession, root: str) -> DataFrame:
    """The whole index."""
    at, every = snapshots.snapshot(spark, root), spark.createDataFrame([], ENTRY)
    for level in _levels(at):
        every = every.unionByName(_whole(spark, root, level, at))
    return every.distinct()


def add(entries: DataFrame, into: Publication) -> None:
    """Takes the entries of a publication's batches (``erasure.identity_entries``) into the index."""
    taken, level = _levels(into.after), 0
    while level in taken:
        level += 1
    every = entries.select("key", PARTITION_COLUMN, "batch_id")
    for below in range(level):
        every = every.unionByName(_whole(into.spark, into.root, below, into.after))
    every = every.distinct().withColumn(BUCKET, _bucket())
    days = into.spark.createDataFrame([], f"{BUCKET} string")
    into.put_days(_level(level), every, days, lambda w, target: w.parquet(target),
                  partition=BUCKET)
    for below in range(level):
        into.drop(_level(below))


def opened(spark: SparkSession, root: str, keys: DataFrame,
           at: Snapshot | None = None) -> dict[int, list[str]]:
    """By level, the folders that can hold the keys; at most :data:`BUCKETS` a level."""
    at = at or snapshots.snapshot(spark, root)
    wanted = {f"{BUCKET}={r[0]}" for r in keys.select(_bucket()).distinct().collect()}
    return {level: snapshots.flat({name: held for name, held in at.folders(
        root, _level(level)).items() if name in wanted}) for level in _levels(at)}


def batches(spark: SparkSession, root: str, requests: DataFrame) -> DataFrame:
    """The batches (batch_date, batch_id) that may hold a subject of the requests."""
    keys = erasure.request_keys(requests)
    found = spark.createDataFrame([], ENTRY)
    for level, folders in opened(spark, root, keys).items():
        if folders:
            found = found.unionByName(_entries(
                spark, folders, f"{root}/data/{_level(level)}").drop(BUCKET))
    return found.join(keys, "key", "left_semi").select(PARTITION_COLUMN, "batch_id").distinct()


def subject_match(requests: DataFrame, root: str, rows: DataFrame, rejected: DataFrame,
                  results: DataFrame) -> DataFrame:
    """``erasure.subject_match`` on the dates that the index names only.

    Tables that lie by ``batch_date`` are read there and nowhere else.
    """
    # No more dates than a commit has rows.
    days = [r[0] for r in batches(requests.sparkSession, root, requests)
            .select(PARTITION_COLUMN).distinct().collect()]
    touched = F.col(PARTITION_COLUMN).isin(days)
    return erasure.subject_match(requests, *[t.filter(touched) for t in (rows, rejected, results)])


def forget(spark: SparkSession, root: str, gone: DataFrame, left: DataFrame) -> None:
    """Takes entries out of the index: those of ``gone`` that are not in ``left`` too.

    Both are entries of the same batches, before and after rows were erased.  Only the buckets of
    what goes are written again.
    """
    entry = ["key", PARTITION_COLUMN, "batch_id"]
    drop = cut_lineage(gone.join(left, entry, "left_anti").distinct())
    publication = Publication(spark, root)
    for level, folders in opened(spark, root, drop, publication.after).items():
        if not folders:
            continue
        kept = (_entries(spark, folders, f"{root}/data/{_level(level)}")
                .join(drop, entry, "left_anti"))
        publication.put_days(_level(level), kept, spark.createDataFrame(
            [(f.rsplit("=", 1)[1],) for f in folders], f"{BUCKET} string"),
            lambda w, target: w.parquet(target), partition=BUCKET)
    publication.commit()
    snapshots.vacuum(spark, root)
