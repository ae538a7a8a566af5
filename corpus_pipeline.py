"""Raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm import decontaminate, packing, quality, secrets, simhash
from rosterloom.llm.common import read
from rosterloom.session import scratch_path


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores as good; the others go."""
    return quality.good_documents(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.deduplicated(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs."""
    return decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking credentials masked and ``n_chars`` counted anew."""
    done = secrets.redacted(docs)
    return done.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.coalesce(
        F.char_length("text").cast("long"), F.col("n_chars"))))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document with its sequence and offset."""
    return packing.pack(docs, ["doc_id"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality", good), ("near_duplicates", distinct), ("benchmark", unseen),
          ("secrets", masked), ("packing", packed)]

#: Fingerprints, rule fitting and the genetic algorithm have no SQL form; tests/llm compares the
#: stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
