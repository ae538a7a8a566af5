"""Clean-up of the tables that expire: each by its own age, all in one commit.

A table lies by the date of its rows' age (``batch_date``).  Dates wholly past the limit are dropped
without reading them, the one date the limit falls into is written again with the rows that
are young enough, and younger dates are not touched.  So a clean-up costs one date a table, however
large it is.  Afterwards nothing of the expired rows is left below the root.

A row goes when its age is the limit or more; rows without an age never expire and lie under the
date ``none``.  Times are UTC.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom import vocabulary as V
from rosterloom.sources import snapshots
from rosterloom.sources.snapshots import Publication
from rosterloom.tables import PARTITION_COLUMN

UNDATED = "none"


@dataclass(frozen=True)
class Expiry:
    """Rows of ``table`` go ``days`` after the time in their column ``age``."""

    table: str
    age: str
    days: int

    def limit(self, now: datetime) -> datetime:
        return now - timedelta(days=self.days)


#: What the tables that expire age by.
AGES = {"raw": "requested_at", "landing": "modificationTime", "quarantine": "at",
        "lookup_cache": "updated_at", "batch_claims": "claimed_at", "batch_counter": "updated_at",
        "month_counter": "updated_at", "exhausted_marker": "updated_at"}
RULES = tuple(Expiry(table, AGES[table], days) for table, days in V.RETENTION_DAYS.items())


def add(df: DataFrame, rule: Expiry, into: Publication) -> None:
    """Stores the rows of a table that expires, below the dates of their ages.

    The dates that ``df`` has rows of are replaced.
    """
    day = F.coalesce(F.date_format(rule.age, "yyyy-MM-dd"), F.lit(UNDATED))
    dated = df.withColumn(PARTITION_COLUMN, day)
    into.put_days(rule.table, dated, dated.select(PARTITION_COLUMN).distinct(),
                  lambda w, target: w.parquet(target))


def read(spark: SparkSession, root: str, table: str, schema) -> DataFrame:
    """A stored table; ``schema`` has its columns without the date it lies by."""
    dated = f"{schema}, {PARTITION_COLUMN} string"
    return snapshots.read(spark, root, table, dated, lambda reader, live: reader.parquet(*live))


def expired_days(spark: SparkSession, root: str, rule: Expiry,
                 now: datetime) -> tuple[list[str], str | None]:
    """Stored dates that are wholly past the limit, and the one it falls into if that is stored."""
    edge = rule.limit(now).strftime("%Y-%m-%d")
    stored = [folder.split("=", 1)[1]
              for folder in snapshots.snapshot(spark, root).folders(root, rule.table)]
    return [d for d in stored if d < edge and d != UNDATED], edge if edge in stored else None


def clean_up(spark: SparkSession, root: str, now: datetime,
             rules: tuple[Expiry, ...] = RULES) -> dict[str, list[str]]:
    """Takes expired rows out of all tables and deletes their files; tells the dates touched.

    The publisher runs it between its publications, like ``snapshots.vacuum``.
    """
    publication, touched = Publication(spark, root), {}
    for rule in rules:
        gone, edge = expired_days(spark, root, rule, now)
        if not gone and edge is None:
            continue
        days = [*gone, *([edge] if edge else [])]
        touched[rule.table] = days
        source = f"{root}/data/{rule.table}"
        # Only the edge is read; where it isn't stored any date gives the columns of no rows.
        folders = snapshots.snapshot(spark, root).folders(root, rule.table)[
            f"{PARTITION_COLUMN}={edge or days[0]}"]
        kept = (spark.read.option("basePath", source)
                .schema(_schema(spark, folders[0])).parquet(*folders).drop("write")
                .filter(F.col(rule.age) > F.lit(rule.limit(now).strftime(
                    "%Y-%m-%d %H:%M:%S.%f")).cast("timestamp"))
                .filter(F.lit(edge is not None)))
        publication.put_days(rule.table, kept, spark.createDataFrame(
            [(d,) for d in days], f"{PARTITION_COLUMN} string"),
            lambda w, target: w.parquet(target))
    if touched:
        publication.commit()
        snapshots.vacuum(spark, root)
    return touched


def _schema(spark: SparkSession, folder: str) -> str:
    """Columns of the files in a folder, and the date as text."""
    own = spark.read.parquet(folder).schema
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own),
                      f"{PARTITION_COLUMN} string"])


def expire_raw(spark: SparkSession, path: str, now: datetime,
               days: int = V.RETENTION_DAYS["raw"]) -> list[str]:
    """Deletes the folders (provider, batch_date) of ``store.write_raw_responses`` past the limit."""
    edge = (now - timedelta(days=days)).strftime("%Y-%m-%d")
    gone = []
    for provider in snapshots.names(spark, path):
        for day in snapshots.names(spark, f"{path}/{provider}"):
            if day.startswith(f"{PARTITION_COLUMN}=") and day.split("=", 1)[1] < edge:
                snapshots.delete(spark, f"{path}/{provider}/{day}")
                gone.append(f"{provider}/{day}")
    return gone
