"""The same plans as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rosterloom.operators import breaker
from rosterloom.operators.validation import CLAIM_DAYS, first_claims
from rosterloom.session import cut_lineage, side_by_side
from rosterloom.sources import landing, snapshots
from rosterloom.sources.landing import FILE_SCHEMA
from rosterloom.sources.snapshots import Publication


def upload_stream(spark: SparkSession, path: str, checkpoint: str,
                  build: Callable[[DataFrame, int], None], pattern: str = "*.csv",
                  files_per_trigger: int = 1000) -> StreamingQuery:
    """Runs ``build`` on every micro-batch of newly landed files, each file once.

    The checkpoint remembers which files were taken; ``build`` writes by dynamic partition
    overwrite, so a micro-batch replayed after a failure leaves the same tables.
    """
    files = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
             .option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", files_per_trigger).load(path))
    return (files.writeStream.foreachBatch(build).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def curated_stream(spark: SparkSession, path: str, root: str, checkpoint: str,
                   build: Callable[[DataFrame, DataFrame, Publication], None],
                   stream: str = "uploads", batch_of: Column | None = None,
                   days: int = CLAIM_DAYS, **options) -> StreamingQuery:
    """Landed files to curated tables, each batch once, each micro-batch whole or not at all.

    ``build`` gets a micro-batch's registrants (with batch_id; each read parses the files), its batches
    (batch_date, batch_id) and a publication to put their tables into.  Claims of the batches and the mark of the
    micro-batch go into the same commit, so one that was stopped half-way has left nothing to be
    seen, and one that is replayed after its commit is recognised and left out.  A batch that
    an earlier micro-batch claimed less than ``days`` before its upload is a repeated delivery.
    """
    batch_of = F.col("path") if batch_of is None else batch_of

    def take(files: DataFrame, epoch: int) -> None:
        publication = Publication(spark, root)
        if publication.before.marks.get(stream, -1) >= epoch:
            return
        named = files.withColumn("batch_id", batch_of)
        uploads = cut_lineage(named.groupBy("batch_id").agg(
            F.max("modificationTime").alias("claimed_at")))

        def held(at: snapshots.Snapshot) -> DataFrame:
            return snapshots.read(spark, root, "claims", UPLOAD_CLAIMS,
                                  lambda reader, live: reader.parquet(*live), at)

        first = uploads.agg(F.date_sub(F.min("claimed_at").cast("date"), days)).first()[0]
        recent = held(publication.before).filter(F.col("batch_date") >= F.lit(str(first))).select(
            "batch_id", F.col("claimed_at").alias("held_at"))
        alive = F.col("claimed_at") < F.col("held_at") + F.make_dt_interval(F.lit(days))
        repeated = uploads.join(recent, "batch_id").filter(alive).select("batch_id")
        claims = cut_lineage(uploads.join(repeated, "batch_id", "left_anti").withColumn(
            "batch_date", F.date_format("claimed_at", "yyyy-MM-dd")))
        # No more rows than a trigger takes files.
        _, rows = landing.registrants_of(named.join(F.broadcast(
            claims.select("batch_id", "batch_date")), "batch_id"))
        built = publication.batches(claims)
        side_by_side(
            spark, lambda: build(rows.drop("path"), built, publication),
            lambda: publication.put("claims", claims, built, held,
                                    lambda w, target: w.parquet(target)))
        publication.commit(stream, epoch)

    return upload_stream(spark, path, checkpoint, take, **options)


UPLOAD_CLAIMS = "batch_id string, claimed_at timestamp, batch_date string"
BREAKER_STATES = "provider string, failures int, until long, epoch long"
CLAIMS = "batch_id string, execution_id string, triggered_at timestamp, slice long, epoch long"


def first_deliveries(triggers: DataFrame, target: str, checkpoint: str,
                     days: int = CLAIM_DAYS) -> StreamingQuery:
    """Writes the deliveries that win their batch: the first, and each first one after a claim ran
    out.

    A micro-batch is taken in slices of ``days``, in time order.  Within a slice a batch has one
    winner at most, and only winners of this slice and the one before can still hold a claim, so
    nothing else of the target is read.  A replayed micro-batch overwrites its own winners.
    """
    spark = triggers.sparkSession
    width = days * 86_400
    (spark.createDataFrame([], CLAIMS).write.mode("append").partitionBy("slice", "epoch")
     .parquet(target))

    def take(batch: DataFrame, epoch: int) -> None:
        rows = cut_lineage(batch.select("batch_id", "execution_id", "triggered_at").withColumn(
            "slice", F.floor(F.unix_timestamp("triggered_at") / width)))
        # As many slices as the micro-batch spans, not as it has rows.
        for number in sorted(r[0] for r in rows.select("slice").distinct().collect()):
            claims = (spark.read.schema(CLAIMS).parquet(target)
                      .filter((F.col("slice") == number - 1)
                              | ((F.col("slice") == number) & (F.col("epoch") != epoch))))
            won = first_claims(rows.filter(F.col("slice") == number), claims, days)
            (won.withColumn("slice", F.lit(number)).withColumn("epoch", F.lit(epoch).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("slice", "epoch").parquet(target))

    return (triggers.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def breaker_stream(calls: DataFrame, target: str, checkpoint: str, threshold: int = 3,
                   cooldown_seconds: int = 300) -> StreamingQuery:
    """The circuit breaker over calls that arrive in time order, micro-batch by micro-batch.

    Below ``target`` a micro-batch leaves its decisions and each provider's state behind it, by
    its number.  The next one goes on from there: its calls are cut into slices that are judged
    side by side, so no provider's calls meet in one task.  A replayed micro-batch starts from the
    same states and overwrites its own rows.
    """
    spark = calls.sparkSession

    def take(batch: DataFrame, epoch: int) -> None:
        rows = cut_lineage(batch)
        (spark.createDataFrame([], BREAKER_STATES).write.mode("append").partitionBy("epoch")
         .parquet(f"{target}/states"))
        earlier = spark.read.schema(BREAKER_STATES).parquet(f"{target}/states").filter(
            F.col("epoch") < epoch)
        last = earlier.agg(F.max("epoch")).first()[0]
        entry = None if last is None else cut_lineage(
            earlier.filter(F.col("epoch") == last).drop("epoch"))
        decided, states = breaker.continued(rows, entry, threshold, cooldown_seconds)
        decided.write.mode("overwrite").parquet(f"{target}/decisions/epoch={epoch}")
        # States last: a micro-batch without them has not happened.
        states.write.mode("overwrite").parquet(f"{target}/states/epoch={epoch}")

    return (calls.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def credit_totals_stream(calls: DataFrame) -> DataFrame:
    """Credits spent so far per provider, month and kind, updated with every micro-batch."""
    month = F.date_format("requested_at", "yyyy-MM").alias("month")
    return calls.groupBy("provider", month, "kind").agg(F.sum("credits").alias("month_to_date"))


def hourly_stream(calls: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Rows and credits per hour and outcome so far; an hour's state goes once the watermark
    passed it.  Run it in update mode, so that hours still open are given too."""
    return (calls.withWatermark("requested_at", lateness)
            .groupBy(F.window("requested_at", "1 hour").alias("w"), "status")
            .agg(F.count("*").alias("rows"), F.sum("credits").alias("credits"))
            .select(F.col("w.start").alias("hour"), "status", "rows", "credits"))


def run_to_table(df: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Drives a streaming DataFrame over everything available, into Parquet files.

    In update mode each micro-batch's rows lie under its number; :func:`latest` reads them.
    """
    if mode == "append":
        query = (df.writeStream.format("parquet").option("path", target)
                 .option("checkpointLocation", checkpoint).outputMode("append")
                 .trigger(availableNow=True).start())
    else:
        def write(batch: DataFrame, epoch: int) -> None:
            if mode == "update":
                batch.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")
            else:
                batch.write.mode("overwrite").parquet(target)

        query = (df.writeStream.foreachBatch(write).outputMode(mode)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def latest(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The last row of each key that an update stream has written."""
    rows = spark.read.parquet(target)
    values = [c for c in rows.columns if c not in (*keys, "epoch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "epoch").alias("v")).select(
        *keys, "v.*")
