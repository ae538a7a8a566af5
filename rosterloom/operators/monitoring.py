"""Time-based views of the pipeline: hourly figures, freshness, retention, notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom import vocabulary as V


def hourly_dashboard(calls: DataFrame) -> DataFrame:
    """Per hour: rows by outcome, credits, longest and 95th percentile duration.

    ``calls``: requested_at, status, credits, duration_ms.  The percentile is exact (the
    shortest duration that covers 95 % of the calls): durations are first counted per value,
    map-side, so an hour that holds most calls still shuffles one row per distinct duration.
    """
    hour = F.window("requested_at", "1 hour")["start"].alias("hour")
    figures = calls.groupBy(hour).agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in V.STATUSES],
        F.sum("credits").alias("credits"), F.max("duration_ms").alias("max_duration_ms"))
    counted = calls.groupBy(hour, "duration_ms").agg(F.count("*").alias("n"))
    upto = (Window.partitionBy("hour").orderBy("duration_ms")
            .rowsBetween(Window.unboundedPreceding, 0))
    ranked = (counted.withColumn("below", F.sum("n").over(upto))
              .withColumn("all", F.sum("n").over(Window.partitionBy("hour"))))
    p95 = ranked.filter(F.col("below") * 100 >= F.col("all") * 95).groupBy("hour").agg(
        F.min("duration_ms").alias("p95_duration_ms"))
    return figures.join(p95, "hour", "left")


def freshness_slo(batches: DataFrame, seconds: int = 600) -> DataFrame:
    """Slowest batch per five minutes against the freshness objective.

    ``batches``: batch_id, started_at, finished_at.
    """
    took = F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")
    return (batches.select("batch_id", F.col("finished_at"), took.alias("took"))
            .groupBy(F.window("finished_at", "5 minutes")["start"].alias("period_start"))
            .agg(F.count("*").alias("batches"), F.max("took").alias("slowest_seconds"),
                 F.count_if(F.col("took") > seconds).alias("late"))
            .withColumn("breached", F.col("slowest_seconds") > seconds))


def retention(table: DataFrame, date_column: str, days: int, today: Column) -> DataFrame:
    """Rows young enough to keep; on a partition column this prunes whole partitions."""
    return table.filter(F.col(date_column) > F.date_format(
        F.date_sub(today, days), "yyyy-MM-dd"))


def expired_partitions(table: DataFrame, date_column: str, days: int, today: Column) -> DataFrame:
    """Partitions a clean-up job drops."""
    return (table.filter(F.col(date_column) <= F.date_format(
        F.date_sub(today, days), "yyyy-MM-dd")).groupBy(date_column).agg(F.count("*").alias("rows")))


def batch_notifications(quality: DataFrame, row_errors: DataFrame) -> DataFrame:
    """One message per batch with crashed rows or warnings, ready for an alerts table."""
    crashed = row_errors.groupBy("batch_id").agg(
        F.count("*").alias("row_errors"),
        F.min("row_number").alias("first_row"), F.max("row_number").alias("last_row"))
    noted = (quality.join(crashed, "batch_id", "left").fillna(0, ["row_errors"])
             .filter((F.col("row_errors") > 0) | (F.col("warning_count") > 0)))
    span = F.when(F.col("row_errors") > 0, F.concat(
        F.lit(" (input rows "), F.col("first_row").cast("string"), F.lit(" to "),
        F.col("last_row").cast("string"), F.lit(")"))).otherwise("")
    why = F.when(F.col("warning_count") > 0, F.array_join("warnings", "; ")).otherwise("none")
    return noted.select(
        "batch_id", "batch_date", "row_errors", "warning_count",
        F.concat(F.lit("Batch "), "batch_id", F.lit(" completed with "),
                 F.col("row_errors").cast("string"), F.lit(" row error(s) out of "),
                 F.col("rows_valid").cast("string"), F.lit(" rows"), span, F.lit(" and "),
                 F.col("warning_count").cast("string"), F.lit(" data-quality warning(s): "), why,
                 F.lit(". Persons curated: "), F.col("persons").cast("string"),
                 F.lit(".")).alias("message"))
