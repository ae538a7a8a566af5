"""Credit protection: ceilings and caps, exhausted pools, the ledger and its gauges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.config import CreditLimits
from rosterloom.operators.prefix import ordered_prefix, row_block, running_sums
from rosterloom.session import cut_lineage
from rosterloom.vocabulary import CALL_KINDS

MONTH = ["provider", "month"]
POSITION = ["batch_id", "row_number"]


def month_of(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM")


def _closing_points(calls: DataFrame, opening: DataFrame, limits: CreditLimits) -> DataFrame:
    """(provider, month, kind) -> the call that fills the kind's ceiling.

    While both kinds are open, spend depends on the batch cap alone, so batches can be
    summed side by side; the first kind to fill up is then exact.  From there on the batches
    spend differently, so the sums are taken again with that kind closed, which fixes the
    next one.  Two kinds need two rounds, whatever the number of rows or batches.
    """
    ceilings = {k: v for k, v in limits.ceilings().items() if v is not None}
    point = "struct<batch_id:string,row_number:bigint>"
    spark = calls.sparkSession
    if not ceilings:
        return spark.createDataFrame([], f"provider string, month string, kind string, at {point}")
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).cast("long").alias("ceiling"))
                     for k, v in sorted(ceilings.items())])
    closed = calls.select(*MONTH).distinct().select(*MONTH, F.inline(each))
    # A ceiling already reached by the opening balance is closed before the first call.
    start = F.struct(F.lit("").alias("batch_id"), F.lit(0).cast("long").alias("row_number"))
    closed = (closed.join(opening.withColumnRenamed("spent", "opening"), [*MONTH, "kind"], "left")
              .withColumn("opening", F.coalesce("opening", F.lit(0)))
              .withColumn("at", F.when(F.col("opening") >= F.col("ceiling"), start.cast(point))))
    for _ in ceilings:
        spent = spend_in_batches(calls, closed, limits)
        totals = spent.groupBy(*MONTH, "kind", "batch_id").agg(F.sum("spend").alias("total"))
        offsets = (ordered_prefix(totals, [*MONTH, "kind"], ["batch_id"],
                                  {"before": F.col("total")})
                   .withColumn("before", F.coalesce("before", F.lit(0)))
                   .join(closed.filter(F.col("at").isNull()), [*MONTH, "kind"])
                   .withColumn("before", F.col("before") + F.col("opening"))
                   # Only the one batch per kind in which the ceiling is reached is looked at.
                   .filter((F.col("before") < F.col("ceiling"))
                           & (F.col("before") + F.col("total") >= F.col("ceiling")))
                   .select(*MONTH, "kind", "batch_id", "before", "ceiling"))
        reached = F.col("before") + F.col("kind_spent") + F.col("spend")
        filled = (spent.join(offsets, [*MONTH, "kind", "batch_id"])
                  .filter((F.col("spend") > 0) & (reached >= F.col("ceiling"))
                          & (reached - F.col("spend") < F.col("ceiling"))))
        first = filled.groupBy(*MONTH).agg(
            F.min(F.struct("batch_id", "row_number", "kind")).alias("first"))
        at = F.struct("first.batch_id", "first.row_number").cast(point)
        # A row per provider, month and kind: kept apart so that the next round does not
        # compute this one again for each of its uses.
        closed = cut_lineage(closed.join(first, MONTH, "left").withColumn(
            "at", F.coalesce("at", F.when(F.col("first.kind") == F.col("kind"), at))).drop("first"))
    return closed.select(*MONTH, "kind", "at")


def spend_in_batches(calls: DataFrame, closed: DataFrame, limits: CreditLimits) -> DataFrame:
    """Each call with ``month_open`` and what it would ``spend``.

    ``batch_spent`` and ``kind_spent`` are the batch's spend before it, in all and by its
    kind.  Admitted calls are the batch's first ones (a full batch stays full), so plain
    running sums give both in one pass.
    """
    point = F.struct(*POSITION)
    # One row per provider, month and kind: far below any broadcast limit per month of data,
    # but left to the planner's own size check.
    marked = (calls.join(closed.select(*MONTH, "kind", "at"), [*MONTH, "kind"], "left")
              .withColumn("month_open", F.col("at").isNull() | (point <= F.col("at")))
              .drop("at"))
    wanted = F.when(F.col("month_open"), F.col("credits")).otherwise(0)
    sums = {"batch_spent": wanted}
    for kind in CALL_KINDS:
        sums[f"spent_{kind}"] = F.when(F.col("kind") == kind, wanted).otherwise(0)
    summed = running_sums(marked, [*MONTH, "batch_id"], row_block(), ["row_number"], sums)
    under_cap = (F.lit(True) if limits.per_batch is None
                 else F.col("batch_spent") < limits.per_batch)
    by_kind = F.lit(0)
    for kind in CALL_KINDS:
        by_kind = F.when(F.col("kind") == kind, F.col(f"spent_{kind}")).otherwise(by_kind)
    return (summed.withColumn("spend", F.when(under_cap, wanted).otherwise(0))
            .withColumn("kind_spent", by_kind)
            .drop(*[f"spent_{kind}" for kind in CALL_KINDS]))


def budget_admission(calls: DataFrame, opening: DataFrame, limits: CreditLimits) -> DataFrame:
    """Which calls may be made, in batch and row order, and why the others may not.

    ``calls``: provider, month, batch_id, row_number, kind, credits (what the call would
    cost).  ``opening``: provider, month, kind, spent.  A kind stops once its month's spend
    has reached the ceiling, any call stops once its batch has spent the cap.
    """
    closed = _closing_points(calls, opening, limits)
    spent = spend_in_batches(calls, closed, limits)
    ceiling = {k: F.lit(f"{k} credit budget: monthly ceiling ({v}) reached")
               for k, v in limits.ceilings().items() if v is not None}
    monthly = F.lit(None).cast("string")
    for kind, text in ceiling.items():
        monthly = F.when(F.col("kind") == kind, text).otherwise(monthly)
    capped = F.lit(None).cast("string") if limits.per_batch is None else F.when(
        F.col("batch_spent") >= limits.per_batch,
        f"credit budget: batch cap ({limits.per_batch}) reached")
    reason = F.when(~F.col("month_open"), monthly).otherwise(capped)
    return spent.select(*calls.columns, reason.isNull().alias("admitted"), reason.alias("reason"))


def pool_exhausted(calls: DataFrame) -> DataFrame:
    """``exhausted``: an earlier call of the same provider, month and kind met a 402.

    Only the first 402 matters, so a map-side combined minimum replaces a running window.
    ``calls`` is in (requested_at, call_id) order.
    """
    point = F.struct("requested_at", "call_id")
    first = (calls.filter(F.col("http_status") == 402)
             .groupBy("provider", "month", "kind").agg(F.min(point).alias("first_402")))
    return (calls.join(first, ["provider", "month", "kind"], "left")
            .withColumn("exhausted", F.coalesce(point > F.col("first_402"), F.lit(False)))
            .withColumn("message", F.when(F.col("exhausted"), F.concat(
                F.lit("provider reported "), F.col("kind"),
                F.lit(" credits exhausted (HTTP 402)"))))
            .drop("first_402"))


def credit_ledger(results: DataFrame) -> DataFrame:
    """Ledger rows of finished lookups: credits per provider, month, batch and kind."""
    return (results.filter(F.col("credits") > 0)
            .groupBy("provider", "month", "batch_id", "kind")
            .agg(F.sum("credits").alias("credits")))


def ledger_balance(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("provider", "month", "kind").agg(F.sum("credits").alias("spent"))


def credit_gauges(calls: DataFrame) -> DataFrame:
    """Month-to-date credits of the call's kind after every call.

    Calls are cut by the second for the running sum, so a second of one provider and kind is the
    most one task sorts; a month has too few seconds for their totals to be a burden.
    """
    second = F.date_trunc("second", F.col("requested_at"))
    return running_sums(calls, ["provider", "month", "kind"], second, ["requested_at", "call_id"],
                        {"month_to_date": F.col("credits")}, inclusive=True)


def credit_alarm(gauges: DataFrame, limits: CreditLimits, fraction: float = 0.9) -> DataFrame:
    """Highest gauge per five minutes against the alarm threshold of its kind.

    Periods without data keep the last state, so only periods with data get a row;
    ``latest`` marks the one whose state holds now.
    """
    threshold = F.lit(None).cast("long")
    for kind, ceiling in limits.ceilings().items():
        if ceiling is not None:
            mark = F.ceil(F.lit(float(ceiling)) * F.lit(fraction))
            threshold = F.when(F.col("kind") == kind, mark).otherwise(threshold)
    periods = (gauges.groupBy("provider", "kind", F.window("requested_at", "5 minutes").alias("w"))
               .agg(F.max("month_to_date").alias("gauge"))
               .select("provider", "kind", F.col("w.start").alias("period_start"), "gauge")
               .withColumn("threshold", threshold)
               .withColumn("alarm", F.col("gauge") >= F.col("threshold")))
    newest = periods.groupBy("provider", "kind").agg(F.max("period_start").alias("newest"))
    return (periods.join(newest, ["provider", "kind"])
            .withColumn("latest", F.col("period_start") == F.col("newest")).drop("newest"))
