"""Running sums that do not put a whole group into one task.

A plain window partitioned by a batch or a provider sorts that whole group in one task.
Here each group is cut into blocks by a value of the row (so the cut is the same on every
re-run): windows run inside blocks, block totals, combined map-side, are summed over a
table with one row per block, and the two meet in an equi-join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.session import cut_lineage

ROWS_PER_BLOCK = 65_536


def row_block(column: str = "row_number", size: int | None = None) -> Column:
    return F.floor(F.col(column) / (size or ROWS_PER_BLOCK))


def running_sums(df: DataFrame, group: Sequence[str], block: Column, order: Sequence[str],
                 sums: Mapping[str, Column], inclusive: bool = False) -> DataFrame:
    """Adds one column per entry of ``sums``: its total over the earlier rows of the group.

    ``block`` must not decrease along ``order`` and group columns hold no nulls.  The row
    itself counts when ``inclusive``.
    """
    group, order = list(group), list(order)
    terms = df.withColumn("_block", block)
    for name, value in sums.items():
        terms = terms.withColumn(f"_v_{name}", value)
    upto = 0 if inclusive else -1
    inside = (Window.partitionBy(*group, "_block").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, upto))
    before = (Window.partitionBy(*group).orderBy("_block")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (terms.groupBy(*group, "_block")
               .agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
               .select(*group, "_block",
                       *[F.sum(f"_t_{n}").over(before).alias(f"_o_{n}") for n in sums]))
    local = terms
    for name in sums:
        local = local.withColumn(f"_l_{name}", F.sum(f"_v_{name}").over(inside))
    # The left side is already laid out by these keys, so the join adds no shuffle to it.
    met = local.join(offsets, [*group, "_block"])
    kept = [F.col(c) for c in df.columns if c not in sums]
    return met.select(*kept, *[
        (F.coalesce(F.col(f"_l_{n}"), F.lit(0)) + F.coalesce(F.col(f"_o_{n}"), F.lit(0))).alias(n)
        for n in sums])


def ordered_prefix(df: DataFrame, group: Sequence[str], order: Sequence[str],
                   values: Mapping[str, Column], combine=F.sum) -> DataFrame:
    """Adds to each row the combination (a sum, maximum, ...) of its group's earlier rows, or null.

    For groups of any size and values without natural blocks: rows are cut by ranges of group and
    order, combined inside their task, and shifted by what the tasks before hold, of which there is
    one small row a task and group.  ``order`` tells rows of a group apart; no nulls in either.
    """
    group, order = list(group), list(order)
    named = df.withColumns({f"_v_{n}": v for n, v in values.items()})
    laid = cut_lineage(named.repartitionByRange(*group, *order)
                       .withColumn("_task", F.spark_partition_id()))
    inside = (Window.partitionBy(*group, "_task").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    before = (Window.partitionBy(*group).orderBy("_task")
              .rowsBetween(Window.unboundedPreceding, -1))
    tasks = (laid.groupBy(*group, "_task").agg(*[combine(f"_v_{n}").alias(f"_t_{n}") for n in values])
             .select(*group, "_task", *[combine(f"_t_{n}").over(before).alias(f"_o_{n}")
                                        for n in values]))
    met = (laid.withColumns({f"_l_{n}": combine(f"_v_{n}").over(inside) for n in values})
           .join(tasks, [*group, "_task"]))

    return met.select(*df.columns, *[
        _COMBINED[combine](F.col(f"_l_{n}"), F.col(f"_o_{n}")).alias(n) for n in values])


def _added(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


_COMBINED = {F.sum: _added, F.max: F.greatest, F.min: F.least}
