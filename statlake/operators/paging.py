"""Ordered pages of a DataFrame.

``ordered_page`` is one declarative plan for every offset: Spark keeps the
``offset + limit`` first rows per task and merges them
(``TakeOrderedAndProject``), or sorts by ranges beyond its own
``topKSortFallbackThreshold``.  Nothing runs while the plan is built.

The cost of an offset grows with it, as in any engine.  Readers that walk
through a long result use ``after``: the order columns of the last row seen
become a filter, so every page costs the same, wherever it is.

``numbered`` gives every row its place in a total order without one window over
all rows: ranges are sorted by their own tasks, and only the tasks' row counts
meet.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.session import scratch_path


def ordered_page(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    return df.orderBy(*order).offset(int(offset or 0)).limit(int(limit))


def after(df: DataFrame, order: list[str], last: tuple) -> DataFrame:
    """Rows behind ``last`` (values of the order columns) in ascending order.
    The first column's bound is also stated alone, so that it reaches the scan."""
    if len(last) != len(order):
        raise ValueError(f"need a value for each of {order}")
    steps = [reduce(lambda a, b: a & b, [*(F.col(c) == F.lit(v) for c, v in zip(order[:k], last)),
                                         F.col(order[k]) > F.lit(last[k])]) for k in range(len(order))]
    return df.where(F.col(order[0]) >= F.lit(last[0])).where(reduce(or_, steps))


def numbered(df: DataFrame, *order, name: str = "position") -> DataFrame:
    """``df`` with the place (from 1) of every row in the order of the given
    columns.  The order should be total.  Rows are clustered by range, sorted
    within ranges and written once, which fixes both; a row's place is its number
    within its range plus the rows of the ranges before, one small row per range."""
    path = scratch_path(df.sparkSession, "numbered")
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumn("__row", F.monotonically_increasing_id()).write.parquet(path))
    rows = df.sparkSession.read.parquet(path)
    task, within = F.shiftright("__row", 33), F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))
    counts = rows.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__task", (F.sum("__n").over(Window.orderBy("__task")) - F.col("__n")).alias("__before"))
    return (rows.withColumn("__task", task).join(before, "__task")
            .withColumn(name, F.col("__before") + within + 1).drop("__task", "__row", "__before"))
