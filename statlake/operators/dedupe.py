"""Keep-last de-duplication.

``groupBy(key).agg(max_by(struct(rest), order))`` instead of a
``row_number`` window: the aggregate runs partially on the map side, so a key
that holds a third of all rows is reduced to one row per task before the
shuffle, and no task ever sorts a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _c(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def keep_last(df: DataFrame, key: list[str], order, keep_order: bool = False) -> DataFrame:
    """One row per ``key``: the one with the greatest ``order`` (a column name
    or a Column; structs compare field by field)."""
    order_col = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in key]
    picked = (df.withColumn("__order", order_col)
              .groupBy(*[_c(k) for k in key])
              .agg(F.max_by(F.struct(*[_c(c) for c in rest]), F.col("__order")).alias("__row")))
    out = picked.select(*[_c(k) for k in key],
                        *[F.col("__row").getField(c).alias(c) for c in rest])
    return out.select(*[_c(c) for c in df.columns]) if not keep_order else out
