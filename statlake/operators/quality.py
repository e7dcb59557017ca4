"""Data-quality checks as single aggregates (never per row in Python)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.columns import year_in_range
from statlake.schema import DEFAULT_CATEGORY, KEY, REQUIRED


def null_violations(df: DataFrame, columns=None) -> DataFrame:
    """One row: number of NULLs per required column."""
    columns = columns or [c for c in REQUIRED if c in df.columns]
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def duplicate_keys(df: DataFrame, key=None) -> DataFrame:
    """Keys that occur more than once, with their count."""
    key = key or KEY
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def dropna_required(df: DataFrame, columns=None) -> DataFrame:
    return df.dropna(subset=columns or [c for c in REQUIRED if c in df.columns])


def fill_category(df: DataFrame) -> DataFrame:
    return df.fillna({"category": DEFAULT_CATEGORY})


def non_finite(c):
    return F.isnan(c) | (F.abs(c) == F.lit(float("inf")))


def staged_violations(df: DataFrame) -> DataFrame:
    """Everything a publish must refuse, in one pass: NULLs in required
    columns, non-finite values, years out of range, duplicate keys."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED]
    return df.agg(F.count(F.lit(1)).alias("rows"), *nulls,
                  F.count_if(non_finite(F.col("value"))).alias("non_finite_values"),
                  F.count_if(F.col("year").isNotNull() & ~year_in_range(F.col("year")))
                  .alias("years_out_of_range"),
                  (F.count(F.lit(1)) - F.count_distinct(F.struct(*KEY))).alias("duplicate_keys"))
