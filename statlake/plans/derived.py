"""Tidy and wide tables derived from the driver's TPC-H-style tables.

``stats`` is the fact table every read operator is checked on:

* ``order_count`` by nation and by region, category = order priority and
  ``total``, unit ``orders``;
* ``order_value`` by nation, category ``total``, unit ``currency``, value =
  exact decimal sum of ``o_totalprice`` cast to double;
* the same two indicators by customer (area type ``customer``), so that the
  fact table grows linearly with the scale factor (about 3.3 rows per 10
  orders) and the read operators do work proportional to the data.

Plan: orders are pre-aggregated per (customer, year, priority) before any
join, so a customer holding a third of all orders shrinks to at most
years x priorities rows per task before the shuffle.  The join with
``customer`` is a shuffle join on the customer key, with customers as the hashed
side where they are too many for a broadcast, so that no task sorts orders;
``nation``/``region`` are dimension tables that Catalyst broadcasts on its size
estimate.  The table is the union of one branch per (indicator, area type), both
literal: a query that names them keeps one branch.  All branches read the same
pre-aggregated exchange.  Nations and regions are grouped from one small table by
nation, year and priority.  Customers are dealt by name, before their rows are
multiplied, to as many tasks as the number of orders asks for: what a task
groups, and what a caller does with its rows, stays the same for any input.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.session import scratch_path

# Fixed lineage of the derived table (run id, load time), so that a SQL
# oracle can reproduce it with literals.
STATS_SOURCE = "orders"
STATS_RUN_ID = "00000000-0000-4000-8000-000000000001"
STATS_LOADED_AT = dt.datetime(2024, 1, 1, 0, 0, 0)
STATS_LOADED_AT_SQL = "2024-01-01 00:00:00"

# The five TPC-H order priorities.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Orders whose facts by customer one task groups.
ORDERS_PER_TASK = 100_000
# Customers up to this many are left to a broadcast.
BROADCAST_CUSTOMERS = 200_000


def by_customer_name(located: DataFrame, n_orders: int) -> DataFrame:
    """Rows dealt by customer name: by a number of tasks that follows the orders
    or, where that is below the session's cores, as AQE sizes them."""
    tasks = -(-n_orders // ORDERS_PER_TASK)
    if tasks <= located.sparkSession.sparkContext.defaultParallelism:
        return located.repartition("c_name")
    return located.repartition(tasks, "c_name")


def stats(spark: SparkSession, sf_dir: str, kept: bool = False) -> DataFrame:
    """The fact table.  ``kept``: for callers that read it in several jobs, the
    pre-aggregated orders with their places are written once, below the checkpoint folder."""
    orders = table(spark, sf_dir, "orders")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    per_customer = (orders
                    .groupBy("o_custkey",
                             F.year("o_orderdate").cast("int").alias("year"),
                             F.col("o_orderpriority").alias("priority"))
                    .agg(F.count(F.lit(1)).alias("n"),
                         F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount")))
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    if customer.count() > BROADCAST_CUSTOMERS:
        customer = customer.hint("shuffle_hash")
    located = (per_customer
               .join(customer, per_customer.o_custkey == customer.c_custkey)
               .join(geo, F.col("c_nationkey") == geo.n_nationkey))
    if kept:
        path = scratch_path(spark, "located-orders")
        located.select("n_name", "r_name", "c_name", "year", "priority", "n", "amount").write.parquet(path)
        located = spark.read.parquet(path)
    by_nation = located.groupBy("n_name", "r_name", "year", "priority").agg(
        F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    by_name = by_customer_name(located.select("c_name", "year", "priority", "n", "amount"), orders.count())

    # One branch per (indicator, area type), both literal: a filter on them folds
    # the other branches away, and the branches share the aggregated orders.
    def branch(indicator, area_type, area, measure, unit, categories):
        rows = (by_name if area == "c_name" else by_nation).select(F.col(area).alias("area_name"), "year", measure.alias("measure"),
                              F.explode(F.array(*categories)).alias("category"))
        value = F.sum("measure").cast("double")
        return rows.groupBy("area_name", "year", "category").agg(value.alias("value")).select(
            F.lit(indicator).alias("indicator"), F.lit(area_type).alias("area_type"), "area_name", "year", "value",
            F.lit(unit).alias("unit"), "category", F.lit(STATS_SOURCE).alias("source_dataset"),
            F.lit(STATS_RUN_ID).alias("import_run_id"), F.to_timestamp(F.lit(STATS_LOADED_AT_SQL)).alias("loaded_at"),
            F.lit(f"orders:{indicator}").alias("data_version"))

    total = F.lit("total")
    areas = (("nation", "n_name"), ("region", "r_name"), ("customer", "c_name"))
    branches = [branch("order_count", kind, column, F.col("n"), "orders", [F.col("priority"), total])
                for kind, column in areas]
    branches += [branch("order_value", kind, column, F.col("amount"), "currency", [total])
                 for kind, column in areas if kind != "region"]
    out = branches[0]
    for more in branches[1:]:
        out = out.unionByName(more)
    return out


def year_range(spark: SparkSession, sf_dir: str) -> list[int]:
    """Years present in the orders (one tiny aggregate row)."""
    row = table(spark, sf_dir, "orders").agg(
        F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi")).first()
    return list(range(int(row["lo"]), int(row["hi"]) + 1))


def _whole(value_col):
    return F.col(value_col).cast("long")


def wide_years(spark: SparkSession, sf_dir: str, years: list[int] | None = None,
               stats_df: DataFrame | None = None, area_type: str = "customer") -> DataFrame:
    """Order counts of one area type with years as columns (strings), feature
    column = category: the shape ``Merkmal;Stadtteil;1995;…;2001``.  By
    customer the table grows with the scale factor."""
    years = years or year_range(spark, sf_dir)
    s = stats_df if stats_df is not None else stats(spark, sf_dir)
    rows = s.filter((F.col("indicator") == "order_count") & (F.col("area_type") == area_type))
    return (rows.groupBy(F.col("category").alias("Merkmal"), F.col("area_name").alias("Stadtteil"))
            .agg(*[F.max(F.when(F.col("year") == y, _whole("value"))).cast("string").alias(str(y))
                   for y in years]))


def wide_categories(spark: SparkSession, sf_dir: str, stats_df: DataFrame | None = None,
                    area_type: str = "customer") -> DataFrame:
    """One row per (area, year) with one text column per order priority and
    the date as ``31.12.<year>``: the shape ``Merkmal;Jahr;Stadtteil;<prio>…``."""
    s = stats_df if stats_df is not None else stats(spark, sf_dir)
    rows = s.filter((F.col("indicator") == "order_count") & (F.col("area_type") == area_type)
                    & (F.col("category") != "total"))
    return (rows.groupBy(F.col("area_name").alias("Stadtteil"), "year")
            .agg(*[F.max(F.when(F.col("category") == p, _whole("value"))).cast("string").alias(p)
                   for p in PRIORITIES])
            .select(F.lit("Auftraege").alias("Merkmal"),
                    F.concat(F.lit("31.12."), F.col("year").cast("string")).alias("Jahr"),
                    "Stadtteil", *PRIORITIES))
