"""Plan-shape guards: the physical plans keep the properties the design relies
on at scale (no pair-producing joins, no Python in query plans, partial
aggregation before shuffles, pruning at the scan, bounded window pages)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from statlake.plans import registry
from statlake.operators import query as q
from statlake.operators.dedupe import keep_last
from statlake.operators.publish import FactStore
from statlake.operators.reshape import RunContext
from statlake.plans.derived import stats
from tests.conftest import SMOKE_DIR


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


registry.load_all()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_pair_joins_or_python(spark, name):
    plan = plan_of(E.queries()[name](spark, SMOKE_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in plan, f"{name}: {bad}"


def test_keep_last_aggregates_before_the_shuffle(spark):
    # one key holds a third of the rows
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ord"), (F.col("id") * 2).alias("v"))
    out = keep_last(df, ["k"], "ord")
    plan = plan_of(out)
    assert "partial_max_by" in plan
    assert plan.index("partial_max_by") > plan.index("Exchange")  # partial sits below it
    row = out.where("k = 0").first()
    assert row["ord"] == 2997


def test_store_reads_prune_and_push_down(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "store"))
    run = RunContext("stats", "v")
    store.begin(run)
    store.commit(stats(spark, SMOKE_DIR), run)
    snap = store.snapshot()
    df = q.ranking(snap, "order_count", "customer", 1998, categories=["total"], limit=10)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text
    filters = text.split("PartitionFilters: [")[1]
    assert "isnotnull(indicator" in filters and "import_run_id" in filters
    assert "EqualTo(year,1998)" in text
    assert "Exchange" not in text


def test_bulk_rankings_are_bounded_before_the_shuffle(spark):
    plan = plan_of(E.queries()["bulk_ranking"](spark, SMOKE_DIR))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", ["bulk_timeseries", "bulk_timeseries_deep"])
def test_bulk_time_series_read_the_facts_once(spark, name):
    """Page and total come from one pass; each request's own cut lies between the two exchanges."""
    plan = plan_of(E.queries()[name](spark, SMOKE_DIR))
    # the derived table has five branches; requests with literal names leave one
    assert plan.count("orders.parquet") == (1 if name == "bulk_timeseries" else plan_of(stats(spark, SMOKE_DIR)).count("orders.parquet"))
    parts = plan.split("Exchange hashpartitioning(request_id")
    assert any("salt" in p.split("\n")[0] for p in parts[1:])
    cut = plan.index("part_rn"), plan.index("greatest((offset")
    assert all(x > 0 for x in cut)


def test_bulk_over_a_store_is_bounded_and_pruned(spark, tmp_path):
    """With totals from the summaries the parts are cut before they are shuffled,
    and the items' scopes and years are predicates of the scan."""
    from statlake.operators.bulk import REQUEST_SCHEMA
    from statlake.plans.service import StoreService
    store = FactStore(spark, str(tmp_path / "store"))
    run = RunContext("stats", "v")
    store.commit(stats(spark, SMOKE_DIR), run)
    requests = spark.createDataFrame(
        [(k, k, "timeseries", "order_count", "customer", None, ["total"], 1997, 1998 + k, None, 10, k, None) for k in range(2)],
        REQUEST_SCHEMA)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")   # filters in full
    plan = plan_of(StoreService(store).execute_bulk(requests)["timeseries"])
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [x for x in plan.split("FileScan parquet")[1:] if "value:double" in x.split("ReadSchema")[1].split("\n")[0]]
    assert "WindowGroupLimit" in plan and len(scans) == 1
    filters, pushed = scans[0].split("PartitionFilters: [")[1].split("PushedFilters", 1)
    assert "category" in filters and "indicator" in filters and "import_run_id" in filters
    assert "GreaterThanOrEqual(year,1997)" in pushed and "LessThanOrEqual(year,1999)" in pushed


def test_no_broadcast_is_forced(spark):
    """Sides are broadcast by their measured size only."""
    import pathlib
    for p in pathlib.Path("statlake").resolve().rglob("*.py"):
        assert "F.broadcast(" not in p.read_text(), p


def test_snapshot_of_two_thousand_scopes_prunes(spark, tmp_path):
    """One plan for any number of scopes; superseded runs and other scopes are pruned."""
    store = FactStore(spark, str(tmp_path / "store"))
    rows = spark.range(2000).select(
        F.concat(F.lit("ind"), F.col("id")).alias("indicator"), F.lit("district").alias("area_type"),
        F.lit("a").alias("area_name"), F.lit(2000).alias("year"), F.col("id").cast("double").alias("value"),
        F.lit("u").alias("unit"), F.lit("total").alias("category"), F.lit("s").alias("source_dataset"),
        F.lit(None).cast("timestamp").alias("loaded_at"), F.lit("v").alias("data_version"))
    for _ in range(2):
        run = RunContext("many", "v")
        store.begin(run)
        store.commit(rows, run)
    snapshot = store.snapshot()
    assert snapshot.count() == 2000
    one = snapshot.where("indicator = 'ind7'")
    text = one._jdf.queryExecution().executedPlan().toString()
    filters = text.split("PartitionFilters: [")[1]
    assert "isnotnull(indicator" in filters and "import_run_id" in filters and "Join" not in text
    assert [r.value for r in one.collect()] == [7.0]


def test_named_dimensions_leave_one_branch_of_the_derived_table(spark):
    s = stats(spark, SMOKE_DIR)
    assert "Union" in s._jdf.queryExecution().optimizedPlan().toString()
    one = s.where("indicator = 'order_value' AND area_type = 'customer'")
    text = one._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in text and "o_orderpriority" in text
