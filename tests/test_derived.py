"""The derived facts: what one task groups does not grow with the tables."""

import datetime as dt

from pyspark.sql import functions as F

from statlake.plans import derived


def _tables(spark, path, orders=240, customers=40):
    """Customers with names that come twice, one of them with a third of all orders."""
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")

    write("region", [(0, "AFRICA"), (1, "ASIA")], "r_regionkey int, r_name string")
    write("nation", [(i, f"NATION_{i}", i % 2) for i in range(4)], "n_nationkey int, n_name string, n_regionkey int")
    write("customer", [(i, None if i == 5 else f"Customer {i % 30}", i % 4) for i in range(customers)],
          "c_custkey long, c_name string, c_nationkey int")
    write("orders", [(i, 7 if i % 3 == 0 else i % 45, dt.datetime(1995 + i % 3, 1, 1), float(i), derived.PRIORITIES[i % 5] if i % 11 else None)
                     for i in range(orders)], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double, o_orderpriority string")
    return str(path)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_tasks_by_customer_follow_the_orders(spark, tmp_path, monkeypatch):
    path = _tables(spark, tmp_path)
    whole = _rows(derived.stats(spark, path))
    monkeypatch.setattr(derived, "ORDERS_PER_TASK", 4)
    monkeypatch.setattr(derived, "BROADCAST_CUSTOMERS", 10)
    dealt = derived.stats(spark, path)
    assert _rows(dealt) == whole
    for indicator in ("order_count", "order_value"):   # one task for every four orders, no more shuffles behind
        one = dealt.where((F.col("indicator") == indicator) & (F.col("area_type") == "customer"))
        assert one.rdd.getNumPartitions() == 60


def test_kept_orders_are_read_once(spark, tmp_path, monkeypatch):
    """Callers that publish the facts several times read what is written, not the orders again."""
    path = _tables(spark, tmp_path / "in")
    monkeypatch.setattr(derived, "scratch_path", lambda _, label: str(tmp_path / label))
    kept = derived.stats(spark, path, kept=True)
    assert kept.schema == derived.stats(spark, path).schema
    assert {f.rpartition("/")[0].rpartition("/")[2] for f in kept.inputFiles()} == {"located-orders"}
    assert _rows(kept) == _rows(derived.stats(spark, path))


def test_wide_tables_group_numbers(spark, tmp_path):
    """Cells are numbers until they are grouped: texts are grouped by sorting every row."""
    path = _tables(spark, tmp_path)
    for wide in (derived.wide_years(spark, path), derived.wide_categories(spark, path)):
        assert "SortAggregate" not in wide._jdf.queryExecution().executedPlan().toString()
    cells = derived.wide_years(spark, path).where("Merkmal = 'total' AND Stadtteil = 'Customer 7'").first()
    facts = {r.year: r.value for r in derived.stats(spark, path).where(
        "indicator = 'order_count' AND area_type = 'customer' AND category = 'total' AND area_name = 'Customer 7'").collect()}
    assert {int(y): float(cells[y]) for y in cells.asDict() if y.isdigit() and cells[y] is not None} == facts
