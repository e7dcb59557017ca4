"""DuckDB SQL that recomputes the derived tables from the driver tables.

Used only as the independent oracle for the correctness check: every query
key in the registry pairs a Spark callable with one of these statements.
"""

from __future__ import annotations

from statlake.plans.derived import STATS_LOADED_AT_SQL, STATS_RUN_ID

STATS_CTE = f"""
WITH base AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, o.o_orderpriority AS priority,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount, n.n_name, r.r_name, c.c_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
), agg AS (
  SELECT 'order_count' AS indicator, 'nation' AS area_type, n_name AS area_name, year,
         priority AS category, CAST(count(*) AS DOUBLE) AS value
  FROM base GROUP BY n_name, year, priority
  UNION ALL
  SELECT 'order_count', 'nation', n_name, year, 'total', CAST(count(*) AS DOUBLE)
  FROM base GROUP BY n_name, year
  UNION ALL
  SELECT 'order_count', 'region', r_name, year, priority, CAST(count(*) AS DOUBLE)
  FROM base GROUP BY r_name, year, priority
  UNION ALL
  SELECT 'order_count', 'region', r_name, year, 'total', CAST(count(*) AS DOUBLE)
  FROM base GROUP BY r_name, year
  UNION ALL
  SELECT 'order_value', 'nation', n_name, year, 'total', CAST(sum(amount) AS DOUBLE)
  FROM base GROUP BY n_name, year
  UNION ALL
  SELECT 'order_count', 'customer', c_name, year, priority, CAST(count(*) AS DOUBLE)
  FROM base GROUP BY c_name, year, priority
  UNION ALL
  SELECT 'order_count', 'customer', c_name, year, 'total', CAST(count(*) AS DOUBLE)
  FROM base GROUP BY c_name, year
  UNION ALL
  SELECT 'order_value', 'customer', c_name, year, 'total', CAST(sum(amount) AS DOUBLE)
  FROM base GROUP BY c_name, year
), stats AS (
  SELECT indicator, area_type, area_name, year, value,
         CASE WHEN indicator = 'order_value' THEN 'currency' ELSE 'orders' END AS unit,
         category, 'orders' AS source_dataset, '{STATS_RUN_ID}' AS import_run_id,
         TIMESTAMP '{STATS_LOADED_AT_SQL}' AS loaded_at, 'orders:' || indicator AS data_version
  FROM agg
)
"""


def with_stats(sql: str, *extra_ctes: str) -> str:
    """Prefix a statement with the ``stats`` CTE (and further CTEs)."""
    extra = "".join(f",\n{c}" for c in extra_ctes)
    return STATS_CTE + extra + "\n" + sql
