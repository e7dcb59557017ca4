"""Query keys for the read operators (timeseries, ranking, lists, metadata,
capabilities, freshness), each with its DuckDB oracle.

Arrays are reported as comma-joined strings so that both engines hash the
same scalar value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators import query as q
from statlake.plans.derived import stats
from statlake.plans.oracle import with_stats
from statlake.plans.registry import register


def _joined(df, *cols):
    return df.select(*[F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
                       if c in cols else F.col(c) for c in df.columns])


@register("ranking_desc", with_stats("""
SELECT area_name AS area, value, unit, category FROM stats
WHERE indicator = 'order_count' AND area_type = 'nation' AND year = 1998 AND category IN ('total')
ORDER BY value DESC, area ASC, category ASC LIMIT 10"""))
def ranking_desc(spark, sf_dir):
    return q.ranking(stats(spark, sf_dir), "order_count", "nation", 1998,
                     categories=["total"], limit=10, order="desc")


@register("ranking_asc", with_stats("""
SELECT area_name AS area, value, unit, category FROM stats
WHERE indicator = 'order_value' AND area_type = 'nation' AND year = 1997
ORDER BY value ASC, area ASC, category ASC LIMIT 10"""))
def ranking_asc(spark, sf_dir):
    return q.ranking(stats(spark, sf_dir), "order_value", "nation", 1997, limit=10, order="asc")


@register("ranking_no_category", with_stats("""
SELECT area_name AS area, value, unit, category FROM stats
WHERE indicator = 'order_count' AND area_type = 'region' AND year = 1999
ORDER BY value DESC, area ASC, category ASC LIMIT 10"""))
def ranking_no_category(spark, sf_dir):
    return q.ranking(stats(spark, sf_dir), "order_count", "region", 1999, limit=10)


@register("timeseries_page", with_stats("""
SELECT area_name AS area, year, value, unit, category FROM stats
WHERE indicator = 'order_count' AND area_type = 'nation' AND category IN ('total')
ORDER BY area ASC, year ASC, category ASC LIMIT 50 OFFSET 20"""))
def timeseries_page(spark, sf_dir):
    return q.timeseries(stats(spark, sf_dir), "order_count", "nation", areas=[],
                        categories=["total"], limit=50, offset=20)


@register("timeseries_range", with_stats("""
SELECT area_name AS area, year, value, unit, category FROM stats
WHERE indicator = 'order_count' AND area_type = 'region' AND area_name IN ('ASIA', 'EUROPE')
  AND year >= 1996 AND year <= 1999
ORDER BY area ASC, year ASC, category ASC LIMIT 500 OFFSET 0"""))
def timeseries_range(spark, sf_dir):
    return q.timeseries(stats(spark, sf_dir), "order_count", "region", areas=["ASIA", "EUROPE"],
                        year_from=1996, year_to=1999, limit=500, offset=0)


@register("timeseries_multi", with_stats("""
SELECT area_name AS area, year, value, unit, category FROM stats
WHERE indicator = 'order_count' AND area_type = 'nation'
  AND area_name IN ('NATION_1', 'NATION_3', 'NATION_7') AND category IN ('1-URGENT', '5-LOW')
ORDER BY area ASC, year ASC, category ASC LIMIT 500"""))
def timeseries_multi(spark, sf_dir):
    return q.timeseries(stats(spark, sf_dir), "order_count", "nation",
                        areas=["NATION_1", "NATION_3", "NATION_7"],
                        categories=["1-URGENT", "5-LOW"], limit=500)


@register("timeseries_page_meta", with_stats("""
SELECT count(*) AS total, 50 AS "limit", 20 AS "offset",
       (20 + least(50, greatest(count(*) - 20, 0))) < count(*) AS has_more
FROM stats WHERE indicator = 'order_count' AND area_type = 'nation' AND category IN ('total')"""))
def timeseries_page_meta(spark, sf_dir):
    return q.timeseries_meta(stats(spark, sf_dir), "order_count", "nation", areas=[],
                             categories=["total"], limit=50, offset=20)


@register("years_page_meta", with_stats("""
SELECT count(DISTINCT year) AS total, 3 AS "limit", 2 AS "offset",
       (2 + least(3, greatest(count(DISTINCT year) - 2, 0))) < count(DISTINCT year) AS has_more
FROM stats WHERE indicator = 'order_count' AND area_type = 'nation'"""))
def years_page_meta(spark, sf_dir):
    return q.years_meta(stats(spark, sf_dir), indicator="order_count", area_type="nation",
                        limit=3, offset=2)


@register("indicators_page_meta", with_stats("""
SELECT count(DISTINCT indicator) AS total, CAST(count(DISTINCT indicator) AS INTEGER) AS "limit",
       0 AS "offset", false AS has_more
FROM stats WHERE area_type = 'nation'"""))
def indicators_page_meta(spark, sf_dir):
    return q.indicators_meta(stats(spark, sf_dir), area_type="nation")


@register("list_areas", with_stats("""
SELECT DISTINCT area_name AS area FROM stats
WHERE indicator = 'order_count' AND area_type = 'region' ORDER BY area"""))
def list_areas(spark, sf_dir):
    return q.list_areas(stats(spark, sf_dir), "order_count", "region")


@register("areas_like", with_stats("""
SELECT DISTINCT area_name AS area FROM stats
WHERE indicator = 'order_count' AND area_type = 'nation' AND category = 'total'
  AND lower(area_name) LIKE '%ion\\_1%' ESCAPE '\\' ORDER BY area"""))
def areas_like(spark, sf_dir):
    return q.list_areas(stats(spark, sf_dir), "order_count", "nation", category="total",
                        like="ION_1")


@register("list_categories", with_stats("""
SELECT DISTINCT category FROM stats
WHERE indicator = 'order_count' AND area_type = 'nation' ORDER BY category"""))
def list_categories(spark, sf_dir):
    return q.list_categories(stats(spark, sf_dir), "order_count", "nation")


@register("list_years", with_stats("SELECT DISTINCT year FROM stats ORDER BY year"))
def list_years(spark, sf_dir):
    return q.list_years(stats(spark, sf_dir))


@register("years_filtered", with_stats("""
SELECT DISTINCT year FROM stats
WHERE indicator = 'order_value' AND area_type = 'nation' AND area_name = 'NATION_5'
ORDER BY year LIMIT 3 OFFSET 1"""))
def years_filtered(spark, sf_dir):
    return q.list_years(stats(spark, sf_dir), indicator="order_value", area_type="nation",
                        area="NATION_5", limit=3, offset=1)


@register("list_indicators", with_stats("SELECT DISTINCT indicator FROM stats ORDER BY indicator"))
def list_indicators(spark, sf_dir):
    return q.list_indicators(stats(spark, sf_dir))


@register("indicators_filtered", with_stats("""
SELECT DISTINCT indicator FROM stats WHERE area_type = 'nation' AND year = 1999
ORDER BY indicator LIMIT 1 OFFSET 1"""))
def indicators_filtered(spark, sf_dir):
    return q.list_indicators(stats(spark, sf_dir), area_type="nation", year=1999, limit=1,
                             offset=1)


@register("list_area_types", with_stats("SELECT DISTINCT area_type FROM stats ORDER BY area_type"))
def list_area_types(spark, sf_dir):
    return q.list_area_types(stats(spark, sf_dir))


@register("year_meta", with_stats("""
SELECT area_type,
       array_to_string(list_sort(list(DISTINCT indicator)), ',') AS indicators,
       array_to_string(list_sort(list(DISTINCT category)), ',') AS categories,
       array_to_string(list_sort(list(DISTINCT area_name)), ',') AS areas
FROM stats WHERE year = 1998 GROUP BY area_type"""))
def year_meta(spark, sf_dir):
    return _joined(q.year_meta(stats(spark, sf_dir), 1998), "indicators", "categories", "areas")


@register("indicator_meta", with_stats("""
SELECT area_type,
       array_to_string(list_sort(list(DISTINCT year)), ',') AS years,
       array_to_string(list_sort(list(DISTINCT category)), ',') AS categories,
       array_to_string(list_sort(list(DISTINCT area_name)), ',') AS areas
FROM stats WHERE indicator = 'order_count' GROUP BY area_type"""))
def indicator_meta(spark, sf_dir):
    return _joined(q.indicator_meta(stats(spark, sf_dir), "order_count"),
                   "years", "categories", "areas")


@register("capabilities", with_stats("""
SELECT array_to_string(list_sort(list(DISTINCT area_type)), ',') AS area_types,
       array_to_string(list_sort(list(DISTINCT indicator)), ',') AS indicators,
       array_to_string(list_sort(list(DISTINCT year)), ',') AS years,
       25 AS bulk_max_items, 1 AS page_min, 500 AS page_max, 50 AS page_default,
       1 AS ranking_min, 100 AS ranking_max, 50 AS ranking_default
FROM stats"""))
def capabilities(spark, sf_dir):
    return _joined(q.capabilities(stats(spark, sf_dir)), "area_types", "indicators", "years")


@register("freshness", with_stats("""
SELECT row_count, last_updated_at, versions, fingerprint, sha256(fingerprint) AS data_version
FROM (
  SELECT c.row_count, c.last_updated_at, v.versions,
         '{"rowCount":' || c.row_count || ',"lastUpdatedAt":"' || c.last_updated_at
         || '","versions":[' || v.quoted || ']}' AS fingerprint
  FROM (SELECT count(*) AS row_count,
               strftime(max(loaded_at), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS last_updated_at
        FROM stats) c,
       (SELECT string_agg(dv, ',' ORDER BY dv) AS versions,
               string_agg('"' || dv || '"', ',' ORDER BY dv) AS quoted
        FROM (SELECT DISTINCT data_version AS dv FROM stats)) v)"""))
def freshness(spark, sf_dir):
    return _joined(q.freshness(stats(spark, sf_dir)), "versions")


@register("ranking_customers", with_stats("""
SELECT area_name AS area, value, unit, category FROM stats
WHERE indicator = 'order_value' AND area_type = 'customer' AND year = 1998
ORDER BY value DESC, area ASC, category ASC LIMIT 100"""))
def ranking_customers(spark, sf_dir):
    """Top-k over an area type whose size grows with the data."""
    return q.ranking(stats(spark, sf_dir), "order_value", "customer", 1998, limit=100)


@register("timeseries_customer_page", with_stats("""
SELECT area_name AS area, year, value, unit, category FROM stats
WHERE indicator = 'order_count' AND area_type = 'customer' AND year >= 1997
ORDER BY area ASC, year ASC, category ASC LIMIT 500 OFFSET 1000"""))
def timeseries_customer_page(spark, sf_dir):
    return q.timeseries(stats(spark, sf_dir), "order_count", "customer", year_from=1997,
                        limit=500, offset=1000)


@register("customer_page_meta", with_stats("""
SELECT count(*) AS total, 500 AS "limit", 1000 AS "offset",
       (1000 + least(500, greatest(count(*) - 1000, 0))) < count(*) AS has_more
FROM stats WHERE indicator = 'order_count' AND area_type = 'customer' AND year >= 1997"""))
def customer_page_meta(spark, sf_dir):
    return q.timeseries_meta(stats(spark, sf_dir), "order_count", "customer", year_from=1997,
                             limit=500, offset=1000)


@register("year_meta_long", with_stats("""
SELECT DISTINCT area_type, 'indicator' AS field, indicator AS value FROM stats WHERE year = 1998
UNION
SELECT DISTINCT area_type, 'category', category FROM stats WHERE year = 1998
UNION
SELECT DISTINCT area_type, 'area', area_name FROM stats WHERE year = 1998"""))
def year_meta_long(spark, sf_dir):
    return q.year_meta_long(stats(spark, sf_dir), 1998)


@register("indicator_meta_long", with_stats("""
SELECT DISTINCT area_type, 'year' AS field, CAST(year AS VARCHAR) AS value FROM stats
WHERE indicator = 'order_value'
UNION
SELECT DISTINCT area_type, 'category', category FROM stats WHERE indicator = 'order_value'
UNION
SELECT DISTINCT area_type, 'area', area_name FROM stats WHERE indicator = 'order_value'"""))
def indicator_meta_long(spark, sf_dir):
    return q.indicator_meta_long(stats(spark, sf_dir), "order_value")


@register("timeseries_deep_page", with_stats("""
SELECT area_name AS area, year, value, unit, category FROM stats
WHERE indicator = 'order_count' AND area_type = 'customer'
ORDER BY area ASC, year ASC, category ASC LIMIT 500 OFFSET 12000"""))
def timeseries_deep_page(spark, sf_dir):
    """A page far behind the start, by the same plan as the first one."""
    return q.timeseries(stats(spark, sf_dir), "order_count", "customer", limit=500,
                        offset=12000)
