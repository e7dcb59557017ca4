"""Query keys for imports, publish, data quality, ledger, bulk requests,
catalogue and file listings, each re-aimed at the driver tables and paired
with a DuckDB oracle where SQL can express it.

Inputs that are files in the reference (wide CSVs, catalogues) are written
by Spark from the driver tables to a fresh folder below the session's
checkpoint folder and imported back, so the whole path runs on Spark and
its work grows with the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from statlake.functions.columns import (
    computed_total,
    decimal_comma,
    iso_utc,
    parse_number,
    parse_year,
)
from statlake.operators import bulk as B
from statlake.operators import publish as P
from statlake.operators import quality as Q
from statlake.operators.dedupe import keep_last
from statlake.operators import query as q
from statlake.operators.reshape import RunContext, import_counts, to_tidy, with_row_order
from statlake.plans import service
from statlake.plans.derived import PRIORITIES, stats, table, wide_categories, wide_years, year_range
from statlake.plans.importer import stage, stage_many
from statlake.plans.oracle import with_stats
from statlake.plans.registry import register
from statlake.plans.spec import (
    Category,
    CategoryColumn,
    CsvOptions,
    DatasetSpec,
    UnpivotCategories,
    UnpivotYears,
    YearRow,
)
from statlake.schema import KEY, QUERY_AREA_MAX, REQUIRED
from statlake.session import scratch_path
from statlake.sources.catalog import match_catalog, resource_urls
from statlake.sources.csv import write_delimited, write_text_table
from statlake.sources.files import changed_sources, file_versions, version_text

CORE = REQUIRED  # indicator, area_type, area_name, year, value, unit, category
CORE_SQL = "indicator, area_type, area_name, year, value, unit, category"

# A fixed run so that lineage columns are literals on both sides.
FIXED_RUN_AT = dt.datetime(2024, 6, 1, 12, 0, 0)


def fixed_run(dataset_id: str, version: str = "fixed-version") -> RunContext:
    return RunContext(dataset_id=dataset_id, data_version=version,
                      run_id=f"run-{dataset_id}", loaded_at=FIXED_RUN_AT)


def core(df):
    return df.select(*CORE)


# ------------------------------------------------------------ import specs

def _year_rows():
    return (YearRow("total", "order_count", "orders", Category("total")),
            YearRow("1-URGENT", "urgent_orders", "orders", Category("urgent")),
            YearRow("5-LOW", "order_count", "orders", Category("low")))


YEARS_SPEC = DatasetSpec(
    id="customer_orders_by_year", url="file:///wide_years.csv", csv_filename="wide_years.csv",
    area_type="customer", area_column="Stadtteil",
    format=UnpivotYears(indicator_column="Merkmal", rows=_year_rows()))

YEARS_SQL = """
SELECT CASE category WHEN '1-URGENT' THEN 'urgent_orders' ELSE 'order_count' END AS indicator,
       'customer' AS area_type, area_name, year, value, 'orders' AS unit,
       CASE category WHEN 'total' THEN 'total' WHEN '1-URGENT' THEN 'urgent' ELSE 'low' END
         AS category
FROM stats
WHERE indicator = 'order_count' AND area_type = 'customer' AND category IN ('total', '1-URGENT', '5-LOW')
"""

CATEGORIES_SPEC = DatasetSpec(
    id="customer_orders_by_priority", url="file:///wide_categories.csv",
    csv_filename="wide_categories.csv", area_type="customer", area_column="Stadtteil",
    format=UnpivotCategories(
        year_column="Jahr", year_parser="first", keep_last=True,
        filter_column="Merkmal", filter_value="Auftraege",
        indicator="order_count", unit="orders",
        columns=tuple(CategoryColumn(Category(p), value_column=p) for p in PRIORITIES)))

CATEGORIES_SQL = f"""
SELECT {CORE_SQL} FROM stats
WHERE indicator = 'order_count' AND area_type = 'customer' AND category <> 'total'
"""


def _wide_years(spark, sf_dir):
    s = stats(spark, sf_dir)
    return wide_years(spark, sf_dir, stats_df=s)


def _ordered_years(spark, sf_dir):
    return with_row_order(_wide_years(spark, sf_dir), "Merkmal", "Stadtteil")


def _ordered_categories(spark, sf_dir):
    return with_row_order(wide_categories(spark, sf_dir), "Stadtteil", "Jahr")


@register("unpivot_years", with_stats(YEARS_SQL))
def unpivot_years_check(spark, sf_dir):
    wide = _ordered_years(spark, sf_dir)
    return core(to_tidy(wide, YEARS_SPEC, fixed_run(YEARS_SPEC.id)))


@register("unpivot_default_area", """
SELECT 'order_count' AS indicator, 'world' AS area_type, 'WORLD' AS area_name,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS DOUBLE) AS value,
       'orders' AS unit, o_orderpriority AS category
FROM orders GROUP BY year(o_orderdate), o_orderpriority
""")
def unpivot_default_area(spark, sf_dir):
    years = year_range(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    wide = orders.groupBy(F.col("o_orderpriority").alias("Merkmal")).agg(
        *[F.sum(F.when(F.year("o_orderdate") == y, F.lit(1))).cast("string").alias(str(y))
          for y in years])
    spec = DatasetSpec(
        id="world_orders", url="file:///world.csv", csv_filename="world.csv",
        area_type="world", default_area_name="WORLD",
        format=UnpivotYears(indicator_column="Merkmal", rows=tuple(
            YearRow(p, "order_count", "orders", Category(p)) for p in PRIORITIES)))
    return core(to_tidy(with_row_order(wide, "Merkmal"), spec, fixed_run(spec.id)))


@register("unpivot_categories", with_stats(CATEGORIES_SQL))
def unpivot_categories_check(spark, sf_dir):
    wide = _ordered_categories(spark, sf_dir)
    return core(to_tidy(wide, CATEGORIES_SPEC, fixed_run(CATEGORIES_SPEC.id)))


@register("computed_total", with_stats(f"""
SELECT {CORE_SQL} FROM stats
WHERE indicator = 'order_count' AND area_type = 'customer' AND category = 'total'
UNION ALL
SELECT 'order_count_lenient', area_type, area_name, year, value, unit, 'total' FROM stats
WHERE indicator = 'order_count' AND area_type = 'customer' AND category = 'total'
"""))
def computed_total_check(spark, sf_dir):
    spec = DatasetSpec(
        id="customer_orders_total", url="file:///wide_categories.csv",
        csv_filename="wide_categories.csv", area_type="customer", area_column="Stadtteil",
        format=UnpivotCategories(
            year_column="Jahr", year_parser="first", filter_column="Merkmal",
            filter_value="Auftraege", indicator="order_count", unit="orders",
            columns=(CategoryColumn(Category("total"), value=lambda: computed_total(PRIORITIES)),
                     CategoryColumn(Category("total"), indicator="order_count_lenient",
                                    value=lambda: computed_total(PRIORITIES, lenient=True)))))
    return core(to_tidy(_ordered_categories(spark, sf_dir), spec, fixed_run(spec.id)))


@register("trim_area", with_stats(YEARS_SQL))
def trim_area(spark, sf_dir):
    wide = _ordered_years(spark, sf_dir)
    padded = wide.withColumn("Stadtteil", F.concat(F.lit("  "), "Stadtteil", F.lit(" ")))
    spec = DatasetSpec(id=YEARS_SPEC.id, url=YEARS_SPEC.url, csv_filename=YEARS_SPEC.csv_filename,
                       area_type="customer", area_column="Stadtteil", area_expression=F.trim,
                       format=YEARS_SPEC.format)
    return core(to_tidy(padded, spec, fixed_run(spec.id)))


# --------------------------------------------------------- CSV round trips

@register("csv_round_trip", with_stats(YEARS_SQL))
def csv_round_trip(spark, sf_dir):
    path = write_delimited(_wide_years(spark, sf_dir), scratch_path(spark, "wide-years"))
    staged, _ = stage(spark, YEARS_SPEC, path, fixed_run(YEARS_SPEC.id))
    return core(staged)


@register("header_normalize", with_stats(YEARS_SQL))
def header_normalize(spark, sf_dir):
    wide = _wide_years(spark, sf_dir)
    header = [" Merkmal ", "Nation Name"] + [f"{c} " for c in wide.columns[2:]]
    path = write_text_table(wide, scratch_path(spark, "wide-years-headers"), header)
    spec = DatasetSpec(id=YEARS_SPEC.id, url=YEARS_SPEC.url, csv_filename=YEARS_SPEC.csv_filename,
                       area_type="customer", area_column="Stadtteil",
                       column_aliases={"Stadtteil": ("Nation-Name", "Nation Name")},
                       format=YEARS_SPEC.format)
    staged, _ = stage(spark, spec, path, fixed_run(spec.id))
    return core(staged)


@register("duplicate_year_columns", with_stats("""
SELECT 'order_count' AS indicator, 'customer' AS area_type, area_name, year,
       CASE WHEN CAST(value AS BIGINT) % 2 = 0 THEN value ELSE value + 1 END AS value,
       'orders' AS unit, 'total' AS category
FROM stats WHERE indicator = 'order_count' AND area_type = 'customer' AND category = 'total'
"""))
def duplicate_year_columns(spark, sf_dir):
    """Every year column appears twice; the later copy wins unless empty."""
    wide = _wide_years(spark, sf_dir)
    years = wide.columns[2:]
    cols = [F.col("Merkmal"), F.col("Stadtteil")]
    header = ["Merkmal", "Stadtteil"]
    for y in years:
        v = F.col(y).cast("long")
        later = F.when(v % 2 == 0, F.lit(None)).otherwise(v + 1).cast("string")
        cols += [F.col(y).alias(f"a{y}"), later.alias(f"b{y}")]
        header += [y, y]
    path = write_text_table(wide.select(*cols), scratch_path(spark, "wide-years-dup"), header)
    spec = DatasetSpec(
        id="customer_orders_dup", url="file:///dup.csv", csv_filename="dup.csv",
        area_type="customer", area_column="Stadtteil",
        format=UnpivotYears(indicator_column="Merkmal", year_pattern=r"^\d{4}(?:_\d+)?$",
                            year_parser="leading",
                            rows=(YearRow("total", "order_count", "orders", Category("total")),)))
    staged, _ = stage(spark, spec, path, fixed_run(spec.id))
    return core(staged)


@register("encoding_fallback", with_stats("""
SELECT indicator, area_type, area_name, year, value, unit,
       CASE category WHEN '1-URGENT' THEN 'urgent' ELSE 'low' END AS category
FROM stats
WHERE indicator = 'order_count' AND area_type = 'customer' AND category IN ('1-URGENT', '5-LOW')
"""))
def encoding_fallback(spark, sf_dir):
    """A latin-1 text whose header has an umlaut: the UTF-8 read shows U+FFFD,
    so the import falls back to latin-1 and finds the first alternative."""
    wide = wide_categories(spark, sf_dir).withColumnRenamed("1-URGENT", "dringlich-ä")
    path = write_delimited(wide, scratch_path(spark, "latin1"), encoding="latin-1")
    spec = DatasetSpec(
        id="customer_orders_latin1", url="file:///latin1.csv", csv_filename="latin1.csv",
        area_type="customer", area_column="Stadtteil",
        csv=CsvOptions(fallback_encodings=("latin-1",)),
        format=UnpivotCategories(
            year_column="Jahr", year_parser="first", keep_last=True,
            filter_column="Merkmal", filter_value="Auftraege", indicator="order_count",
            unit="orders",
            columns=(CategoryColumn(Category("urgent"), value_columns=(
                "dringlich-ä", "dringlich-Ã¤", "dringlich-�", "dringlich-ae")),
                CategoryColumn(Category("low"), value_column="5-LOW"))))
    staged, _ = stage(spark, spec, path, fixed_run(spec.id))
    return core(staged)


@register("import_many", with_stats(f"""
SELECT * FROM ({YEARS_SQL})
UNION ALL
SELECT * FROM ({CATEGORIES_SQL})
"""))
def import_many(spark, sf_dir):
    s = stats(spark, sf_dir)
    p1 = write_delimited(wide_years(spark, sf_dir, stats_df=s), scratch_path(spark, "many-a"))
    p2 = write_delimited(wide_categories(spark, sf_dir, stats_df=s), scratch_path(spark, "many-b"))
    missing = DatasetSpec(id="not_landed", url="file:///missing.csv", csv_filename="missing.csv",
                          area_type="customer", area_column="Stadtteil", format=YEARS_SPEC.format)
    paths = {YEARS_SPEC.id: p1, CATEGORIES_SPEC.id: p2,
             missing.id: scratch_path(spark, "never-written")}
    runs = {sp.id: fixed_run(sp.id) for sp in (YEARS_SPEC, CATEGORIES_SPEC, missing)}
    return core(stage_many(spark, [YEARS_SPEC, CATEGORIES_SPEC, missing], paths, runs))


@register("lineage", with_stats(f"""
SELECT {CORE_SQL}, 'customer_orders_by_year' AS source_dataset,
       'run-customer_orders_by_year' AS import_run_id,
       '2024-06-01T12:00:00.000Z' AS loaded_at, 'fixed-version' AS data_version
FROM ({YEARS_SQL})
"""))
def lineage(spark, sf_dir):
    out = to_tidy(_ordered_years(spark, sf_dir), YEARS_SPEC, fixed_run(YEARS_SPEC.id))
    return out.select(*CORE, "source_dataset", "import_run_id",
                      iso_utc("loaded_at").alias("loaded_at"), "data_version")


@register("file_versions", """
SELECT page_id, 'size:' || CAST(strlen(html) AS VARCHAR) || ';mtimeMs:' || CAST(page_id * 1000 AS VARCHAR)
         AS data_version, 0 AS listed_wrong
FROM pages""")
def file_versions_check(spark, sf_dir):
    """Version texts of pages as if each were a file, next to the number of really
    written part files whose version is not their own size and time."""
    path = write_delimited(_wide_years(spark, sf_dir), scratch_path(spark, "versions"))
    listed = file_versions(spark, path, "*.csv")
    parts = F.regexp_extract_all("data_version", F.lit(r"(\d+)"), F.lit(1))
    wrong = listed.agg(F.count_if(
        ~F.col("data_version").rlike(r"^size:\d+;mtimeMs:\d+$") | (parts[0].cast("long") != F.col("size"))
        | (parts[1].cast("long") != F.col("mtime_ms")) | (F.col("size") <= 0)).cast("int").alias("n"))
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.octet_length("html").alias("size"), (F.col("page_id") * 1000).alias("mtime_ms"))
    return pages.select("page_id", version_text("size", "mtime_ms").alias("data_version"),
                        wrong.scalar().alias("listed_wrong"))


def _numbered(areas, order):
    return areas.select("area", F.row_number().over(Window.orderBy(order)).alias("position"))


@register("areas_unicode_order", with_stats("""
SELECT area, CAST(row_number() OVER (ORDER BY lower(area), area) AS INTEGER) AS position
FROM (SELECT DISTINCT area FROM (
  SELECT area_name AS area FROM stats WHERE indicator = 'order_count' AND area_type = 'customer'
  ORDER BY area_name, year, category LIMIT 500 OFFSET 50))"""))
def areas_unicode_order(spark, sf_dir):
    """The areas of one page in locale order, with their positions (a page has at most 500 rows)."""
    page = q.timeseries(stats(spark, sf_dir), "order_count", "customer", limit=500, offset=50)
    return _numbered(q.page_areas(page, "UNICODE"), F.collate(F.col("area"), "UNICODE"))


@register("timeseries_page_areas", with_stats("""
SELECT DISTINCT area FROM (
  SELECT area_name AS area FROM stats WHERE indicator = 'order_count' AND area_type = 'customer' AND year >= 1997
  ORDER BY area_name, year, category LIMIT 500 OFFSET 1000)"""))
def timeseries_page_areas(spark, sf_dir):
    return q.page_areas(q.timeseries(stats(spark, sf_dir), "order_count", "customer", year_from=1997,
                                     limit=500, offset=1000))


@register("import_duplicate_rows", with_stats("""
SELECT 'order_count' AS indicator, 'customer' AS area_type, area_name, year, value + 1 AS value,
       'orders' AS unit, 'total' AS category
FROM stats WHERE indicator = 'order_count' AND area_type = 'customer' AND category = 'total'
"""))
def import_duplicate_rows(spark, sf_dir):
    """A file that repeats every (area, year) three times; its last row decides."""
    s = stats(spark, sf_dir).where("indicator = 'order_count' AND area_type = 'customer' AND category = 'total'")
    rows = s.select(F.lit("Auftraege").alias("Merkmal"), F.col("year").cast("string").alias("Jahr"),
                    F.col("area_name").alias("Stadtteil"), F.explode(F.array(F.lit(3), F.lit(7), F.lit(1))).alias("add"),
                    F.col("value").cast("long").alias("v"))
    lines = rows.select("Merkmal", "Jahr", "Stadtteil", (F.col("v") + F.col("add")).cast("string").alias("insgesamt"))
    path = write_text_table(lines, scratch_path(spark, "repeated"), lines.columns)
    spec = DatasetSpec(
        id="customer_orders_repeated", url="file:///r.csv", csv_filename="r.csv", area_type="customer",
        area_column="Stadtteil", format=UnpivotCategories(
            year_column="Jahr", year_parser="first", keep_last=True, filter_column="Merkmal",
            filter_value="Auftraege", indicator="order_count", unit="orders",
            columns=(CategoryColumn(Category("total"), value_column="insgesamt"),)))
    staged, _ = stage(spark, spec, path, fixed_run(spec.id))
    return core(staged)


DIRTY_A_SQL = """CASE l_linenumber % 7 WHEN 0 THEN '12d' WHEN 1 THEN 'nan' WHEN 2 THEN NULL WHEN 3 THEN ' 5 '
  WHEN 4 THEN '1e2' WHEN 5 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END"""


@register("computed_total_dirty", f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN regexp_full_match(a, '[ ]*[-+]?[0-9]+(\\.[0-9]*)?(e[0-9]+)?[ ]*') THEN CAST(trim(a) AS DOUBLE) ELSE 0 END
         + l_linenumber AS total
FROM (SELECT l_orderkey, l_linenumber, {DIRTY_A_SQL} AS a FROM lineitem)
""")
def computed_total_dirty(spark, sf_dir):
    k = F.col("l_linenumber") % 7
    a = (F.when(k == 0, "12d").when(k == 1, "nan").when(k == 3, " 5 ").when(k == 4, "1e2").when(k == 5, "")
         .when(k == 6, F.col("l_linenumber").cast("string")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", a.alias("a"),
                                                   F.col("l_linenumber").cast("string").alias("b"))
    return rows.select("l_orderkey", "l_linenumber", computed_total(["a", "b"], lenient=True).alias("total"))


# ------------------------------------------------------- parsing / numbers

@register("parse_year", r"""
SELECT CAST(regexp_extract(strftime(l_shipdate, '%d.%m.%Y'), '(\d{4})', 1) AS INTEGER) AS year,
       CAST(regexp_extract(strftime(l_shipdate, '%Y_%m_%d'), '^(\d{4})', 1) AS INTEGER)
         AS year_leading,
       count(*) AS n
FROM lineitem GROUP BY 1, 2
""")
def parse_year_check(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    first = parse_year(F.date_format("l_shipdate", "dd.MM.yyyy"), "first")
    leading = parse_year(F.date_format("l_shipdate", "yyyy_MM_dd"), "leading")
    return li.groupBy(first.alias("year"), leading.alias("year_leading")).agg(
        F.count(F.lit(1)).alias("n"))


LENIENT_TEXT_SQL = """
CASE WHEN l_linenumber = 7 THEN 'x'
     WHEN l_linenumber = 6 THEN 'NaN'
     WHEN l_linenumber = 5 THEN ''
     WHEN l_linenumber = 4 THEN ' ' || replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') || ' '
     ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') END
"""


@register("lenient_numeric", f"""
SELECT count(v) AS n_valid, count(*) - count(v) AS n_invalid,
       CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS sum_value
FROM (SELECT CASE WHEN regexp_full_match(replace(t, ',', '.'), '[ ]*[0-9]+([.][0-9]+)?[ ]*')
                  THEN TRY_CAST(replace(t, ',', '.') AS DOUBLE) END AS v
      FROM (SELECT {LENIENT_TEXT_SQL} AS t FROM lineitem))
""")
def lenient_numeric(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    price = F.replace(li.l_extendedprice.cast("decimal(18,2)").cast("string"), F.lit("."),
                      F.lit(","))
    text = (F.when(F.col("l_linenumber") == 7, F.lit("x"))
            .when(F.col("l_linenumber") == 6, F.lit("NaN"))
            .when(F.col("l_linenumber") == 5, F.lit(""))
            .when(F.col("l_linenumber") == 4, F.concat(F.lit(" "), price, F.lit(" ")))
            .otherwise(price))
    v = parse_number(decimal_comma(text))
    return li.select(v.alias("v")).agg(
        F.count("v").alias("n_valid"),
        (F.count(F.lit(1)) - F.count("v")).alias("n_invalid"),
        F.sum(F.col("v").cast("decimal(18,2)")).cast("double").alias("sum_value"))


# ----------------------------------------------------------- dedupe / DQ

@register("dedupe_keep_last", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text, user_id, event_type, value, props
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1
""")
def dedupe_keep_last(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    last = keep_last(ev, ["user_id", "event_type"], "event_id")
    return last.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"),
                       "user_id", "event_type", "value", "props")


def _with_later_copies(s):
    """stats plus a later copy of every 'total' row with value + 1."""
    later = s.where(F.col("category") == "total").withColumn("value", F.col("value") + 1)
    return (s.withColumn("__order", F.lit(0))
            .unionByName(later.withColumn("__order", F.lit(1))))


@register("stage_unique", with_stats("""
SELECT indicator, area_type, area_name, year,
       CASE WHEN category = 'total' THEN value + 1 ELSE value END AS value, unit, category
FROM stats
"""))
def stage_unique(spark, sf_dir):
    both = _with_later_copies(stats(spark, sf_dir))
    return core(keep_last(both, KEY, "__order"))


@register("dq_duplicate_keys", with_stats("""
SELECT indicator, area_type, area_name, year, category, count(*) AS n
FROM (SELECT * FROM stats UNION ALL SELECT * FROM stats WHERE category = 'total')
GROUP BY indicator, area_type, area_name, year, category HAVING count(*) > 1
"""))
def dq_duplicate_keys(spark, sf_dir):
    return Q.duplicate_keys(_with_later_copies(stats(spark, sf_dir)).drop("__order"))


def _with_nulls(s):
    """Inject NULLs by rule: area in 1996, value of 5-LOW in 1999, unit of
    order_value in 2000, category of order_value in 1995."""
    return s.select(
        "indicator", "area_type",
        F.when(F.col("year") == 1996, F.lit(None)).otherwise(F.col("area_name")).alias("area_name"),
        "year",
        F.when((F.col("category") == "5-LOW") & (F.col("year") == 1999), F.lit(None).cast("double"))
        .otherwise(F.col("value")).alias("value"),
        F.when((F.col("indicator") == "order_value") & (F.col("year") == 2000), F.lit(None))
        .otherwise(F.col("unit")).alias("unit"),
        F.when((F.col("indicator") == "order_value") & (F.col("year") == 1995), F.lit(None))
        .otherwise(F.col("category")).alias("category"))


NULLS_SQL = """
nulled AS (
  SELECT indicator, area_type,
         CASE WHEN year = 1996 THEN NULL ELSE area_name END AS area_name, year,
         CASE WHEN category = '5-LOW' AND year = 1999 THEN NULL ELSE value END AS value,
         CASE WHEN indicator = 'order_value' AND year = 2000 THEN NULL ELSE unit END AS unit,
         CASE WHEN indicator = 'order_value' AND year = 1995 THEN NULL ELSE category END AS category
  FROM stats)"""


@register("dq_not_null", with_stats("""
SELECT count(*) FILTER (WHERE indicator IS NULL) AS null_indicator,
       count(*) FILTER (WHERE area_type IS NULL) AS null_area_type,
       count(*) FILTER (WHERE area_name IS NULL) AS null_area_name,
       count(*) FILTER (WHERE year IS NULL) AS null_year,
       count(*) FILTER (WHERE value IS NULL) AS null_value,
       count(*) FILTER (WHERE unit IS NULL) AS null_unit,
       count(*) FILTER (WHERE category IS NULL) AS null_category
FROM nulled""", NULLS_SQL))
def dq_not_null(spark, sf_dir):
    return Q.null_violations(_with_nulls(stats(spark, sf_dir)))


@register("dq_dropna", with_stats(f"""
SELECT {CORE_SQL} FROM nulled
WHERE indicator IS NOT NULL AND area_type IS NOT NULL AND area_name IS NOT NULL
  AND year IS NOT NULL AND value IS NOT NULL AND unit IS NOT NULL AND category IS NOT NULL""",
                                  NULLS_SQL))
def dq_dropna(spark, sf_dir):
    return Q.dropna_required(_with_nulls(stats(spark, sf_dir)))


@register("dq_fill_category", with_stats("""
SELECT indicator, area_type, area_name, year, value, unit, coalesce(category, 'total') AS category
FROM nulled""", NULLS_SQL))
def dq_fill_category(spark, sf_dir):
    return Q.fill_category(_with_nulls(stats(spark, sf_dir)))


@register("dq_staged_checks", with_stats("""
SELECT count(*) AS "rows",
       count(*) FILTER (WHERE indicator IS NULL) AS null_indicator,
       count(*) FILTER (WHERE area_type IS NULL) AS null_area_type,
       count(*) FILTER (WHERE area_name IS NULL) AS null_area_name,
       count(*) FILTER (WHERE year IS NULL) AS null_year,
       count(*) FILTER (WHERE value IS NULL) AS null_value,
       count(*) FILTER (WHERE unit IS NULL) AS null_unit,
       count(*) FILTER (WHERE category IS NULL) AS null_category,
       CAST(0 AS BIGINT) AS non_finite_values,
       CAST(0 AS BIGINT) AS years_out_of_range,
       count(*) - count(DISTINCT (indicator, area_type, area_name, year, category))
         AS duplicate_keys
FROM (SELECT * FROM stats UNION ALL SELECT * FROM stats WHERE category = 'total')"""))
def dq_staged_checks(spark, sf_dir):
    return Q.staged_violations(_with_later_copies(stats(spark, sf_dir)).drop("__order"))


# ------------------------------------------------------------ publish

PUBLISH_SCOPES = [("order_count", "customer", c) for c in PRIORITIES + ["total"]]
SCOPES_SQL = "(indicator = 'order_count' AND area_type = 'customer')"
STAGED_SQL = f"""
staged AS (
  SELECT indicator, area_type, area_name, year, value + 1 AS value, unit, category
  FROM stats WHERE {SCOPES_SQL} AND category <> '5-LOW' AND year <> 2001)"""


def _staged(s):
    """New import of the customer order counts: 2001 and the 5-LOW scope are
    gone (stale), every remaining value changed."""
    return (s.where((F.col("indicator") == "order_count") & (F.col("area_type") == "customer")
                    & (F.col("category") != "5-LOW") & (F.col("year") != 2001))
            .withColumn("value", F.col("value") + 1))


def _publish_inputs(spark, sf_dir):
    s = stats(spark, sf_dir)
    return s, _staged(s), P.scopes_frame(spark, PUBLISH_SCOPES)


@register("stale_rows", with_stats(f"""
SELECT {CORE_SQL} FROM stats t
WHERE {SCOPES_SQL} AND NOT EXISTS (
  SELECT 1 FROM staged s WHERE s.indicator = t.indicator AND s.area_type = t.area_type
    AND s.area_name = t.area_name AND s.year = t.year AND s.category = t.category)""",
                                   STAGED_SQL))
def stale_rows(spark, sf_dir):
    s, staged, scopes = _publish_inputs(spark, sf_dir)
    return core(P.stale_rows(s, staged, scopes))


@register("stale_counts", with_stats(f"""
SELECT indicator, area_type, category, count(*) AS stale FROM stats t
WHERE {SCOPES_SQL} AND NOT EXISTS (
  SELECT 1 FROM staged s WHERE s.indicator = t.indicator AND s.area_type = t.area_type
    AND s.area_name = t.area_name AND s.year = t.year AND s.category = t.category)
GROUP BY indicator, area_type, category""", STAGED_SQL))
def stale_counts(spark, sf_dir):
    s, staged, scopes = _publish_inputs(spark, sf_dir)
    return P.stale_counts(s, staged, scopes)


@register("upsert", with_stats(f"""
SELECT {CORE_SQL} FROM stats t WHERE NOT EXISTS (
  SELECT 1 FROM staged s WHERE s.indicator = t.indicator AND s.area_type = t.area_type
    AND s.area_name = t.area_name AND s.year = t.year AND s.category = t.category)
UNION ALL SELECT {CORE_SQL} FROM staged""", STAGED_SQL))
def upsert(spark, sf_dir):
    s, staged, _ = _publish_inputs(spark, sf_dir)
    return core(P.upsert(s, staged))


PUBLISH_SQL = with_stats(f"""
SELECT {CORE_SQL} FROM stats WHERE NOT {SCOPES_SQL}
UNION ALL SELECT {CORE_SQL} FROM staged""", STAGED_SQL)


@register("publish_snapshot", PUBLISH_SQL)
def publish_snapshot(spark, sf_dir):
    s, staged, scopes = _publish_inputs(spark, sf_dir)
    return core(P.replace_scopes(s, staged, scopes))


# Orders whose facts go to one range of a publish.
ORDERS_PER_RANGE = 250_000


def _ranges(spark, sf_dir):
    """Ranges of a publish of facts: they follow the orders; up to the session's cores, AQE sizes them."""
    orders = table(spark, sf_dir, "orders")
    return next(iter(P.tasks_for(orders, orders.count(), ORDERS_PER_RANGE)), None)


@register("publish_store", PUBLISH_SQL)
def publish_store(spark, sf_dir):
    """The same snapshot through the append-only store: a first run publishes
    all of stats, a second run replaces the six customer order-count scopes."""
    s, staged, _ = _publish_inputs(spark, sf_dir)
    store = P.FactStore(spark, scratch_path(spark, "store"))
    ranges = _ranges(spark, sf_dir)
    first = RunContext(dataset_id="stats_initial", data_version="v1")
    store.begin(first)
    store.commit(s, first, tasks=ranges)  # scopes = those written, observed during the write
    second = RunContext(dataset_id="customer_orders", data_version="v2")
    store.begin(second)
    store.commit(staged, second, PUBLISH_SCOPES, tasks=ranges)
    return core(store.facts())


@register("store_snapshot", PUBLISH_SQL)
def store_snapshot(spark, sf_dir):
    """Two publishes read through a pinned snapshot; a third publish after it is not seen."""
    s, staged, scopes = _publish_inputs(spark, sf_dir)
    store, ranges = P.FactStore(spark, scratch_path(spark, "store")), _ranges(spark, sf_dir)
    for name, rows, owned in (("stats_initial", s, None), ("customer_orders", staged, PUBLISH_SCOPES)):
        run = RunContext(dataset_id=name, data_version="v")
        store.begin(run)
        store.commit(rows, run, owned, tasks=ranges)
    snapshot = store.snapshot()
    later = RunContext(dataset_id="customer_orders", data_version="v3")
    store.begin(later)
    store.commit(P.in_scopes(s, scopes), later, PUBLISH_SCOPES, tasks=ranges)
    return core(snapshot)


ALL_SCOPES = sorted({(i, t, c) for i, t, cs in (
    ("order_count", "nation", [*PRIORITIES, "total"]), ("order_count", "region", [*PRIORITIES, "total"]),
    ("order_count", "customer", [*PRIORITIES, "total"]), ("order_value", "nation", ["total"]),
    ("order_value", "customer", ["total"])) for c in cs})


def _service(spark, sf_dir):
    """The service over a store with one run per derived data version, the customer
    order counts published twice."""
    s = stats(spark, sf_dir, kept=True)   # three publishes
    staged = _staged(s)
    ranges = _ranges(spark, sf_dir)
    store = P.FactStore(spark, scratch_path(spark, "store"))
    for name, rows in (("order_count", s), ("order_value", s), ("customer", staged)):
        owned = PUBLISH_SCOPES if name == "customer" else [x for x in ALL_SCOPES if x[0] == name]
        run = RunContext(dataset_id=name, data_version=f"v-{name}", loaded_at=FIXED_RUN_AT)
        store.begin(run)
        store.commit(rows if name == "customer" else rows.where(F.col("indicator") == name), run, owned, tasks=ranges)
    return service.StoreService(store)


@register("store_domains", with_stats("""
SELECT 'indicator' AS kind, indicator AS name FROM stats
UNION SELECT 'areaType', area_type FROM stats
UNION SELECT 'category', category FROM stats WHERE indicator = 'order_count' AND area_type = 'nation'"""))
def store_domains(spark, sf_dir):
    """Indicators, area types and categories from the ledger; no fact is read."""
    s = _service(spark, sf_dir)
    parts = [("indicator", s.list_indicators()[0]), ("areaType", s.list_area_types()),
             ("category", s.list_categories("order_count", "nation"))]
    out = [df.select(F.lit(kind).alias("kind"), F.col(df.columns[0]).alias("name")) for kind, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("store_freshness", with_stats(f"""
SELECT (SELECT count(*) FROM (SELECT {CORE_SQL} FROM stats WHERE NOT {SCOPES_SQL} UNION ALL
                              SELECT {CORE_SQL} FROM staged)) AS row_count,
       '2024-06-01T12:00:00.000Z' AS last_updated_at, 'v-customer,v-order_count,v-order_value' AS versions""", STAGED_SQL))
def store_freshness(spark, sf_dir):
    out = _service(spark, sf_dir).freshness()
    return out.select("row_count", "last_updated_at", F.array_join("versions", ",").alias("versions"))


@register("store_timeseries", with_stats("""
SELECT area_name AS area, year, value, unit, category FROM stats
WHERE indicator = 'order_value' AND area_type = 'customer' AND year BETWEEN 1996 AND 1999
ORDER BY area ASC, year ASC, category ASC LIMIT 300 OFFSET 40"""))
def store_timeseries(spark, sf_dir):
    return _service(spark, sf_dir).get_timeseries("order_value", "customer", [], year_from=1996, year_to=1999,
                                                  limit=300, offset=40)[0]


PUBLISHED_SQL = f"""
published AS (SELECT {CORE_SQL} FROM stats WHERE NOT {SCOPES_SQL} UNION ALL SELECT {CORE_SQL} FROM staged)"""


@register("store_years", with_stats("""
SELECT 'all' AS asked, year FROM published
UNION SELECT 'customer counts', year FROM published WHERE indicator = 'order_count' AND area_type = 'customer'
UNION SELECT 'one area', year FROM published WHERE area_type = 'customer' AND area_name = 'Customer#000000007'
UNION SELECT 'one category', year FROM published WHERE category = '1-URGENT' AND area_type = 'customer'
UNION SELECT 'page', year FROM (SELECT DISTINCT year FROM published ORDER BY year LIMIT 2 OFFSET 3)
UNION SELECT 'total of ' || CAST(count(DISTINCT year) AS VARCHAR), NULL FROM published WHERE area_type = 'nation'
""", STAGED_SQL, PUBLISHED_SQL))
def store_years(spark, sf_dir):
    """Year lists of a store, with and without an area; no fact is read."""
    s = _service(spark, sf_dir)
    asked = {"all": {}, "customer counts": {"indicator": "order_count", "area_type": "customer"},
             "one area": {"area_type": "customer", "area": "Customer#000000007"},
             "one category": {"category": "1-URGENT", "area_type": "customer"}, "page": {"limit": 2, "offset": 3}}
    out = s.list_years(area_type="nation")[1].select(F.concat(F.lit("total of "), "total").alias("asked"),
                                                     F.lit(None).cast("int").alias("year"))
    for name, filters in asked.items():
        out = out.unionByName(s.list_years(**filters)[0].select(F.lit(name).alias("asked"), "year"))
    return out


@register("store_year_meta", with_stats("""
SELECT area_type, string_agg(DISTINCT indicator, ',' ORDER BY indicator) AS indicators,
       string_agg(DISTINCT category, ',' ORDER BY category) AS categories,
       string_agg(DISTINCT area_name, ',' ORDER BY area_name) AS areas
FROM published WHERE year = 1998 GROUP BY area_type""", STAGED_SQL, PUBLISHED_SQL))
def store_year_meta(spark, sf_dir):
    out = _service(spark, sf_dir).get_year_meta(1998)
    return out.select("area_type", *[F.array_join(c, ",").alias(c) for c in ("indicators", "categories", "areas")])


@register("store_indicator_meta", with_stats("""
SELECT area_type, 'year' AS field, CAST(year AS VARCHAR) AS value FROM published WHERE indicator = 'order_count'
UNION SELECT area_type, 'category', category FROM published WHERE indicator = 'order_count'
UNION SELECT area_type, 'area', area_name FROM published WHERE indicator = 'order_count'""", STAGED_SQL, PUBLISHED_SQL))
def store_indicator_meta(spark, sf_dir):
    return _service(spark, sf_dir).get_indicator_meta_long("order_count")


@register("store_capabilities", with_stats("""
SELECT string_agg(DISTINCT area_type, ',' ORDER BY area_type) AS area_types,
       string_agg(DISTINCT indicator, ',' ORDER BY indicator) AS indicators,
       string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years,
       25 AS bulk_max_items, 500 AS page_max, 100 AS ranking_max
FROM published""", STAGED_SQL, PUBLISHED_SQL))
def store_capabilities(spark, sf_dir):
    """From the scope table alone: a row per scope, with its years."""
    out = _service(spark, sf_dir).capabilities()
    text = [F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
            for c in ("area_types", "indicators", "years")]
    return out.select(*text, "bulk_max_items", "page_max", "ranking_max")


@register("store_deep_page", with_stats("""
SELECT * FROM (SELECT 'rows' AS kind, area_name AS area, year, value, category FROM published
               WHERE indicator = 'order_count' AND area_type = 'customer' AND year >= 1996
               ORDER BY area_name, year, category LIMIT 200 OFFSET 700)
UNION ALL SELECT 'total', NULL, NULL, CAST(count(*) AS DOUBLE), NULL FROM published
WHERE indicator = 'order_count' AND area_type = 'customer' AND year >= 1996""", STAGED_SQL, PUBLISHED_SQL))
def store_deep_page(spark, sf_dir):
    """A page behind many rows, read from the files that its area range lies in."""
    page, meta, _ = _service(spark, sf_dir).get_timeseries("order_count", "customer", [], year_from=1996, limit=200, offset=700)
    none = F.lit(None)
    return page.select(F.lit("rows").alias("kind"), "area", "year", "value", "category").unionByName(
        meta.select(F.lit("total").alias("kind"), none.cast("string").alias("area"), none.cast("int").alias("year"),
                    F.col("total").cast("double").alias("value"), none.cast("string").alias("category")))


LIKE_PATTERNS = ["ION_1", "CUSTOMER#00000001", "#0", "%", "_", "er#000000007", "zzz", "tion_2"]


@register("store_areas_like", with_stats("""
SELECT DISTINCT p.pattern, s.area_name AS area FROM published s, (VALUES """ + ", ".join(f"('{p}')" for p in LIKE_PATTERNS) + """) p(pattern)
WHERE s.indicator = 'order_count' AND s.area_type IN ('nation', 'customer')
  AND contains(lower(s.area_name), lower(p.pattern))""", STAGED_SQL, PUBLISHED_SQL))
def store_areas_like(spark, sf_dir):
    """Substring search in area names through the store's name index; patterns
    under three letters read the names, literal % and _ match themselves only."""
    s = _service(spark, sf_dir)
    s.store.index_names()
    s = service.StoreService(s.store)
    out = None
    for pattern in LIKE_PATTERNS:
        for area_type in ("nation", "customer"):
            found = s.list_areas("order_count", area_type, like=pattern).select(F.lit(pattern).alias("pattern"), "area")
            out = found if out is None else out.unionByName(found)
    return out


@register("import_counts", with_stats("""
SELECT indicator, area_type, category, count(*) AS imported FROM staged
GROUP BY indicator, area_type, category""", STAGED_SQL))
def import_counts_check(spark, sf_dir):
    _, staged, _ = _publish_inputs(spark, sf_dir)
    return import_counts(staged)


# -------------------------------------------------------------- ledger

def _ledger_events(spark, sf_dir):
    """Orders as an import ledger: every order starts a run; status F ends
    published (row count = order key), P ends failed, O stays started."""
    o = table(spark, sf_dir, "orders")
    run_id = F.concat(F.lit("run-"), F.col("o_orderkey").cast("string"))
    started = F.struct(F.lit("started").alias("status"), F.lit(None).cast("long").alias("row_count"),
                       F.lit(None).cast("string").alias("error_message"),
                       (F.col("o_orderkey") * 2).alias("seq"))
    final = F.when(F.col("o_orderstatus") == "F", F.struct(
        F.lit("published").alias("status"), F.col("o_orderkey").cast("long").alias("row_count"),
        F.lit(None).cast("string").alias("error_message"),
        (F.col("o_orderkey") * 2 + 1).alias("seq"))).when(
        F.col("o_orderstatus") == "P", F.struct(
            F.lit("failed").alias("status"), F.lit(None).cast("long").alias("row_count"),
            F.concat(F.lit("failed order "), F.col("o_orderkey").cast("string"))
            .alias("error_message"),
            (F.col("o_orderkey") * 2 + 1).alias("seq")))
    return (o.select(run_id.alias("run_id"), F.explode(F.array(started, final)).alias("e"))
            .where(F.col("e").isNotNull()).select("run_id", "e.*"))


LEDGER_SQL = """
SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS run_id,
       CASE o_orderstatus WHEN 'F' THEN 'published' WHEN 'P' THEN 'failed' ELSE 'started' END
         AS status,
       CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS row_count,
       CASE WHEN o_orderstatus = 'P' THEN 'failed order ' || CAST(o_orderkey AS VARCHAR) END
         AS error_message
FROM orders"""


@register("run_state", LEDGER_SQL)
def run_state_check(spark, sf_dir):
    return P.run_state(_ledger_events(spark, sf_dir)).select(
        "run_id", "status", "row_count", "error_message")


@register("run_summary", f"""
SELECT count(*) AS total_runs,
       count(*) FILTER (WHERE status = 'published') AS published_runs,
       count(*) FILTER (WHERE status = 'failed') AS failed_runs
FROM ({LEDGER_SQL})""")
def run_summary_check(spark, sf_dir):
    return P.run_summary(P.run_state(_ledger_events(spark, sf_dir)))


# ---------------------------------------------------------------- bulk

def _timeseries_requests(spark, sf_dir):
    """One request per nation (its own name, two categories for odd keys,
    offset key % 3) plus one per region asking for a region name among
    nations, which has no rows."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    cats = F.when(F.col("n_nationkey") % 2 == 1, F.array(F.lit("total"), F.lit("1-URGENT")))
    per_nation = n.select(
        F.col("n_nationkey").cast("long").alias("request_id"),
        F.col("n_nationkey").cast("int").alias("pos"), F.lit("timeseries").alias("kind"),
        F.lit("order_count").alias("indicator"), F.lit("nation").alias("area_type"),
        F.array("n_name").alias("areas"), cats.alias("categories"),
        F.lit(1996).alias("year_from"), F.lit(2000).alias("year_to"),
        F.lit(None).cast("int").alias("year"), F.lit(5).alias("limit"),
        (F.col("n_nationkey") % 3).cast("int").alias("offset"),
        F.lit(None).cast("string").alias("order"))
    per_region = r.select(
        (F.col("r_regionkey") + 1000).cast("long").alias("request_id"),
        (F.col("r_regionkey") + 1000).cast("int").alias("pos"), F.lit("timeseries").alias("kind"),
        F.lit("order_count").alias("indicator"), F.lit("nation").alias("area_type"),
        F.array("r_name").alias("areas"), F.lit(None).cast("array<string>").alias("categories"),
        F.lit(None).cast("int").alias("year_from"), F.lit(None).cast("int").alias("year_to"),
        F.lit(None).cast("int").alias("year"), F.lit(50).alias("limit"), F.lit(0).alias("offset"),
        F.lit(None).cast("string").alias("order"))
    return per_nation.unionByName(per_region)


TS_REQUESTS_SQL = """
req AS (
  SELECT CAST(n_nationkey AS BIGINT) AS request_id, CAST(n_nationkey AS INTEGER) AS pos,
         'order_count' AS indicator, 'nation' AS area_type, [n_name] AS areas,
         CASE WHEN n_nationkey % 2 = 1 THEN ['total', '1-URGENT'] END AS categories,
         1996 AS year_from, 2000 AS year_to, 5 AS "limit", CAST(n_nationkey % 3 AS INTEGER) AS "offset"
  FROM nation
  UNION ALL
  SELECT CAST(r_regionkey + 1000 AS BIGINT), CAST(r_regionkey + 1000 AS INTEGER), 'order_count',
         'nation', [r_name], NULL, NULL, NULL, 50, 0
  FROM region),
matched AS (
  SELECT r.request_id, s.area_name, s.year, s.value, s.unit, s.category,
         r."limit", r."offset",
         row_number() OVER (PARTITION BY r.request_id ORDER BY s.area_name, s.year, s.category) AS rn,
         count(*) OVER (PARTITION BY r.request_id) AS total
  FROM req r JOIN stats s ON s.indicator = r.indicator AND s.area_type = r.area_type
  WHERE (r.areas IS NULL OR len(r.areas) = 0 OR list_contains(r.areas, s.area_name))
    AND (r.categories IS NULL OR len(r.categories) = 0 OR list_contains(r.categories, s.category))
    AND (r.year_from IS NULL OR s.year >= r.year_from)
    AND (r.year_to IS NULL OR s.year <= r.year_to))"""


@register("bulk_timeseries", with_stats("""
SELECT r.request_id, r.pos, m.area_name AS area, m.year, m.value, m.unit, m.category, m.rn,
       coalesce(t.total, 0) AS total, r."limit", r."offset"
FROM req r
LEFT JOIN (SELECT * FROM matched WHERE rn > "offset" AND rn <= "offset" + "limit") m
  ON m.request_id = r.request_id
LEFT JOIN (SELECT request_id, count(*) AS total FROM matched GROUP BY request_id) t
  ON t.request_id = r.request_id""", TS_REQUESTS_SQL))
def bulk_timeseries(spark, sf_dir):
    return B.bulk_timeseries(stats(spark, sf_dir), _timeseries_requests(spark, sf_dir))


def _ranking_requests(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    return r.select(
        F.col("r_regionkey").cast("long").alias("request_id"),
        F.col("r_regionkey").cast("int").alias("pos"), F.lit("ranking").alias("kind"),
        F.lit("order_count").alias("indicator"), F.lit("nation").alias("area_type"),
        F.lit(None).cast("array<string>").alias("areas"),
        F.array(F.lit("total")).alias("categories"),
        F.lit(None).cast("int").alias("year_from"), F.lit(None).cast("int").alias("year_to"),
        (F.col("r_regionkey") + 1995).cast("int").alias("year"),
        (F.col("r_regionkey") + 3).cast("int").alias("limit"),
        F.lit(None).cast("int").alias("offset"),
        F.when(F.col("r_regionkey") % 2 == 0, F.lit("asc")).otherwise(F.lit("desc")).alias("order"))


@register("bulk_ranking", with_stats("""
SELECT r.request_id, r.pos, r.year, r."order", m.area_name AS area, m.value, m.unit, m.category,
       m.rn
FROM req r LEFT JOIN (
  SELECT q.request_id, s.area_name, s.value, s.unit, s.category,
         row_number() OVER (PARTITION BY q.request_id ORDER BY
           CASE WHEN q."order" = 'asc' THEN s.value ELSE -s.value END, s.area_name, s.category) AS rn,
         q."limit"
  FROM req q JOIN stats s ON s.indicator = q.indicator AND s.area_type = q.area_type
    AND s.year = q.year AND list_contains(q.categories, s.category)) m
  ON m.request_id = r.request_id AND m.rn <= m."limit"
""", """
req AS (
  SELECT CAST(r_regionkey AS BIGINT) AS request_id, CAST(r_regionkey AS INTEGER) AS pos,
         'order_count' AS indicator, 'nation' AS area_type, ['total'] AS categories,
         CAST(r_regionkey + 1995 AS INTEGER) AS year, CAST(r_regionkey + 3 AS INTEGER) AS "limit",
         CASE WHEN r_regionkey % 2 = 0 THEN 'asc' ELSE 'desc' END AS "order"
  FROM region)"""))
def bulk_ranking(spark, sf_dir):
    return B.bulk_ranking(stats(spark, sf_dir), _ranking_requests(spark, sf_dir))


def _customer_requests(spark, sf_dir):
    """Per nation one request over all customers, with deep offsets."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("int")
    none = F.lit(None)

    def given(text):   # a value of the row, as in a request table, not a constant of the plan
        return F.when(k >= 0, F.lit(text))

    return n.select(k.cast("long").alias("request_id"), k.alias("pos"), F.lit("timeseries").alias("kind"),
                    given("order_count").alias("indicator"), given("customer").alias("area_type"),
                    none.cast("array<string>").alias("areas"), F.array(F.lit("total")).alias("categories"),
                    (k % 4 + 1995).alias("year_from"), none.cast("int").alias("year_to"),
                    none.cast("int").alias("year"), F.lit(20).alias("limit"), (k * 100).alias("offset"),
                    none.cast("string").alias("order"))


@register("bulk_timeseries_deep", with_stats("""
SELECT r.request_id, r.pos, m.area_name AS area, m.year, m.value, m.unit, m.category, m.rn,
       coalesce(t.total, 0) AS total, r."limit", r."offset"
FROM req r
LEFT JOIN (SELECT * FROM matched WHERE rn > "offset" AND rn <= "offset" + 20) m ON m.request_id = r.request_id
LEFT JOIN (SELECT request_id, count(*) AS total FROM matched GROUP BY request_id) t ON t.request_id = r.request_id
""", """
req AS (SELECT CAST(n_nationkey AS BIGINT) AS request_id, CAST(n_nationkey AS INTEGER) AS pos,
               CAST(n_nationkey % 4 + 1995 AS INTEGER) AS year_from, 20 AS "limit",
               CAST(n_nationkey * 100 AS INTEGER) AS "offset" FROM nation),
matched AS (
  SELECT r.request_id, s.area_name, s.year, s.value, s.unit, s.category, r."offset",
         row_number() OVER (PARTITION BY r.request_id ORDER BY s.area_name, s.year, s.category) AS rn
  FROM req r JOIN stats s ON s.indicator = 'order_count' AND s.area_type = 'customer' AND s.category = 'total'
    AND s.year >= r.year_from)"""))
def bulk_timeseries_deep(spark, sf_dir):
    return B.bulk_timeseries(stats(spark, sf_dir), _customer_requests(spark, sf_dir))


@register("bulk_capabilities", with_stats("""
SELECT CAST(n_nationkey AS BIGINT) AS request_id, CAST(n_nationkey AS INTEGER) AS pos,
       (SELECT string_agg(DISTINCT area_type, ',' ORDER BY area_type) FROM stats) AS area_types,
       (SELECT string_agg(DISTINCT indicator, ',' ORDER BY indicator) FROM stats) AS indicators,
       (SELECT string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) FROM stats) AS years,
       25 AS bulk_max_items, 500 AS page_max, 100 AS ranking_max
FROM nation WHERE n_nationkey % 2 = 0"""))
def bulk_capabilities(spark, sf_dir):
    requests = _customer_requests(spark, sf_dir).withColumn("kind", F.when(
        F.col("request_id") % 2 == 0, "capabilities").otherwise("timeseries"))
    out = B.bulk_capabilities(stats(spark, sf_dir), requests)
    text = [F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
            for c in ("area_types", "indicators", "years")]
    return out.select("request_id", "pos", *text, "bulk_max_items", "page_max", "ranking_max")


STORE_REQUESTS_SQL = """
req AS (SELECT CAST(n_nationkey AS BIGINT) AS request_id, CAST(n_nationkey AS INTEGER) AS pos,
               CAST(n_nationkey % 4 + 1995 AS INTEGER) AS year_from, 20 AS "limit",
               CAST(n_nationkey * 100 AS INTEGER) AS "offset" FROM nation),
matched AS (
  SELECT r.request_id, s.area_name, s.year, s.value, s.unit, s.category, r."offset",
         row_number() OVER (PARTITION BY r.request_id ORDER BY s.area_name, s.year, s.category) AS rn
  FROM req r JOIN published s ON s.indicator = 'order_count' AND s.area_type = 'customer' AND s.category = 'total'
    AND s.year >= r.year_from)"""


@register("store_bulk", with_stats("""
SELECT r.request_id, r.pos, m.area_name AS area, m.year, m.value, m.unit, m.category, m.rn,
       coalesce(t.total, 0) AS total, r."limit", r."offset"
FROM req r
LEFT JOIN (SELECT * FROM matched WHERE rn > "offset" AND rn <= "offset" + 20) m ON m.request_id = r.request_id
LEFT JOIN (SELECT request_id, count(*) AS total FROM matched GROUP BY request_id) t ON t.request_id = r.request_id
""", STAGED_SQL, PUBLISHED_SQL, STORE_REQUESTS_SQL))
def store_bulk(spark, sf_dir):
    """A bulk call of 25 items over a store: totals from its summaries."""
    return _service(spark, sf_dir).execute_bulk(_customer_requests(spark, sf_dir))["timeseries"]


def _mixed_requests(spark, sf_dir):
    """One request per nation with a defect chosen by key % 5: unknown
    indicator, unknown area type, unknown categories, from > to, or none."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey") % 5
    return n.select(
        F.col("n_nationkey").cast("long").alias("request_id"),
        (24 - F.col("n_nationkey")).cast("int").alias("pos"),
        F.when(F.col("n_nationkey") % 2 == 0, F.lit("timeseries")).otherwise(F.lit("ranking"))
        .alias("kind"),
        F.when(k == 0, F.concat(F.lit("bogus_"), F.col("n_name"))).otherwise(F.lit("order_count"))
        .alias("indicator"),
        F.when(k == 1, F.lit("county")).otherwise(F.lit("nation")).alias("area_type"),
        F.array("n_name").alias("areas"),
        F.when(k == 2, F.array(F.lit("total"), F.lower("n_name"), F.lit("zzz")))
        .otherwise(F.array(F.lit("total"))).alias("categories"),
        F.when(k == 3, F.lit(2000)).otherwise(F.lit(1995)).alias("year_from"),
        F.when(k == 3, F.lit(1996)).otherwise(F.lit(2001)).alias("year_to"),
        F.lit(1998).alias("year"), F.lit(10).alias("limit"), F.lit(0).alias("offset"),
        F.lit("desc").alias("order"))


MIXED_SQL = """
req AS (
  SELECT CAST(n_nationkey AS BIGINT) AS request_id, CAST(24 - n_nationkey AS INTEGER) AS pos,
         CASE WHEN n_nationkey % 5 = 0 THEN 'bogus_' || n_name ELSE 'order_count' END AS indicator,
         CASE WHEN n_nationkey % 5 = 1 THEN 'county' ELSE 'nation' END AS area_type,
         CASE WHEN n_nationkey % 5 = 2 THEN ['total', lower(n_name), 'zzz'] ELSE ['total'] END
           AS categories,
         CASE WHEN n_nationkey % 5 = 3 THEN 2000 ELSE 1995 END AS year_from,
         CASE WHEN n_nationkey % 5 = 3 THEN 1996 ELSE 2001 END AS year_to
  FROM nation),
inds AS (SELECT DISTINCT indicator FROM stats),
typs AS (SELECT DISTINCT area_type FROM stats),
cats AS (SELECT DISTINCT indicator, area_type, category FROM stats),
checks AS (
  SELECT request_id, pos, 0 AS ordinal, 'range' AS field,
         CAST(year_from AS VARCHAR) || '>' || CAST(year_to AS VARCHAR) AS value, NULL AS allowed
  FROM req WHERE year_from > year_to
  UNION ALL
  SELECT request_id, pos, 1, 'indicator', indicator,
         (SELECT string_agg(indicator, ',' ORDER BY indicator) FROM inds)
  FROM req WHERE indicator NOT IN (SELECT indicator FROM inds)
  UNION ALL
  SELECT request_id, pos, 2, 'areaType', area_type,
         (SELECT string_agg(area_type, ',' ORDER BY area_type) FROM typs)
  FROM req WHERE area_type NOT IN (SELECT area_type FROM typs)
  UNION ALL
  SELECT u.request_id, u.pos, 3, 'category', u.category,
         coalesce((SELECT string_agg(c.category, ',' ORDER BY c.category) FROM cats c
                   WHERE c.indicator = u.indicator AND c.area_type = u.area_type), '')
  FROM (
    SELECT request_id, pos, indicator, area_type, arg_min(category, cpos) AS category
    FROM (SELECT request_id, pos, indicator, area_type, unnest(categories) AS category,
                 generate_subscripts(categories, 1) AS cpos FROM req) w
    WHERE NOT EXISTS (SELECT 1 FROM cats c WHERE c.indicator = w.indicator
                        AND c.area_type = w.area_type AND c.category = w.category)
    GROUP BY request_id, pos, indicator, area_type) u),
firsts AS (
  SELECT request_id, pos, arg_min(field, ordinal) AS field, arg_min(value, ordinal) AS value,
         arg_min(allowed, ordinal) AS allowed
  FROM checks GROUP BY request_id, pos)"""


def _invalid(spark, sf_dir):
    out = B.invalid_requests(stats(spark, sf_dir), _mixed_requests(spark, sf_dir))
    return out.withColumn("allowed", F.array_join("allowed", ","))


@register("unknown_domain_values", with_stats(
    "SELECT request_id, pos, field, value, allowed FROM firsts", MIXED_SQL))
def unknown_domain_values(spark, sf_dir):
    return _invalid(spark, sf_dir)


@register("bulk_invalid", with_stats(
    "SELECT request_id, pos, field, value, allowed FROM firsts ORDER BY pos LIMIT 1", MIXED_SQL))
def bulk_invalid(spark, sf_dir):
    return _invalid(spark, sf_dir).orderBy("pos").limit(1)


LIST_TEXT_SQL = ("o_orderpriority || chr(9) || ', ' || chr(10) || chr(13) || o_orderstatus || ',' || o_orderpriority || "
                 "CASE WHEN o_orderkey % 4 = 0 THEN ',,' ELSE '' END")


@register("normalize_lists", f"""
WITH src AS (SELECT o_orderkey AS k, {LIST_TEXT_SQL} AS s FROM orders),
tok AS (SELECT k, trim(unnest(string_split(s, ',')), ' ' || chr(9) || chr(10) || chr(13)) AS t,
               generate_subscripts(string_split(s, ','), 1) AS i FROM src),
firsts AS (SELECT k, t, min(i) AS i FROM tok GROUP BY k, t)
SELECT f.k AS o_orderkey, f.list AS areas_list, e.has_empty AS areas_has_empty,
       e.too_long AS areas_too_long
FROM (SELECT k, string_agg(t, '|' ORDER BY i) AS list FROM firsts GROUP BY k) f
JOIN (SELECT k, bool_or(t = '') AS has_empty, max(length(t)) > {QUERY_AREA_MAX} AS too_long
      FROM tok GROUP BY k) e ON e.k = f.k
""")
def normalize_lists(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = F.concat(F.col("o_orderpriority"), F.lit("\t, \n\r"), F.col("o_orderstatus"), F.lit(","),
                    F.col("o_orderpriority"),
                    F.when(F.col("o_orderkey") % 4 == 0, F.lit(",,")).otherwise(F.lit("")))
    out = B.normalize_lists(o.select("o_orderkey", text.alias("areas")), "areas", QUERY_AREA_MAX)
    return out.select("o_orderkey", F.array_join("areas_list", "|").alias("areas_list"),
                      "areas_has_empty", "areas_too_long")


# ----------------------------------------------------- sources and catalogue

def _manifests(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    manifest = pages.select(F.col("url").alias("path"), F.length("html").cast("long").alias("size"),
                            (F.col("page_id") * 1000).alias("mtime_ms"))
    listing = pages.select(
        F.col("url").alias("path"),
        (F.length("html") + F.when(F.col("page_id") % 4 == 0, 1).otherwise(0))
        .cast("long").alias("size"),
        (F.col("page_id") * 1000 + F.when(F.col("page_id") % 9 == 0, 5).otherwise(0))
        .alias("mtime_ms"))
    return listing, manifest


@register("changed_sources", """
WITH manifest AS (SELECT url AS path, CAST(length(html) AS BIGINT) AS size,
                         page_id * 1000 AS mtime_ms FROM pages),
listing AS (SELECT url AS path,
                   CAST(length(html) + CASE WHEN page_id % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS size,
                   page_id * 1000 + CASE WHEN page_id % 9 = 0 THEN 5 ELSE 0 END AS mtime_ms
            FROM pages)
SELECT l.path, l.size, l.mtime_ms, NOT EXISTS (
  SELECT 1 FROM manifest m WHERE m.path = l.path AND m.size = l.size AND m.mtime_ms = l.mtime_ms)
  AS updated
FROM listing l
""")
def changed_sources_check(spark, sf_dir):
    listing, manifest = _manifests(spark, sf_dir)
    return changed_sources(listing, manifest)


def _catalog_targets(spark, sf_dir):
    """Every page URL as a dataset URL, varied by page id: padded with a
    trailing slash (URL match), moved to another host (file-name match), or
    given a query string on another host (file-name match after the cut)."""
    pages = table(spark, sf_dir, "pages")
    name = F.regexp_extract(F.regexp_replace(F.col("url"), r"[?#].*$", ""), r"([^/]*)/*$", 1)
    v = F.col("page_id") % 3
    url = (F.when(v == 0, F.concat(F.lit(" "), F.col("url"), F.lit("/ ")))
           .when(v == 1, F.concat(F.lit("https://mirror.example.org/files/"), name))
           .otherwise(F.concat(F.lit("https://cdn.example.org/x/"), name, F.lit("?v=2#top"))))
    return pages.select(F.col("page_id").alias("target_id"), url.alias("url"))


@register("catalog_match", r"""
WITH res AS (
  SELECT page_id AS pos, regexp_replace(trim(url), '/+$', '') AS norm_url FROM pages),
res2 AS (
  SELECT pos, norm_url,
         regexp_extract(regexp_extract(norm_url, '^([^?#]*)', 1), '([^/]*)$', 1) AS file_name
  FROM res),
by_url AS (SELECT norm_url, min(pos) AS p FROM res2 GROUP BY norm_url),
by_file AS (SELECT file_name, min(pos) AS p FROM res2 WHERE file_name <> '' GROUP BY file_name),
tg AS (
  SELECT page_id AS target_id,
         CASE page_id % 3
           WHEN 0 THEN ' ' || url || '/ '
           WHEN 1 THEN 'https://mirror.example.org/files/'
                       || regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/*$', 1)
           ELSE 'https://cdn.example.org/x/'
                || regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/*$', 1) || '?v=2#top'
         END AS url
  FROM pages),
tg2 AS (
  SELECT target_id, url, regexp_replace(trim(url), '/+$', '') AS norm_url FROM tg),
tg3 AS (
  SELECT target_id, url, norm_url,
         regexp_extract(regexp_extract(norm_url, '^([^?#]*)', 1), '([^/]*)$', 1) AS file_name
  FROM tg2)
SELECT t.target_id, t.url, least(u.p, f.p) AS match_pos
FROM tg3 t LEFT JOIN by_url u ON u.norm_url = t.norm_url
LEFT JOIN by_file f ON f.file_name = t.file_name
""")
def catalog_match(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    resources = pages.select(F.col("page_id").alias("pos"), "url")
    return match_catalog(resources, _catalog_targets(spark, sf_dir))


@register("catalog_parse", """
SELECT page_id AS pos, url FROM pages WHERE page_id % 3 = 0
UNION ALL SELECT page_id, url || '/x' FROM pages WHERE page_id % 3 = 0
UNION ALL SELECT page_id, url FROM pages WHERE page_id % 3 = 1
""")
def catalog_parse(spark, sf_dir):
    """Pages as catalogue entries: two resources; a numeric url with a nested text
    one; a url that is text next to one that is none.  Only text urls count."""
    pages = table(spark, sf_dir, "pages")
    text = lambda u: F.to_json(F.struct(u.alias("url"), F.lit("csv").alias("format")))
    number = F.to_json(F.struct(F.lit(5).alias("url"), F.struct(F.col("url")).alias("m")))
    k = F.col("page_id") % 3
    resources = (F.when(k == 0, F.array(text(F.col("url")), text(F.concat("url", F.lit("/x")))))
                 .when(k == 1, F.array(number, text(F.col("url")), F.lit('{"format": "none"}')))
                 .otherwise(F.array(number, F.lit('{"url": null}'), F.lit("not json"))))
    return resource_urls(pages.select(F.col("page_id").alias("pos"), resources.alias("resources")))
