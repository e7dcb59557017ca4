"""Query keys of inputs and checks: mixed encodings, catalogue documents, changed
sources, dirty cells and rows, locale order.  As in ``checks``, files are written
by Spark from the driver tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions.columns import thousands_dot
from statlake.operators import quality as Q
from statlake.operators import query as q
from statlake.operators.paging import numbered
from statlake.operators.publish import FactStore
from statlake.operators.reshape import DatasetImportError, check_years, to_tidy
from statlake.plans.checks import (
    CATEGORIES_SPEC,
    CORE_SQL,
    YEARS_SPEC,
    YEARS_SQL,
    core,
    fixed_run,
)
from statlake.plans.derived import PRIORITIES, stats, table, wide_categories, wide_years
from statlake.plans.importer import import_many, stage
from statlake.plans.oracle import with_stats
from statlake.plans.registry import register
from statlake.plans.spec import Category, CategoryColumn, CsvOptions, DatasetSpec, UnpivotCategories
from statlake.session import scratch_path
from statlake.sources.catalog import read_catalog, resource_urls
from statlake.sources.csv import write_delimited
from statlake.sources.files import version_of


def _spec(spec_id: str, area_column: str = "Stadtteil", columns=None, csv=None, parser="first") -> DatasetSpec:
    return DatasetSpec(
        id=spec_id, url=f"file:///{spec_id}.csv", csv_filename=f"{spec_id}.csv", area_type="customer",
        area_column=area_column, csv=csv or CsvOptions(), format=UnpivotCategories(
            year_column="Jahr", year_parser=parser, keep_last=True, filter_column="Merkmal", filter_value="Auftraege",
            indicator="order_count", unit="orders",
            columns=columns or tuple(CategoryColumn(Category(p), value_column=p) for p in PRIORITIES)))


# -------------------------------------------------------------------- files

@register("encoding_mixed_folder", with_stats(f"""
SELECT indicator, area_type, 'Kö ' || area_name AS area_name, year, value, unit, category FROM stats
WHERE indicator = 'order_count' AND area_type = 'customer' AND category <> 'total'"""))
def encoding_mixed_folder(spark, sf_dir):
    """A folder with UTF-8 files next to latin-1 ones: every file is read in its own encoding."""
    wide = wide_categories(spark, sf_dir).withColumn("Stadtteil", F.concat(F.lit("Kö "), "Stadtteil"))
    odd = F.col("Stadtteil").rlike("[13579]$")
    path = write_delimited(wide.where(odd), scratch_path(spark, "mixed"), encoding="utf-8")
    (wide.where(~odd).write.mode("append").option("sep", ";").option("header", "true")
     .option("encoding", "ISO-8859-1").csv(path))
    spec = _spec("customer_orders_mixed", csv=CsvOptions(fallback_encodings=("latin-1",)))
    return core(stage(spark, spec, path, fixed_run(spec.id))[0])


@register("changed_import", with_stats(f"""
SELECT dataset_id, attempt, updated, CASE WHEN updated THEN n ELSE 0 END AS imported
FROM (SELECT 'customer_orders_by_year' AS dataset_id, count(*) AS n FROM ({YEARS_SQL})
      UNION ALL SELECT 'customer_orders_by_priority', count(*) FROM stats
      WHERE indicator = 'order_count' AND area_type = 'customer' AND category <> 'total') d,
     (VALUES (1, true), (2, false)) a(attempt, updated)
UNION ALL
SELECT 'customer_orders_by_year', 3, false, 0
UNION ALL
SELECT 'customer_orders_by_priority', 3, true, 2 * count(*) FROM stats
WHERE indicator = 'order_count' AND area_type = 'customer' AND category <> 'total'"""))
def changed_import(spark, sf_dir):
    """Two sources imported three times: all; nothing, as nothing has changed; the
    one that has got another file since."""
    s = stats(spark, sf_dir)
    years = write_delimited(wide_years(spark, sf_dir, stats_df=s), scratch_path(spark, "changed-a"))
    categories = write_delimited(wide_categories(spark, sf_dir, stats_df=s), scratch_path(spark, "changed-b"))
    specs, paths = [YEARS_SPEC, CATEGORIES_SPEC], {YEARS_SPEC.id: years, CATEGORIES_SPEC.id: categories}
    store, out = FactStore(spark, scratch_path(spark, "store")), []
    for attempt in (1, 2, 3):
        if attempt == 3:
            (wide_categories(spark, sf_dir).withColumn("Stadtteil", F.concat(F.lit("new "), "Stadtteil"))
             .write.mode("append").option("sep", ";").option("header", "true").csv(categories))
        out += [(r.dataset_id, attempt, r.updated, r.imported) for r in import_many(spark, specs, "", store, paths)]
    return spark.createDataFrame(out, "dataset_id string, attempt int, updated boolean, imported long")


@register("version_of_many_files", """
SELECT count(*) AS pages, true AS same_in_any_order, true AS other_for_other_files FROM pages""")
def version_of_many_files(spark, sf_dir):
    """The version of all pages as files: the same for any order of the listing
    and any number of tasks, another one when a single file differs."""
    listing = table(spark, sf_dir, "pages").select(
        F.col("url").alias("path"), F.octet_length("html").cast("long").alias("size"),
        (F.col("page_id") * 1000).alias("mtime_ms"), "page_id")
    last = listing.agg(F.max("page_id")).first()[0]
    versions = [version_of(x) for x in (
        listing, listing.orderBy(F.desc("page_id")).repartition(3), listing.repartition(7, "path"),
        listing.withColumn("size", F.col("size") + F.when(F.col("page_id") == last, 1).otherwise(0)))]
    n = int(versions[0].split(";")[0].partition(":")[2])
    same, other = len(set(versions[:3])) == 1, versions[3] != versions[0]
    return listing.agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") == n).select(
        "pages", F.lit(same).alias("same_in_any_order"), F.lit(other).alias("other_for_other_files"))


# ---------------------------------------------------------------- catalogue

@register("catalog_document", """
WITH e AS (SELECT page_id, url, row_number() OVER (ORDER BY page_id) - 1 AS pos FROM pages)
SELECT d.kind, e.pos, e.url FROM e, (VALUES ('array'), ('result'), ('lines')) d(kind) WHERE e.page_id % 4 <> 3
""")
def catalog_document(spark, sf_dir):
    """Pages as entries of a catalogue written to files: an array, an object with
    a ``result`` array, JSON lines; every fourth item is no object."""
    pages = table(spark, sf_dir, "pages")
    entry = F.to_json(F.struct(F.col("page_id").alias("id"), F.array(
        F.struct(F.col("url").alias("url"), F.lit("csv").alias("format"))).alias("resources")))
    item = F.when(F.col("page_id") % 4 == 3, F.element_at(
        F.array(F.lit("7"), F.lit("null"), F.lit('"text"'), F.lit('[{"resources": []}]')),
        (F.floor(F.col("page_id") / 4) % 4 + 1).cast("int"))).otherwise(entry)
    rows = pages.select("page_id", item.alias("item"))
    items = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_id", "item"))), lambda x: x["item"]), ",")
    out = None
    for kind, head, tail in (("array", " [", "] "), ("result", '{"count": 1, "result": [', '], "help": {}}'), ("lines", "", "")):
        path = scratch_path(spark, f"catalog-{kind}")
        if kind == "lines":   # in the order of the pages, one file per range
            rows.repartitionByRange("page_id").sortWithinPartitions("page_id").select("item").write.text(path)
        else:
            rows.agg(F.concat(F.lit(head), items, F.lit(tail)).alias("value")).write.text(path)
        found = resource_urls(read_catalog(spark, path, lines=kind == "lines"))
        if kind == "lines":   # places of lines are ordered, not dense
            found = found.join(numbered(read_lines(spark, path), "pos", name="at").select("pos", (F.col("at") - 1).alias("at")), "pos") \
                .select(F.col("at").alias("pos"), "url")
        found = found.select(F.lit(kind).alias("kind"), F.col("pos").cast("long").alias("pos"), "url")
        out = found if out is None else out.unionByName(found)
    return out


def read_lines(spark, path):
    """The places that ``read_catalog`` gives the lines of a folder."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.monotonically_increasing_id().alias("pos"))


# ---------------------------------------------------------- cells and rows

@register("thousands_dot", """
SELECT l_orderkey, l_linenumber, CAST(l_orderkey * 1000 + l_linenumber AS DOUBLE) AS value FROM lineitem""")
def thousands_dot_check(spark, sf_dir):
    """``12.345.678`` as written in local tables."""
    li = table(spark, sf_dir, "lineitem")
    text = F.replace(F.format_number(F.col("l_orderkey") * 1000 + F.col("l_linenumber"), 0), F.lit(","), F.lit("."))
    return li.select("l_orderkey", "l_linenumber", thousands_dot(text).cast("double").alias("value"))


@register("null_areas_dropped", with_stats(f"""
SELECT {CORE_SQL} FROM stats WHERE indicator = 'order_count' AND area_type = 'customer' AND category <> 'total'
  AND area_name NOT LIKE '%5'"""))
def null_areas_dropped(spark, sf_dir):
    """Rows without an area are no facts (categories as columns)."""
    wide = wide_categories(spark, sf_dir)
    wide = wide.withColumn("Stadtteil", F.when(~F.col("Stadtteil").endswith("5"), F.col("Stadtteil")))
    path = write_delimited(wide, scratch_path(spark, "null-areas"))
    spec = _spec("customer_orders_null_areas")
    return core(stage(spark, spec, path, fixed_run(spec.id))[0])


@register("plain_years", with_stats(f"""
SELECT {CORE_SQL} FROM stats WHERE indicator = 'order_count' AND area_type = 'customer' AND category <> 'total'"""))
def plain_years(spark, sf_dir):
    """A year column that holds plain years and needs no parser."""
    wide = wide_categories(spark, sf_dir).withColumn("Jahr", F.substring("Jahr", 7, 4))
    path = write_delimited(wide, scratch_path(spark, "plain-years"))
    spec = _spec("customer_orders_plain_years", parser=None)
    return core(stage(spark, spec, path, fixed_run(spec.id))[0])


@register("raw_years_checked", with_stats("""
SELECT 'as written' AS input, count(*) FILTER (year NOT BETWEEN 1900 AND 2100) AS bad_rows, 'accepted' AS outcome FROM stats
WHERE indicator = 'order_count' AND area_type = 'customer' AND category = 'total'
UNION ALL
SELECT 'bad years where the feature differs', count(*) FILTER (year = 1997), 'rejected' FROM stats
WHERE indicator = 'order_count' AND area_type = 'customer' AND category = 'total'
UNION ALL
SELECT 'no year at all', 0, 'rejected'"""))
def raw_years_checked(spark, sf_dir):
    """The years of all raw rows are checked, also of rows that the feature filter drops."""
    s = stats(spark, sf_dir).where("indicator = 'order_count' AND area_type = 'customer' AND category = 'total'")
    wide = s.select(F.lit("Auftraege").alias("Merkmal"), F.concat(F.lit("31.12."), "year").alias("Jahr"),
                    F.col("area_name").alias("Stadtteil"), F.col("value").cast("long").cast("string").alias("insgesamt"))
    bad = F.col("Jahr").endswith("1997")
    spec = _spec("customer_orders_years", columns=(CategoryColumn(Category("total"), value_column="insgesamt"),))
    inputs = {"as written": wide,
              "bad years where the feature differs": wide.withColumn("Merkmal", F.when(bad, "Anderes").otherwise(F.col("Merkmal")))
              .withColumn("Jahr", F.when(bad, "31.12.1799").otherwise(F.col("Jahr"))),
              "no year at all": wide.withColumn("Jahr", F.lit(None).cast("string"))}
    out = []
    for name, frame in inputs.items():
        path = write_delimited(frame, scratch_path(spark, "raw-years"))
        read = spark.read.option("sep", ";").option("header", "true").csv(path)
        try:
            check_years(read, spec)
            outcome = "accepted"
        except DatasetImportError:
            outcome = "rejected"
        out.append((name, read.where(F.col("Jahr").endswith("1799")).count(), outcome))
    return spark.createDataFrame(out, "input string, bad_rows long, outcome string")


@register("dq_staged_faults", with_stats("""
SELECT count(*) AS "rows", 0 AS null_indicator, 0 AS null_area_type, count(*) FILTER (area_name IS NULL) AS null_area_name,
       count(*) FILTER (year IS NULL) AS null_year, count(*) FILTER (value IS NULL) AS null_value, 0 AS null_unit, 0 AS null_category,
       count(*) FILTER (isnan(value) OR isinf(value)) AS non_finite_values,
       count(*) FILTER (year NOT BETWEEN 1900 AND 2100) AS years_out_of_range,
       count(*) - count(DISTINCT (indicator, area_type, area_name, year, category)) AS duplicate_keys
FROM (SELECT indicator, area_type, CASE WHEN category = '2-HIGH' AND year = 1996 THEN NULL ELSE area_name END AS area_name,
             CASE year WHEN 1995 THEN 1899 WHEN 1996 THEN 2101 WHEN 1997 THEN NULL WHEN 1998 THEN 1900 ELSE year END AS year,
             CASE category WHEN '1-URGENT' THEN 'NaN'::DOUBLE WHEN '3-MEDIUM' THEN 'Infinity'::DOUBLE
                           WHEN '5-LOW' THEN NULL ELSE value END AS value, category FROM stats)"""))
def dq_staged_faults(spark, sf_dir):
    """A staged set with every fault that a publish refuses."""
    s, year, category = stats(spark, sf_dir), F.col("year"), F.col("category")
    faulty = s.select(
        "indicator", "area_type", "unit", "category",
        F.when(~((category == "2-HIGH") & (year == 1996)), F.col("area_name")).alias("area_name"),
        F.when(year == 1995, 1899).when(year == 1996, 2101).when(year == 1997, None).when(year == 1998, 1900)
        .otherwise(year).alias("year"),
        F.when(category == "1-URGENT", float("nan")).when(category == "3-MEDIUM", float("inf"))
        .when(category == "5-LOW", None).otherwise(F.col("value")).alias("value"))
    out = Q.staged_violations(faulty)
    return out.select(*[F.col(c).cast("int").alias(c) if c in ("null_indicator", "null_area_type", "null_unit", "null_category")
                        else F.col(c) for c in out.columns])


# ------------------------------------------------------------- locale order

def _both_cases(spark, sf_dir):
    """Facts of all areas, and once more with the names in lower case."""
    s = stats(spark, sf_dir)
    return s.unionByName(s.withColumn("area_name", F.lower("area_name")))


BOTH_CASES_SQL = """
both_cases AS (SELECT area_type, indicator, year, category, area_name FROM stats
               UNION ALL SELECT area_type, indicator, year, category, lower(area_name) FROM stats)"""


@register("areas_locale_order", with_stats("""
SELECT area, row_number() OVER (ORDER BY lower(area), area DESC) AS position
FROM (SELECT DISTINCT area_name AS area FROM both_cases)""", BOTH_CASES_SQL))
def areas_locale_order(spark, sf_dir):
    """All area names of the fact table in locale order (small letters before
    capital ones), each with its place; no task holds them all."""
    areas = _both_cases(spark, sf_dir).select(F.col("area_name").alias("area")).distinct()
    return numbered(areas, F.collate(F.col("area"), "UNICODE"))


@register("meta_locale_order", with_stats("""
SELECT 'year' AS kind, area_type, string_agg(area_name, ',' ORDER BY lower(area_name), area_name DESC) AS areas
FROM (SELECT DISTINCT area_type, area_name FROM both_cases WHERE year = 1998 AND area_type <> 'customer') GROUP BY area_type
UNION ALL
SELECT 'indicator', area_type, string_agg(area_name, ',' ORDER BY lower(area_name), area_name DESC)
FROM (SELECT DISTINCT area_type, area_name FROM both_cases WHERE indicator = 'order_value') GROUP BY area_type
""", BOTH_CASES_SQL))
def meta_locale_order(spark, sf_dir):
    """The arrays of the metadata in locale order."""
    s = _both_cases(spark, sf_dir)
    found = {"year": q.year_meta(s.where("area_type != 'customer'"), 1998, "UNICODE"),
             "indicator": q.indicator_meta(s, "order_value", "UNICODE")}
    text = F.array_join(F.transform("areas", lambda a: F.collate(a, "UTF8_BINARY")), ",")
    parts = [df.select(F.lit(kind).alias("kind"), "area_type", text.alias("areas")) for kind, df in found.items()]
    return parts[0].unionByName(parts[1])
