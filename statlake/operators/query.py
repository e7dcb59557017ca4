"""Read operators over the tidy fact table.

Every function takes the fact DataFrame and returns a DataFrame; nothing is
collected.  Filters are plain column predicates, so Catalyst pushes them into
the Parquet scan (and prunes ``indicator/area_type/category`` partitions of a
published store).  Top-k and pages become ``TakeOrderedAndProject``: each task
keeps only ``offset + limit`` rows, so no global sort of the fact table runs.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.columns import iso_utc
from statlake.operators.paging import after, ordered_page
from statlake.schema import (
    BULK_ITEMS_MAX,
    PAGINATION_LIMIT_DEFAULT,
    PAGINATION_LIMIT_MAX,
    PAGINATION_LIMIT_MIN,
    RANKING_LIMIT_DEFAULT,
    RANKING_LIMIT_MAX,
    RANKING_LIMIT_MIN,
)


class StatisticsValidationError(ValueError):
    def __init__(self, message: str, details: dict | None = None):
        super().__init__(message)
        self.details = details or {}


class StatisticsNotFoundError(LookupError):
    pass


def _check_page(limit, offset):
    if limit is not None and not (PAGINATION_LIMIT_MIN <= int(limit) <= PAGINATION_LIMIT_MAX):
        raise StatisticsValidationError(
            f"limit must be within {PAGINATION_LIMIT_MIN}..{PAGINATION_LIMIT_MAX}")
    if offset is not None and int(offset) < 0:
        raise StatisticsValidationError("offset must be >= 0")


def _check_range(year_from, year_to):
    if year_from is not None and year_to is not None and year_from > year_to:
        raise StatisticsValidationError("from must be <= to", {"from": year_from, "to": year_to})


def where_all(df: DataFrame, conditions: list[Column]) -> DataFrame:
    """Dynamic AND of the supplied filters (none -> the frame as is)."""
    return df.filter(reduce(and_, conditions)) if conditions else df


def equality_filters(**values) -> list[Column]:
    return [F.col(name) == F.lit(v) for name, v in values.items() if v is not None]


def in_list(column: str, items) -> list[Column]:
    """IN-list filter; an absent or empty list filters nothing."""
    if not items:
        return []
    return [F.col(column).isin(list(items))]


# ---------------------------------------------------------------- timeseries

def timeseries_filter(stats: DataFrame, indicator: str, area_type: str, areas=None,
                      categories=None, year_from: int | None = None,
                      year_to: int | None = None) -> DataFrame:
    _check_range(year_from, year_to)
    cond = equality_filters(indicator=indicator, area_type=area_type)
    cond += in_list("area_name", areas) + in_list("category", categories)
    if year_from is not None:
        cond.append(F.col("year") >= F.lit(int(year_from)))
    if year_to is not None:
        cond.append(F.col("year") <= F.lit(int(year_to)))
    return where_all(stats, cond)


def timeseries(stats: DataFrame, indicator: str, area_type: str, areas=None, categories=None,
               year_from: int | None = None, year_to: int | None = None,
               limit: int = PAGINATION_LIMIT_DEFAULT, offset: int = 0,
               last: tuple | None = None) -> DataFrame:
    """Rows (area, year, value, unit, category) of one page, ordered by area,
    year and (engine tie-break) category.  ``last``, the (area, year, category)
    of the row before the page, replaces a deep offset at constant cost."""
    _check_page(limit, offset)
    rows = timeseries_filter(stats, indicator, area_type, areas, categories, year_from, year_to)
    if last is not None:
        rows = after(rows, ["area_name", "year", "category"], last)
    return ordered_page(
        rows.select(F.col("area_name").alias("area"), "year", "value", "unit", "category"),
        ["area", "year", "category"], offset, limit)


def page_areas(page: DataFrame, collation: str | None = None) -> DataFrame:
    """Distinct areas of a returned page (not of the whole filter); binary
    order, or locale order with ``collation="UNICODE"``."""
    areas = page.select("area").distinct()
    return areas.orderBy(F.collate(F.col("area"), collation) if collation else F.col("area"))


def page_meta(filtered: DataFrame, limit: int | None, offset: int = 0,
              distinct_column: str | None = None, total: Column | None = None) -> DataFrame:
    """One row ``total, limit, offset, has_more`` for a filtered set (``total``:
    its size where rows stand for several).

    ``distinct_column`` counts distinct values (lists of years / indicators);
    with ``limit=None`` the list is unpaged: limit = total, has_more = false.
    """
    if total is None:
        total = (F.count_distinct(distinct_column) if distinct_column else F.count(F.lit(1)))
    agg = filtered.agg(total.alias("total"))
    tot = F.col("total")
    if limit is None:
        return agg.select(tot, tot.cast("int").alias("limit"), F.lit(int(offset)).alias("offset"),
                          F.lit(False).alias("has_more"))
    on_page = F.least(F.lit(int(limit)).cast("long"),
                      F.greatest(tot - F.lit(int(offset)), F.lit(0)))
    return agg.select(tot, F.lit(int(limit)).alias("limit"), F.lit(int(offset)).alias("offset"),
                      ((F.lit(int(offset)) + on_page) < tot).alias("has_more"))


def timeseries_meta(stats: DataFrame, indicator: str, area_type: str, areas=None,
                    categories=None, year_from=None, year_to=None,
                    limit: int = PAGINATION_LIMIT_DEFAULT, offset: int = 0) -> DataFrame:
    _check_page(limit, offset)
    rows = timeseries_filter(stats, indicator, area_type, areas, categories, year_from, year_to)
    return page_meta(rows, limit, offset)


# ------------------------------------------------------------------ ranking

def ranking(stats: DataFrame, indicator: str, area_type: str, year: int, categories=None,
            areas=None, limit: int = RANKING_LIMIT_DEFAULT, order: str = "desc") -> DataFrame:
    """Top-k areas by value for one year; ties broken by area, category."""
    if not (RANKING_LIMIT_MIN <= int(limit) <= RANKING_LIMIT_MAX):
        raise StatisticsValidationError(
            f"limit must be within {RANKING_LIMIT_MIN}..{RANKING_LIMIT_MAX}")
    if order not in ("asc", "desc"):
        raise StatisticsValidationError("order must be asc or desc")
    cond = equality_filters(indicator=indicator, area_type=area_type, year=int(year))
    cond += in_list("category", categories) + in_list("area_name", areas)
    value = F.col("value").asc() if order == "asc" else F.col("value").desc()
    return (where_all(stats, cond)
            .select(F.col("area_name").alias("area"), "value", "unit", "category")
            .orderBy(value, F.col("area").asc(), F.col("category").asc())
            .limit(int(limit)))


# ---------------------------------------------------------------- discovery

def list_areas(stats: DataFrame, indicator: str, area_type: str, category: str | None = None,
               like: str | None = None) -> DataFrame:
    cond = equality_filters(indicator=indicator, area_type=area_type, category=category)
    if like:
        # substring test on lower case; %, _ and \ are literal characters
        cond.append(F.lower(F.col("area_name")).contains(F.lit(like.lower())))
    return (where_all(stats, cond).select(F.col("area_name").alias("area"))
            .distinct().orderBy("area"))


def list_areas_indexed(names: DataFrame, indicator: str, area_type: str, category: str | None, like: str) -> DataFrame:
    """``list_areas`` with a pattern of three letters and more, over a name index
    (``FactStore.index_names``): names that have all of the pattern's trigrams
    are candidates, and only those are compared with it."""
    text = like.lower()
    wanted = sorted({text[k:k + 3] for k in range(len(text) - 2)})
    rows = where_all(names, equality_filters(indicator=indicator, area_type=area_type, category=category))
    found = (rows.where(F.col("trigram").isin(wanted)).groupBy("area_name")
             .agg(F.count_distinct("trigram").alias("n")).where(F.col("n") == len(wanted)))
    return (found.where(F.lower(F.col("area_name")).contains(F.lit(text)))
            .select(F.col("area_name").alias("area")).orderBy("area"))


def list_categories(stats: DataFrame, indicator: str, area_type: str) -> DataFrame:
    cond = equality_filters(indicator=indicator, area_type=area_type)
    return where_all(stats, cond).select("category").distinct().orderBy("category")


def _list_page(df: DataFrame, column: str, limit, offset) -> DataFrame:
    if limit is None:
        return df.select(column).distinct().orderBy(column)
    return ordered_page(df.select(column).distinct(), [column], offset, limit)


def years_filter(stats, indicator=None, area_type=None, category=None, area=None):
    return where_all(stats, equality_filters(indicator=indicator, area_type=area_type,
                                             category=category, area_name=area))


def list_years(stats: DataFrame, indicator=None, area_type=None, category=None, area=None,
               limit: int | None = None, offset: int = 0) -> DataFrame:
    _check_page(limit, offset)
    return _list_page(years_filter(stats, indicator, area_type, category, area), "year",
                      limit, offset)


def years_meta(stats: DataFrame, indicator=None, area_type=None, category=None, area=None,
               limit: int | None = None, offset: int = 0) -> DataFrame:
    _check_page(limit, offset)
    return page_meta(years_filter(stats, indicator, area_type, category, area), limit, offset,
                     distinct_column="year")


def indicators_filter(stats, area_type=None, area=None, year=None):
    return where_all(stats, equality_filters(area_type=area_type, area_name=area, year=year))


def list_indicators(stats: DataFrame, area_type=None, area=None, year=None,
                    limit: int | None = None, offset: int = 0) -> DataFrame:
    _check_page(limit, offset)
    return _list_page(indicators_filter(stats, area_type, area, year), "indicator", limit, offset)


def indicators_meta(stats: DataFrame, area_type=None, area=None, year=None,
                    limit: int | None = None, offset: int = 0) -> DataFrame:
    _check_page(limit, offset)
    return page_meta(indicators_filter(stats, area_type, area, year), limit, offset,
                     distinct_column="indicator")


def list_area_types(stats: DataFrame) -> DataFrame:
    return stats.select("area_type").distinct().orderBy("area_type")


# ----------------------------------------------------------------- metadata

def sorted_set(column, collation: str | None = None) -> Column:
    """Distinct values as a sorted array.  ``collect_set`` is a partial
    aggregate, so each task ships only its distinct values; the array size is
    bounded by the dimension's cardinality, not by the row count."""
    found = F.collect_set(F.col(column) if isinstance(column, str) else column)
    if collation is None:
        return F.sort_array(found)
    # values are distinct as written; the collation decides their order only
    ordered = F.sort_array(F.transform(found, lambda x: F.collate(x, collation)))
    return F.transform(ordered, lambda x: F.collate(x, "UTF8_BINARY"))


def year_meta(stats: DataFrame, year: int, collation: str | None = None) -> DataFrame:
    """Per area type: indicators, categories and areas present in one year.
    An unknown year gives an empty frame (see ``require_rows``)."""
    return (stats.filter(F.col("year") == F.lit(int(year)))
            .groupBy("area_type")
            .agg(sorted_set("indicator", collation).alias("indicators"),
                 sorted_set("category", collation).alias("categories"),
                 sorted_set("area_name", collation).alias("areas")))


def indicator_meta(stats: DataFrame, indicator: str, collation: str | None = None) -> DataFrame:
    """Per area type: years (numeric order), categories and areas of one indicator."""
    return (stats.filter(F.col("indicator") == F.lit(indicator))
            .groupBy("area_type")
            .agg(sorted_set("year").alias("years"),
                 sorted_set("category", collation).alias("categories"),
                 sorted_set("area_name", collation).alias("areas")))


def _meta_long(df: DataFrame, fields: dict) -> DataFrame:
    """Distinct (area_type, field, value) rows: the metadata sets in tidy form.
    Nothing is gathered into one row, so an area type with millions of areas
    stays distributed; the array form is for bounded dimensions."""
    parts = [df.select("area_type", F.lit(name).alias("field"), col.cast("string").alias("value"))
             for name, col in fields.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def year_meta_long(stats: DataFrame, year: int) -> DataFrame:
    rows = stats.filter(F.col("year") == F.lit(int(year)))
    return _meta_long(rows, {"indicator": F.col("indicator"), "category": F.col("category"),
                             "area": F.col("area_name")})


def indicator_meta_long(stats: DataFrame, indicator: str) -> DataFrame:
    rows = stats.filter(F.col("indicator") == F.lit(indicator))
    return _meta_long(rows, {"year": F.col("year"), "category": F.col("category"),
                             "area": F.col("area_name")})


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise not-found when a metadata frame is empty (one bounded probe)."""
    if not df.take(1):
        raise StatisticsNotFoundError(message)
    return df


def capabilities(stats: DataFrame) -> DataFrame:
    """Area types, indicators and years in one scan plus the fixed limits."""
    return stats.agg(
        sorted_set("area_type").alias("area_types"),
        sorted_set("indicator").alias("indicators"),
        sorted_set("year").alias("years"),
    ).select(
        "*",
        F.lit(BULK_ITEMS_MAX).alias("bulk_max_items"),
        F.lit(PAGINATION_LIMIT_MIN).alias("page_min"),
        F.lit(PAGINATION_LIMIT_MAX).alias("page_max"),
        F.lit(PAGINATION_LIMIT_DEFAULT).alias("page_default"),
        F.lit(RANKING_LIMIT_MIN).alias("ranking_min"),
        F.lit(RANKING_LIMIT_MAX).alias("ranking_max"),
        F.lit(RANKING_LIMIT_DEFAULT).alias("ranking_default"),
    )


def freshness(stats: DataFrame, row_count: Column | None = None) -> DataFrame:
    """Row count (an aggregate of another kind if given, such as the sum of a scope table's rows), last load time, distinct data versions and their sha256
    fingerprint over ``{"rowCount":…,"lastUpdatedAt":…,"versions":[…]}``.

    Versions are in ascending order with NULL last, reported as ''.
    """
    agg = stats.agg(
        (F.count(F.lit(1)) if row_count is None else row_count).alias("row_count"),
        F.max("loaded_at").alias("max_loaded_at"),
        F.sort_array(F.collect_set("data_version")).alias("known_versions"),
        F.count_if(F.col("data_version").isNull()).alias("null_versions"),
    )
    versions = F.when(F.col("null_versions") > 0,
                      F.concat(F.col("known_versions"), F.array(F.lit("")))
                      ).otherwise(F.col("known_versions"))
    out = agg.select(
        "row_count",
        iso_utc("max_loaded_at").alias("last_updated_at"),
        versions.alias("versions"),
    )
    payload = F.to_json(
        F.struct(F.col("row_count").alias("rowCount"),
                 F.col("last_updated_at").alias("lastUpdatedAt"),
                 F.col("versions").alias("versions")),
        {"ignoreNullFields": "false"})
    return out.withColumn("fingerprint", payload).withColumn(
        "data_version", F.sha2(F.col("fingerprint"), 256))
