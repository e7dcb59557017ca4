"""The user-facing query surface with the service's validation rules.

Each call checks its arguments the way the reference service does (range,
then indicator, then area type, then the first unknown category) and then
returns the operator's DataFrame.  Domain checks are one small Spark job over
the fact table's distinct dimension values, not a collect of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.operators import bulk as B
from statlake.operators import deep_page
from statlake.operators import query as q
from statlake.schema import PAGINATION_LIMIT_MAX, RANKING_LIMIT_MAX, SCOPE
from statlake.session import scratch_path

#: Scopes whose names are fetched when a service is opened.  A store with more
#: answers and validates names by jobs over its scope table.
NAMES_MOST = 200_000
#: Scopes of a bulk call with fewer rows are dealt over all tasks before the join.
SPREAD_ROWS = 10_000_000


def _request(stats: DataFrame, indicator=None, area_type=None, categories=None,
             year_from=None, year_to=None, kind="timeseries") -> DataFrame:
    row = (1, 0, kind, indicator, area_type, None, list(categories) if categories else None,
           year_from, year_to, None, None, None, None)
    return stats.sparkSession.createDataFrame([row], B.REQUEST_SCHEMA)


def _validate(stats, **kw):
    B.assert_valid(stats, _request(stats, **kw))


def _check_area_type(stats: DataFrame, area_type: str) -> None:
    known = stats.where(F.col("area_type") == area_type).select("area_type").take(1)
    if not known:
        allowed = [r[0] for r in q.list_area_types(stats).collect()]
        raise q.StatisticsValidationError(
            f"Unknown areaType: {area_type}",
            {"kind": "domain_validation", "field": "areaType", "value": area_type,
             "allowed": allowed})


def get_timeseries(stats, indicator, area_type, areas, categories=None, year_from=None,
                   year_to=None, limit=50, offset=0):
    """(rows page, page meta, areas of the page) after validation."""
    _validate(stats, indicator=indicator, area_type=area_type, categories=categories,
              year_from=year_from, year_to=year_to)
    page = q.timeseries(stats, indicator, area_type, areas, categories, year_from, year_to,
                        limit, offset)
    meta = q.timeseries_meta(stats, indicator, area_type, areas, categories, year_from,
                             year_to, limit, offset)
    return page, meta, q.page_areas(page)


def get_ranking(stats, indicator, area_type, year, categories=None, areas=None, limit=50,
                order="desc"):
    _validate(stats, indicator=indicator, area_type=area_type, categories=categories,
              kind="ranking")
    return q.ranking(stats, indicator, area_type, year, categories, areas, limit, order)


def list_areas(stats, indicator, area_type, category=None, like=None):
    _validate(stats, indicator=indicator, area_type=area_type,
              categories=[category] if category is not None else None)
    return q.list_areas(stats, indicator, area_type, category, like)


def list_categories(stats, indicator, area_type):
    _validate(stats, indicator=indicator, area_type=area_type)
    return q.list_categories(stats, indicator, area_type)


def list_years(stats, indicator=None, area_type=None, category=None, area=None, limit=None,
               offset=0):
    """Only the area type is validated; an unknown indicator gives no rows."""
    if area_type is not None:
        _check_area_type(stats, area_type)
    return (q.list_years(stats, indicator, area_type, category, area, limit, offset),
            q.years_meta(stats, indicator, area_type, category, area, limit, offset))


def list_indicators(stats, area_type=None, area=None, year=None, limit=None, offset=0):
    if area_type is not None:
        _check_area_type(stats, area_type)
    return (q.list_indicators(stats, area_type, area, year, limit, offset),
            q.indicators_meta(stats, area_type, area, year, limit, offset))


def get_year_meta(stats, year, collation=None):
    # the probe is on the filter: the sets are built once, by the caller's action
    q.require_rows(stats.where(F.col("year") == F.lit(int(year))), f"Year not found: {year}")
    return q.year_meta(stats, year, collation)


def get_indicator_meta(stats, indicator, collation=None):
    q.require_rows(stats.where(F.col("indicator") == F.lit(indicator)), f"Indicator not found: {indicator}")
    return q.indicator_meta(stats, indicator, collation)


def execute_bulk(stats, requests: DataFrame) -> dict[str, DataFrame]:
    """All items answered together; the first invalid item (lowest
    position) fails the whole request, as in the reference: bounds first, then
    the domains."""
    items = B.check_bounds(requests)
    requests = B.local_requests(requests.sparkSession, items)
    B.assert_valid(stats, requests)
    asked = B.of_items(stats, items)
    return {
        "timeseries": B.bulk_timeseries(asked, requests),
        "ranking": B.bulk_ranking(asked, requests, RANKING_LIMIT_MAX),
        "capabilities": B.bulk_capabilities(stats, requests),
    }


class StoreService:
    """The query surface over a publish store at one moment.

    Names (indicators, area types, categories), their years, validation,
    capabilities and freshness come from the ledger's scope table, a row per
    scope.  What depends on areas but not on values (years of an area,
    metadata, totals, area lists) comes from the store's table of years per
    scope and area.  Facts are read for values only, and by the files that a
    page lies in where its offset is deep."""

    def __init__(self, store):
        self.store, spark = store, store.spark
        runs = scratch_path(spark, "runs")
        store.runs().write.parquet(runs)       # one state of the ledger for everything below
        runs = spark.read.parquet(runs)
        path = scratch_path(spark, "scope-table")
        store.scope_table(runs).write.parquet(path)   # read by every later check instead of the ledger
        self.scopes = spark.read.parquet(path)
        visible = store.visible(runs)
        self.facts = store.snapshot(visible)
        found = self.scopes.limit(NAMES_MOST + 1).collect()
        self.names = B.KnownNames(found) if len(found) <= NAMES_MOST else None
        # runs of an older layout have no summaries: then the facts stand in for them
        complete = (all(r["years"] is not None for r in found) if self.names
                    else not self.scopes.where("years IS NULL").take(1))
        self.areas = store.dimensions(visible) if complete else (
            self.facts.groupBy(*SCOPE, "area_name").agg(F.sort_array(F.collect_set("year")).alias("years")))
        self.scope_years = self.scopes.withColumn("year", F.explode("years")) if complete else self.facts
        self.directory = store.file_directory(visible) if complete else None
        self.name_index = store.name_index(visible)

    # -- checks
    def _validate(self, indicator=None, area_type=None, categories=None, year_from=None, year_to=None, kind="timeseries"):
        if self.names is None:
            return _validate(self.scopes, indicator=indicator, area_type=area_type, categories=categories,
                             year_from=year_from, year_to=year_to, kind=kind)
        self.names.check([{"request_id": 1, "pos": 0, "kind": kind, "indicator": indicator, "area_type": area_type,
                           "categories": list(categories) if categories else None, "year_from": year_from,
                           "year_to": year_to}])

    def _check_area_type(self, area_type):
        if area_type is not None and (self.names is None or area_type not in self.names.area_types):
            _check_area_type(self.scopes, area_type)

    def _keys(self, area=None) -> DataFrame:
        """Fact keys without facts: scope and year, with the area if one is named."""
        if area is None:
            return self.scope_years
        return self.areas.where(F.col("area_name") == F.lit(area)).withColumn("year", F.explode("years"))

    # -- lists
    def list_indicators(self, area_type=None, area=None, year=None, limit=None, offset=0):
        self._check_area_type(area_type)
        keys = self.scopes if area is None and year is None else self._keys(area)
        return (q.list_indicators(keys, area_type, area, year, limit, offset),
                q.indicators_meta(keys, area_type, area, year, limit, offset))

    def list_area_types(self):
        return q.list_area_types(self.scopes)

    def list_categories(self, indicator, area_type):
        self._validate(indicator=indicator, area_type=area_type)
        return q.list_categories(self.scopes, indicator, area_type)

    def list_areas(self, indicator, area_type, category=None, like=None):
        self._validate(indicator=indicator, area_type=area_type,
                       categories=[category] if category is not None else None)
        if self.name_index is not None and like and len(like.lower()) >= 3:
            return q.list_areas_indexed(self.name_index, indicator, area_type, category, like)
        return q.list_areas(self.areas, indicator, area_type, category, like)

    def list_years(self, indicator=None, area_type=None, category=None, area=None, limit=None, offset=0):
        """Only the area type is validated; an unknown indicator gives no rows."""
        self._check_area_type(area_type)
        keys = self._keys(area)
        return (q.list_years(keys, indicator, area_type, category, area, limit, offset),
                q.years_meta(keys, indicator, area_type, category, area, limit, offset))

    # -- metadata
    def _of_year(self, year) -> DataFrame:
        q.require_rows(self.scope_years.where(F.col("year") == F.lit(int(year))), f"Year not found: {year}")
        return self.areas.where(F.array_contains("years", F.lit(int(year)))).withColumn("year", F.lit(int(year)))

    def _of_indicator(self, indicator) -> DataFrame:
        q.require_rows(self.scopes.where(F.col("indicator") == F.lit(indicator)), f"Indicator not found: {indicator}")
        return self.areas.where(F.col("indicator") == F.lit(indicator)).withColumn("year", F.explode("years"))

    def get_year_meta(self, year, collation=None):
        return q.year_meta(self._of_year(year), year, collation)

    def get_year_meta_long(self, year):
        """The same sets as rows, for area types with very many areas."""
        return q.year_meta_long(self._of_year(year), year)

    def get_indicator_meta(self, indicator, collation=None):
        return q.indicator_meta(self._of_indicator(indicator), indicator, collation)

    def get_indicator_meta_long(self, indicator):
        return q.indicator_meta_long(self._of_indicator(indicator), indicator)

    def capabilities(self) -> DataFrame:
        return q.capabilities(self.scope_years)

    # -- values
    def _timeseries_meta(self, indicator, area_type, areas, categories, year_from, year_to, limit, offset):
        """The total of a filter is a sum over the years of its areas."""
        q._check_page(limit, offset)
        rows = q.timeseries_filter(self.areas, indicator, area_type, areas, categories)
        years = F.filter("years", lambda y: (y >= F.lit(year_from if year_from is not None else -2 ** 31))
                         & (y <= F.lit(year_to if year_to is not None else 2 ** 31 - 1)))
        return q.page_meta(rows, limit, offset, total=F.coalesce(F.sum(F.size(years)), F.lit(0)).cast("long"))

    def get_timeseries(self, indicator, area_type, areas, categories=None, year_from=None, year_to=None,
                       limit=50, offset=0, last=None):
        self._validate(indicator=indicator, area_type=area_type, categories=categories,
                       year_from=year_from, year_to=year_to)
        if self.directory is not None and not areas and last is None and offset > PAGINATION_LIMIT_MAX:
            facts, skipped = deep_page.covering(self.store, self.directory, indicator, area_type, categories, year_from,
                                                year_to, limit, offset)
        else:
            facts, skipped = self.facts, 0
        page = q.timeseries(facts, indicator, area_type, areas, categories, year_from, year_to,
                            limit, offset - skipped, last)
        meta = self._timeseries_meta(indicator, area_type, areas, categories, year_from, year_to, limit, offset)
        return page, meta, q.page_areas(page)

    def get_ranking(self, indicator, area_type, year, categories=None, areas=None, limit=50, order="desc"):
        self._validate(indicator=indicator, area_type=area_type, categories=categories, kind="ranking")
        return q.ranking(self.facts, indicator, area_type, year, categories, areas, limit, order)

    def execute_bulk(self, requests: DataFrame) -> dict[str, DataFrame]:
        """As ``execute_bulk``; totals come from the areas' years, capabilities
        from the scope table, and the facts are pruned to the items' scopes."""
        items = B.check_bounds(requests)
        requests = B.local_requests(self.store.spark, items)
        if self.names is None:
            B.assert_valid(self.scopes, requests)
        else:
            self.names.check(items)
        asked = B.of_items(self.facts, items)
        # every item meets every row of its scope: a few files alone would make a few tasks of that
        pairs = {(r["indicator"], r["area_type"]) for r in items}
        if self.names is not None and sum(self.names.rows.get(p, SPREAD_ROWS) for p in pairs) < SPREAD_ROWS:
            asked = asked.repartition(self.store.spark.sparkContext.defaultParallelism, "area_name")
        # the areas have no year column: of their scopes only
        scopes = [r.asDict() | {"year": None, "year_from": None, "year_to": None} for r in items if r["kind"] == "timeseries"]
        totals = {r["request_id"]: r["total"] for r in B.timeseries_totals(B.of_items(self.areas, scopes), requests).collect()}
        return {"timeseries": B.bulk_timeseries(asked, requests, totals),
                "ranking": B.bulk_ranking(asked, requests, RANKING_LIMIT_MAX),
                "capabilities": B.bulk_capabilities(self.scope_years, requests)}

    def freshness(self) -> DataFrame:
        """From the scope table; needs runs that counted their scopes, else the facts."""
        if self.scopes.where("rows IS NULL").take(1):
            return q.freshness(self.facts)
        return q.freshness(self.scopes, F.coalesce(F.sum("rows"), F.lit(0)))
