"""Many time-series / ranking requests answered by one join.

The reference answers a bulk call by looping over its items.  Here the
requests are a DataFrame (``request_id, pos, kind, indicator, area_type,
areas, categories, year_from, year_to, year, limit, offset, order``) joined
with the fact table, broadcast or not as its measured size allows.

A page is found in two levels.  The matches of a request are spread over
``SALTS`` parts, so that a request which matches a third of the table is not
one task; each part ranks its rows and keeps the request's own cut, ``offset +
limit`` rows; the second level ranks what is left.  Rankings cut each part at a
constant first, which Spark plans as a partial ``WindowGroupLimit`` before the
exchange.  Time series also report totals: the parts count their rows in the
same pass, so the facts are read once; or the totals are given (a store knows
them from its summaries): then the parts are cut before the exchange as well,
and only requests with many rows have several.
Requests without any row still appear (total 0).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.functions.columns import has_empty_token, longest_token, split_list
from statlake.operators.query import StatisticsValidationError
from statlake.schema import (
    BULK_ITEMS_MAX,
    PAGINATION_LIMIT_MAX,
    PAGINATION_LIMIT_MIN,
    RANKING_LIMIT_MAX,
    RANKING_LIMIT_MIN,
)

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType(), False),
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("indicator", T.StringType(), True),
    T.StructField("area_type", T.StringType(), True),
    T.StructField("areas", T.ArrayType(T.StringType()), True),
    T.StructField("categories", T.ArrayType(T.StringType()), True),
    T.StructField("year_from", T.IntegerType(), True),
    T.StructField("year_to", T.IntegerType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("limit", T.IntegerType(), True),
    T.StructField("offset", T.IntegerType(), True),
    T.StructField("order", T.StringType(), True),
])


def _list_ok(list_col: str, value_col: str):
    lst = F.col(list_col)
    return lst.isNull() | (F.size(lst) == 0) | F.array_contains(lst, F.col(value_col))


#: Parts that the matches of one request are spread over, and rows from which a
#: request is split where its total is known.
SALTS = 32
PART_ROWS = 1_000_000


def _page_cut(requests: DataFrame, expr) -> int:
    row = requests.agg(F.max(expr).alias("k")).first()
    return int(row["k"] or 0)


def _salted(matched: DataFrame) -> DataFrame:
    return matched.withColumn("salt", F.pmod(F.xxhash64("area_name", "year", "category"), F.lit(SALTS)).cast("int"))


def timeseries_requests(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("kind") == "timeseries").select(
        "request_id", "pos", "indicator", "area_type", "areas", "categories", "year_from",
        "year_to", F.coalesce("limit", F.lit(50)).alias("limit"),
        F.coalesce("offset", F.lit(0)).alias("offset"))


def timeseries_totals(dimensions: DataFrame, requests: DataFrame) -> DataFrame:
    """request_id, total: from a table of years per scope and area (``years``),
    in which a fact is a year."""
    req = timeseries_requests(requests)
    years = F.filter("years", lambda y: (F.col("year_from").isNull() | (y >= F.col("year_from")))
                     & (F.col("year_to").isNull() | (y <= F.col("year_to"))))
    return (dimensions.select("indicator", "area_type", "category", "area_name", "years")
            .join(req, ["indicator", "area_type"])
            .where(_list_ok("areas", "area_name") & _list_ok("categories", "category"))
            .groupBy("request_id").agg(F.sum(F.size(years)).cast("long").alias("total")))


def bulk_timeseries(stats: DataFrame, requests: DataFrame, totals: dict | None = None) -> DataFrame:
    """``totals`` (request id -> rows), known for the few requests of a call."""
    req = timeseries_requests(requests)
    order, cut = ["area_name", "year", "category"], F.col("offset") + F.col("limit")
    parts = F.lit(SALTS)
    if totals is not None:
        known = F.create_map(*[F.lit(x).cast("long") for pair in (totals or {-1: 0}).items() for x in pair])
        total = F.coalesce(F.try_element_at(known, F.col("request_id")), F.lit(0))
        # parts only where a request is large; a page behind the end matches nothing
        parts = F.least(F.lit(SALTS), F.floor(total / F.lit(PART_ROWS)) + 1)
    asked = req if totals is None else req.where(total > F.col("offset"))
    matched = (stats.select("indicator", "area_type", "area_name", "year", "value", "unit",
                            "category")
               .join(asked, ["indicator", "area_type"])
               .where(_list_ok("areas", "area_name") & _list_ok("categories", "category")
                      & (F.col("year_from").isNull() | (F.col("year") >= F.col("year_from")))
                      & (F.col("year_to").isNull() | (F.col("year") <= F.col("year_to"))))
               .select("request_id", "limit", "offset", "area_name", "year", "value", "unit", "category",
                       F.pmod(F.xxhash64(*order), parts).cast("int").alias("salt")))
    part, whole = Window.partitionBy("request_id", "salt"), Window.partitionBy("request_id")
    ranked = matched.withColumn("part_rn", F.row_number().over(part.orderBy(*order)))
    on_page = (F.col("rn") > F.col("offset")) & (F.col("rn") <= cut)
    if totals is not None:
        # the constant cut right on row_number() lets Spark insert WindowGroupLimit
        deepest = max((r["offset"] + r["limit"] for r in req.select("offset", "limit").collect()), default=0)
        kept = ranked.where(F.col("part_rn") <= F.lit(deepest)).where(F.col("part_rn") <= cut)
        page = kept.withColumn("rn", F.row_number().over(whole.orderBy(*order))).where(on_page)
        rows = page.select("request_id", F.col("area_name").alias("area"), "year", "value", "unit", "category",
                           F.col("rn").cast("long").alias("rn"))
        return (req.select("request_id", "pos", "limit", "offset").join(rows, "request_id", "left")
                .select("request_id", "pos", "area", "year", "value", "unit", "category", "rn",
                        total.alias("total"), "limit", "offset"))
    # every part's first row brings the part's count; a request whose page is
    # behind its last row keeps its first one, as the bearer of the total
    kept = (ranked.withColumn("part_n", F.count(F.lit(1)).over(part))
            .where(F.col("part_rn") <= F.greatest(cut, F.lit(1))))
    page = (kept.withColumn("rn", F.row_number().over(whole.orderBy(*order)))
            .withColumn("total", F.sum(F.when(F.col("part_rn") == 1, F.col("part_n")).otherwise(0)).over(whole)))
    bearer = (F.col("rn") == 1) & ((F.col("total") <= F.col("offset")) | (F.col("limit") <= 0))
    rows = page.where(on_page | bearer).withColumn("on_page", on_page).select(
        "request_id", "total", *[F.when(F.col("on_page"), c).alias(name) for c, name in (
            (F.col("area_name"), "area"), *((F.col(x), x) for x in ("year", "value", "unit", "category")),
            (F.col("rn").cast("long"), "rn"))])
    return (req.select("request_id", "pos", "limit", "offset").join(rows, "request_id", "left")
            .select("request_id", "pos", "area", "year", "value", "unit", "category", "rn",
                    F.coalesce("total", F.lit(0)).alias("total"), "limit", "offset"))


def bulk_ranking(stats: DataFrame, requests: DataFrame, deepest: int | None = None) -> DataFrame:
    """``deepest``: the largest limit, where it is known."""
    req = requests.where(F.col("kind") == "ranking").select(
        "request_id", "pos", "indicator", "area_type", "year", "areas", "categories",
        F.coalesce("limit", F.lit(50)).alias("limit"),
        F.coalesce("order", F.lit("desc")).alias("order"))
    matched = (stats.select("indicator", "area_type", "area_name", "year", "value", "unit",
                            "category")
               .join(req, ["indicator", "area_type", "year"])
               .where(_list_ok("areas", "area_name") & _list_ok("categories", "category")))
    signed = F.when(F.col("order") == "asc", F.col("value")).otherwise(-F.col("value"))
    order = [signed, F.col("area_name"), F.col("category")]
    deepest = _page_cut(req, F.col("limit")) if deepest is None else deepest
    # the constant cut lets Spark insert WindowGroupLimit; the request's own comes behind it
    kept = (_salted(matched)
            .withColumn("part_rn", F.row_number().over(Window.partitionBy("request_id", "salt").orderBy(*order)))
            .where(F.col("part_rn") <= F.lit(deepest)).where(F.col("part_rn") <= F.col("limit")))
    page = (kept.withColumn("rn", F.row_number().over(Window.partitionBy("request_id").orderBy(*order)))
            .where(F.col("rn") <= F.col("limit"))
            .select("request_id", F.col("area_name").alias("area"), "value", "unit", "category",
                    F.col("rn").cast("long").alias("rn")))
    return (req.select("request_id", "pos", "year", "order")
            .join(page, "request_id", "left")
            .select("request_id", "pos", "year", "order", "area", "value", "unit", "category",
                    "rn"))


def bulk_capabilities(stats: DataFrame, requests: DataFrame) -> DataFrame:
    """Capability items: the one-row capabilities frame per requesting item."""
    from statlake.operators.query import capabilities
    req = requests.where(F.col("kind") == "capabilities")
    cap = capabilities(stats)
    # each field is a scalar subquery: computed once, no join at all
    return req.select("request_id", "pos",
                      *[cap.select(c).scalar().alias(c) for c in cap.columns])


# ------------------------------------------------------------- validation

def domain_frames(stats: DataFrame):
    """Known indicators, area types and categories per (indicator, area type).
    Their sizes are bounded by the dimension cardinalities, not by rows."""
    indicators = stats.select("indicator").distinct()
    area_types = stats.select("area_type").distinct()
    categories = stats.select("indicator", "area_type", "category").distinct()
    return indicators, area_types, categories


def invalid_requests(stats: DataFrame, requests: DataFrame) -> DataFrame:
    """Per invalid request its first failing check, in the service's order:
    range, indicator, area type, first unknown category (by list position).
    Columns: request_id, pos, field, value, allowed (sorted array)."""
    indicators, area_types, categories = domain_frames(stats)
    req = requests.where(F.col("kind").isin("timeseries", "ranking"))
    # the allowed lists are scalar subqueries (one row each), not joins
    all_ind = indicators.agg(F.sort_array(F.collect_list("indicator"))).scalar()
    all_typ = area_types.agg(F.sort_array(F.collect_list("area_type"))).scalar()

    def check(df, ordinal, field, value, allowed):
        return df.select("request_id", "pos", F.lit(ordinal).alias("ordinal"),
                         F.lit(field).alias("field"), value.cast("string").alias("value"),
                         allowed.alias("allowed"))

    c_range = check(req.where(F.col("year_from") > F.col("year_to")), 0, "range",
                    F.concat_ws(">", F.col("year_from").cast("string"),
                                F.col("year_to").cast("string")),
                    F.lit(None).cast("array<string>"))
    # domain frames are small but unbounded in principle: no hint, AQE turns
    # the joins into broadcasts from their measured size
    bad_ind = req.join(indicators, "indicator", "left_anti")
    c_ind = check(bad_ind, 1, "indicator", F.col("indicator"), all_ind)
    bad_typ = req.join(area_types, "area_type", "left_anti")
    c_typ = check(bad_typ, 2, "areaType", F.col("area_type"), all_typ)
    wanted = req.select("request_id", "pos", "indicator", "area_type",
                        F.posexplode("categories").alias("cpos", "category"))
    unknown = (wanted.join(categories, ["indicator", "area_type", "category"], "left_anti")
               .groupBy("request_id", "pos", "indicator", "area_type")
               .agg(F.min_by("category", "cpos").alias("category")))
    allowed_cat = categories.groupBy("indicator", "area_type").agg(
        F.sort_array(F.collect_list("category")).alias("allowed"))
    bad_cat = unknown.join(allowed_cat, ["indicator", "area_type"], "left")
    c_cat = check(bad_cat, 3, "category", F.col("category"),
                  F.coalesce("allowed", F.array().cast("array<string>")))
    allc = c_range.unionByName(c_ind).unionByName(c_typ).unionByName(c_cat)
    return (allc.groupBy("request_id", "pos")
            .agg(F.min_by(F.struct("field", "value", "allowed"), "ordinal").alias("e"))
            .select("request_id", "pos", "e.field", "e.value", "e.allowed"))


def first_invalid(stats: DataFrame, requests: DataFrame) -> DataFrame:
    """Fail-fast: the invalid request with the lowest position (0 or 1 row)."""
    return invalid_requests(stats, requests).orderBy("pos").limit(1)


def _invalid_error(b) -> StatisticsValidationError:
    return StatisticsValidationError(
        f"Unknown {b['field']}: {b['value']}" if b["field"] != "range"
        else "from must be <= to",
        {"kind": "domain_validation", "field": b["field"], "value": b["value"],
         "allowed": b["allowed"], "request_id": b["request_id"], "pos": b["pos"]})


def assert_valid(stats: DataFrame, requests: DataFrame) -> None:
    bad = first_invalid(stats, requests).take(1)
    if bad:
        raise _invalid_error(bad[0])


class KnownNames:
    """The names of a store, fetched once: the same checks as
    ``invalid_requests`` for the few items of a call, without a job."""

    def __init__(self, scopes: list):
        self.categories: dict[tuple, set] = {}
        self.rows: dict[tuple, int] = {}
        for r in scopes:
            pair = (r["indicator"], r["area_type"])
            self.categories.setdefault(pair, set()).add(r["category"])
            self.rows[pair] = self.rows.get(pair, 0) + (r["rows"] or 0)
        self.indicators = sorted({i for i, _ in self.categories})
        self.area_types = sorted({t for _, t in self.categories})

    def invalid(self, item) -> dict | None:
        """The first failing check of an item: range, indicator, area type, category."""
        low, high, pair = item["year_from"], item["year_to"], (item["indicator"], item["area_type"])

        def error(field, value, allowed):
            return {"field": field, "value": value, "allowed": allowed, "request_id": item["request_id"], "pos": item["pos"]}

        if low is not None and high is not None and low > high:
            return error("range", f"{low}>{high}", None)
        if pair[0] not in self.indicators:
            return error("indicator", pair[0], self.indicators)
        if pair[1] not in self.area_types:
            return error("areaType", pair[1], self.area_types)
        known = self.categories.get(pair, set())
        unknown = [c for c in item["categories"] or [] if c not in known]
        return error("category", unknown[0], sorted(known)) if unknown else None

    def check(self, items: list) -> None:
        for item in sorted(items, key=lambda r: (r["pos"], r["request_id"])):
            bad = self.invalid(item) if item["kind"] in ("timeseries", "ranking") else None
            if bad:
                raise _invalid_error(bad)


def check_bounds(requests: DataFrame) -> list:
    """The limits of a bulk call: 1..25 items; per item a known kind, the limit
    of its kind, an offset from 0 on, an order of asc or desc.  The first
    violation by position is raised; else the items, which are that few."""
    items = requests.limit(BULK_ITEMS_MAX + 1).collect()
    n = len(items) if len(items) <= BULK_ITEMS_MAX else requests.count()
    if not 1 <= n <= BULK_ITEMS_MAX:
        raise StatisticsValidationError(f"a bulk call has 1..{BULK_ITEMS_MAX} items, not {n}",
                                        {"kind": "bounds", "field": "items", "value": n})
    most = {"timeseries": (PAGINATION_LIMIT_MIN, PAGINATION_LIMIT_MAX), "ranking": (RANKING_LIMIT_MIN, RANKING_LIMIT_MAX)}
    for item in sorted(items, key=lambda r: (r["pos"], r["request_id"])):
        low, high = most.get(item["kind"], (None, None))
        for field, bad in (("kind", item["kind"] not in (*most, "capabilities")),
                           ("limit", low is not None and item["limit"] is not None and not low <= item["limit"] <= high),
                           ("offset", item["offset"] is not None and item["offset"] < 0),
                           ("order", item["order"] is not None and item["order"] not in ("asc", "desc"))):
            if bad:
                value = str(item[field])
                raise StatisticsValidationError(
                    f"item {item['pos']}: {field} is out of bounds: {value}",
                    {"kind": "bounds", "field": field, "value": value, "request_id": item["request_id"],
                     "pos": item["pos"]})
    return items


def local_requests(spark: SparkSession, items: list) -> DataFrame:
    """The few items of a call as a local relation: its size is known when a
    plan is made, and reading it starts no job."""
    strings = pa.list_(pa.string())
    kinds = {"request_id": pa.int64(), "areas": strings, "categories": strings,
             **{c: pa.string() for c in ("kind", "indicator", "area_type", "order")}}
    schema = pa.schema([(c, kinds.get(c, pa.int32())) for c in REQUEST_SCHEMA.fieldNames()])
    rows = [{c: item[c] for c in schema.names} for item in items]
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema))


def of_items(stats: DataFrame, items: list) -> DataFrame:
    """Only the rows of the scopes and years that the items (of one call) ask
    for: predicates on literals, which prune partitions and row groups."""
    wanted = None
    for pair in sorted({(r["indicator"], r["area_type"]) for r in items if r["kind"] in ("timeseries", "ranking")}, key=str):
        mine = [r for r in items if (r["indicator"], r["area_type"]) == pair and r["kind"] in ("timeseries", "ranking")]
        test = (F.col("indicator") == F.lit(pair[0])) & (F.col("area_type") == F.lit(pair[1]))
        if all(r["categories"] for r in mine):
            test &= F.col("category").isin(sorted({c for r in mine for c in r["categories"]}))
        first = [r["year"] if r["kind"] == "ranking" else r["year_from"] for r in mine]
        last = [r["year"] if r["kind"] == "ranking" else r["year_to"] for r in mine]
        if None not in first:
            test &= F.col("year") >= min(first)
        if None not in last:
            test &= F.col("year") <= max(last)
        wanted = test if wanted is None else wanted | test
    return stats.where(F.lit(False) if wanted is None else wanted)


def normalize_lists(df: DataFrame, column: str, max_token: int) -> DataFrame:
    """Comma separated list -> trimmed, de-duplicated tokens (first seen
    order kept) plus the two request checks: empty token, token too long."""
    return df.select(
        "*",
        split_list(F.col(column)).alias(f"{column}_list"),
        has_empty_token(F.col(column)).alias(f"{column}_has_empty"),
        (longest_token(F.col(column)) > F.lit(max_token)).alias(f"{column}_too_long"))
