"""The tidy fact table: columns, keys and request limits."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must match the reference service.
MIN_VALID_YEAR = 1900
MAX_VALID_YEAR = 2100
RANKING_LIMIT_MIN = 1
RANKING_LIMIT_MAX = 100
RANKING_LIMIT_DEFAULT = 50
BULK_ITEMS_MAX = 25
PAGINATION_LIMIT_MIN = 1
PAGINATION_LIMIT_MAX = 500
PAGINATION_LIMIT_DEFAULT = 50
PAGINATION_OFFSET_DEFAULT = 0
QUERY_AREA_MAX = 200
QUERY_TEXT_MAX = 120
ERROR_MESSAGE_MAX = 2000
DEFAULT_CATEGORY = "total"

STAT_COLUMNS = [
    "indicator", "area_type", "area_name", "year", "value", "unit", "category",
    "source_dataset", "import_run_id", "loaded_at", "data_version",
]
KEY = ["indicator", "area_type", "area_name", "year", "category"]
SCOPE = ["indicator", "area_type", "category"]
REQUIRED = ["indicator", "area_type", "area_name", "year", "value", "unit", "category"]
LINEAGE = ["source_dataset", "import_run_id", "loaded_at", "data_version"]

STAT_SCHEMA = T.StructType([
    T.StructField("indicator", T.StringType(), False),
    T.StructField("area_type", T.StringType(), False),
    T.StructField("area_name", T.StringType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("value", T.DoubleType(), False),
    T.StructField("unit", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("source_dataset", T.StringType(), True),
    T.StructField("import_run_id", T.StringType(), True),
    T.StructField("loaded_at", T.TimestampType(), True),
    T.StructField("data_version", T.StringType(), True),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("dataset_id", T.StringType(), False),
    T.StructField("data_version", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("event_ts", T.TimestampType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("scopes", T.ArrayType(T.StructType([
        T.StructField("indicator", T.StringType(), False),
        T.StructField("area_type", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        # what the run wrote there; NULL where it was not counted
        T.StructField("rows", T.LongType(), True),
        T.StructField("loaded_at", T.TimestampType(), True),
        T.StructField("years", T.ArrayType(T.IntegerType()), True),
    ])), True),
])
