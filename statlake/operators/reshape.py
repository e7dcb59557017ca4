"""Wide -> tidy reshapes.

Both formats are a single scan of the raw frame: the spec's features /
categories and the year columns become one ``inline(array(struct …))``
generator, so N categories cost one pass instead of N inserts.  Values are
parsed with the guarded number test, unparseable ones are dropped before the
keep-last pick, and the pick itself is a map-side ``max_by`` on the final
key (see ``dedupe.keep_last``).
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from statlake.functions.columns import is_number, parse_number, parse_year, year_in_range
from statlake.operators.dedupe import keep_last
from statlake.operators.observe import observed as observed_metrics
from statlake.plans.spec import DatasetSpec, UnpivotCategories, UnpivotYears
from statlake.schema import MAX_VALID_YEAR, MIN_VALID_YEAR, STAT_COLUMNS
from statlake.sources.csv import INGEST_ORDER, raw


class DatasetImportError(ValueError):
    """An import that must not be published."""


@dataclass(frozen=True)
class RunContext:
    """Lineage stamped on every staged row.  ``loaded_at`` is fixed on the
    driver so that task retries reproduce identical rows."""
    dataset_id: str
    data_version: str | None = None
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    loaded_at: dt.datetime = field(
        default_factory=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))


def _lineage(run: RunContext) -> list[Column]:
    return [F.lit(run.dataset_id).alias("source_dataset"),
            F.lit(run.run_id).alias("import_run_id"),
            # wall-clock text read in the session time zone (UTC by default),
            # independent of the Python process's zone
            F.to_timestamp(F.lit(run.loaded_at.strftime("%Y-%m-%d %H:%M:%S.%f")))
            .alias("loaded_at"),
            F.lit(run.data_version).cast("string").alias("data_version")]


def _year_error(spec: DatasetSpec, raw_value, parsed) -> DatasetImportError:
    return DatasetImportError(
        f"{spec.id} ({spec.format_type}): the year text {raw_value!r} gives {parsed}, which is no "
        f"year of {MIN_VALID_YEAR}..{MAX_VALID_YEAR}")


def _area(spec: DatasetSpec) -> Column:
    if spec.area_column:
        c = raw(spec.area_column)
        return spec.area_expression(c) if spec.area_expression else c
    return F.lit(spec.default_area_name)


def _order_column(df: DataFrame) -> Column:
    if INGEST_ORDER not in df.columns:
        raise DatasetImportError(
            f"rows have no order: read them with ingest order or see with_row_order ({INGEST_ORDER})")
    return F.col(INGEST_ORDER)


def with_row_order(df: DataFrame, *columns: str) -> DataFrame:
    """Give a frame that is no file its row order, by columns that decide it."""
    return df.withColumn(INGEST_ORDER, F.struct(*[raw(c).cast("string") for c in columns]))


def _require(have: list[str], wanted: list[tuple[str, tuple[str, ...]]]) -> dict[str, str]:
    """Which column plays each role: ``wanted`` has (role, names in order of
    preference).  All roles without a column are reported at once."""
    found = {role: next((n for n in names if n in have), None) for role, names in wanted}
    lost = [f"{role} ({' or '.join(names)})" for role, names in wanted if found[role] is None]
    if lost:
        raise DatasetImportError(f"no column for: {'; '.join(lost)}; the header has {', '.join(have)}")
    return found


# ------------------------------------------------------------ years as columns

def year_columns(columns: list[str], fmt: UnpivotYears) -> list[str]:
    pattern = re.compile(fmt.year_pattern)
    return [c for c in columns if pattern.search(c)]


def _parse_header_year(spec: DatasetSpec, name: str) -> int:
    fmt = spec.format
    if fmt.year_parser is None:
        try:
            return int(name.strip())
        except ValueError as e:
            raise DatasetImportError(f"{spec.id}: the column name {name!r} is no year") from e
    rx = {"first": r"\d{4}", "leading": r"^\d{4}"}[fmt.year_parser]
    m = re.search(rx, name)
    if not m:
        raise _year_error(spec, name, "NaN")
    year = int(m.group(0))
    if not (MIN_VALID_YEAR <= year <= MAX_VALID_YEAR):
        raise _year_error(spec, name, year)
    return year


def _parse_header_years(df: DataFrame, spec: DatasetSpec, names: list[str]) -> list[int]:
    """Years of the header names by the spec's own builder."""
    rows = df.sparkSession.createDataFrame(list(enumerate(names)), "pos int, name string")
    parsed = {r["pos"]: r["year"] for r in rows.select(
        "pos", parse_year("name", spec.format.year_parser).alias("year")).collect()}
    for pos, name in enumerate(names):
        if parsed[pos] is None or not MIN_VALID_YEAR <= parsed[pos] <= MAX_VALID_YEAR:
            raise _year_error(spec, name, "NaN" if parsed[pos] is None else parsed[pos])
    return [parsed[pos] for pos in range(len(names))]


def unpivot_years(df: DataFrame, spec: DatasetSpec, run: RunContext) -> DataFrame:
    """Years-as-columns -> tidy rows, all spec rows in one scan."""
    fmt = spec.format
    assert isinstance(fmt, UnpivotYears)
    cols = [c for c in df.columns if c != INGEST_ORDER]
    _require(cols, [("feature", (fmt.indicator_column,)),
                    *([("area", (spec.area_column,))] if spec.area_column else [])])
    ycols = year_columns(cols, fmt)
    if not ycols:
        raise DatasetImportError(f"{spec.id}: no column name matches {fmt.year_pattern}, so there are no years")
    # header names are metadata: a callable parser sees them in one tiny job
    years = (_parse_header_years(df, spec, ycols) if callable(fmt.year_parser)
             else [_parse_header_year(spec, c) for c in ycols])

    feature = raw(fmt.indicator_column)
    rows = list(fmt.rows)
    matched = df.where(feature.isin(sorted({r.filter_value for r in rows})))
    spec_idx = F.filter(F.array(*[F.when(feature == F.lit(r.filter_value), F.lit(i))
                                  for i, r in enumerate(rows)]), lambda x: x.isNotNull())
    cells = F.array(*[F.struct(F.lit(pos).alias("pos"), F.lit(y).alias("year"),
                               raw(c).cast("string").alias("text"))
                      for pos, (c, y) in enumerate(zip(ycols, years))])
    long = (matched
            .select(_area(spec).alias("area_name"), _order_column(df).alias("__ingest"),
                    F.explode(spec_idx).alias("__spec"), F.inline(cells))
            .where(F.col("text").isNotNull()))

    def per_row(attr):
        expr = None
        for i, r in enumerate(rows):
            v = attr(r)
            expr = F.when(F.col("__spec") == i, v) if expr is None else expr.when(
                F.col("__spec") == i, v)
        return expr

    text = per_row(lambda r: r.value(F.col("text")) if r.value else F.col("text"))
    staged = (long
              .select("*", parse_number(text).alias("value"),
                      per_row(lambda r: F.lit(r.indicator)).alias("indicator"),
                      per_row(lambda r: F.lit(r.unit)).alias("unit"),
                      per_row(lambda r: F.lit(r.category.slug)).alias("category"))
              .where(F.col("value").isNotNull()))
    # later header position wins per (area, year); ties between rows: later row
    picked = keep_last(
        staged.select("indicator", "area_name", "year", "category", "value", "unit",
                      F.struct("pos", "__ingest").alias("__order")),
        ["indicator", "area_name", "year", "category"], "__order")
    return picked.select(
        "indicator", F.lit(spec.area_type).alias("area_type"), "area_name",
        F.col("year").cast("int").alias("year"), "value", "unit", "category", *_lineage(run))


# ------------------------------------------------------- categories as columns

def _year_metrics(spec: DatasetSpec) -> list[Column]:
    fmt = spec.format
    yr = raw(fmt.year_column)
    metrics = [F.count_if(yr.isNotNull()).alias("years_present")]
    if fmt.year_parser is not None:
        parsed = parse_year(yr, fmt.year_parser)
        metrics.append(F.count_if(yr.isNotNull() & ~year_in_range(parsed)).alias("years_bad"))
    return metrics


def _raise_year_problems(df: DataFrame, spec: DatasetSpec, metrics: dict) -> None:
    fmt = spec.format
    if not metrics["years_present"]:
        raise DatasetImportError(f"{spec.id}: the year column {fmt.year_column} is empty in every row")
    if metrics.get("years_bad"):
        yr = raw(fmt.year_column)
        parsed = parse_year(yr, fmt.year_parser)
        sample = (df.where(yr.isNotNull() & ~year_in_range(parsed))
                  .select(yr.alias("raw"), parsed.alias("parsed")).distinct()
                  .orderBy("raw").limit(20).collect())
        first = sample[0]
        raise _year_error(spec, first["raw"],
                          "NaN" if first["parsed"] is None else first["parsed"])


def check_years(df: DataFrame, spec: DatasetSpec) -> None:
    """All raw year values (also of rows the feature filter drops) must parse
    into 1900..2100; none at all is an error.  One aggregate job; only on
    failure a bounded sample of offending texts is fetched."""
    metrics = df.agg(*_year_metrics(spec)).first().asDict()
    _raise_year_problems(df, spec, metrics)


def observe_years(df: DataFrame, spec: DatasetSpec):
    """The same check folded into the import's own write job: returns the
    raw frame with an observation attached and a callable that evaluates it
    after the action (so the input is scanned once, not twice)."""
    obs = Observation(f"years-{spec.id}-{uuid.uuid4().hex}")
    observed = df.observe(obs, *_year_metrics(spec))

    def verify() -> None:
        metrics = observed_metrics(obs)
        if metrics is None:
            check_years(df, spec)
        else:
            _raise_year_problems(df, spec, metrics)
    return observed, verify


def unpivot_categories(df: DataFrame, spec: DatasetSpec, run: RunContext,
                       validate_years: bool = True) -> DataFrame:
    """Categories-as-columns -> tidy rows in one scan (one generator entry per
    planned category), filtered, then keep-last per final key.
    ``validate_years=False`` leaves the year check to the caller (see
    ``observe_years``)."""
    fmt = spec.format
    assert isinstance(fmt, UnpivotCategories)
    cols = [c for c in df.columns if c != INGEST_ORDER]
    sources = [(f"category {c.category.slug}", (c.value_column,) if c.value_column else c.value_columns)
               for c in fmt.columns if c.value_column or (c.value is None and c.value_columns)]
    found = _require(cols, [
        ("year", (fmt.year_column,)),
        *([("area", (spec.area_column,))] if spec.area_column else []),
        *([("feature", (fmt.filter_column,))] if fmt.filter_column else []), *sources])
    if validate_years:
        check_years(df, spec)

    planned = spec.planned_categories()
    entries = []
    for (indicator, unit, slug), c in zip(planned, fmt.columns):
        expr = c.value() if c.value is not None else raw(found[f"category {c.category.slug}"])
        entries.append(F.struct(F.lit(indicator).alias("indicator"), F.lit(unit).alias("unit"),
                                F.lit(slug).alias("category"),
                                expr.cast("string").alias("text")))
    base = df
    if fmt.filter_column:
        base = base.where(raw(fmt.filter_column) == F.lit(fmt.filter_value))
    if spec.area_column:
        base = base.where(raw(spec.area_column).isNotNull())
    long = base.select(_area(spec).alias("area_name"),
                       parse_year(raw(fmt.year_column), fmt.year_parser).alias("year"),
                       _order_column(df).alias("__ingest"),
                       F.inline(F.array(*entries)))
    staged = long.where(is_number(F.col("text"))).withColumn("value", parse_number("text"))
    picked = keep_last(staged.select("indicator", "area_name", "year", "category", "value",
                                     "unit", "__ingest"),
                       ["indicator", "area_name", "year", "category"], "__ingest")
    return picked.select(
        "indicator", F.lit(spec.area_type).alias("area_type"), "area_name",
        F.col("year").cast("int").alias("year"), "value", "unit", "category", *_lineage(run))


def to_tidy(df: DataFrame, spec: DatasetSpec, run: RunContext, **kw) -> DataFrame:
    if isinstance(spec.format, UnpivotYears):
        out = unpivot_years(df, spec, run)
    else:
        out = unpivot_categories(df, spec, run, **kw)
    return out.select(*STAT_COLUMNS)


def to_tidy_deferred(df: DataFrame, spec: DatasetSpec, run: RunContext):
    """``to_tidy`` whose data checks run inside the later write job.
    Returns (staged frame, list of callables to run after that action)."""
    checks = []
    if isinstance(spec.format, UnpivotCategories):
        df, verify = observe_years(df, spec)
        checks.append(verify)
        out = unpivot_categories(df, spec, run, validate_years=False)
    else:
        out = unpivot_years(df, spec, run)
    return out.select(*STAT_COLUMNS), checks


def import_counts(staged: DataFrame) -> DataFrame:
    """Staged row count per (indicator, area type, category) scope."""
    return staged.groupBy("indicator", "area_type", "category").agg(
        F.count(F.lit(1)).alias("imported"))


__all__ = ["RunContext", "DatasetImportError", "year_columns", "unpivot_years",
           "unpivot_categories", "check_years", "observe_years", "to_tidy", "to_tidy_deferred",
           "import_counts", "with_row_order"]
