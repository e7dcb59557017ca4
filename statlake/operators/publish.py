"""Publishing staged rows: upsert, stale rows, scope replacement, run ledger.

Semantics: staged rows all lie inside the import's scopes (indicator, area
type, category).  Upsert + stale delete therefore equals *replace the
scopes*: ``target LEFT ANTI scopes  UNION  staged``.  A scope with no staged
row is emptied too.

Storage without a transactional table format: facts are appended as Parquet
partitioned by ``import_run_id/indicator/area_type/category``; nothing is
visible until one entry of the commit log maps every scope of the import to the
run id.  Readers keep, per scope, the latest published run.  A failed run
writes no entry, so old data stays.

Several writers may publish at once: entries are numbered, a number is created
by one writer only, and the loser of a race tries the next one
(``commit_log``).  A writer that depends on what it has read passes the number
it has read at (``commit(read_at=)``) and is refused if one of its scopes has
been published since.

Next to the facts, each run keeps what readers need instead of a scan: the
years of every area of a scope (``areas``), the rows and area range of every
file and year (``files``), and the input files it read (``manifest``).  They are
written before the entry, from the run's area and year columns alone.

What keeps published rows safe:

* rows outside the declared scopes are counted during the write and refused;
* files are only dropped for failed runs, and for replaced partitions whose
  replacement is older than a stated retention; never for open or unknown runs;
* a folder is empty only if the file system says that it does not exist;
  every other error of the store is raised;
* an entry's sequence number is above that of the entry before, so a writer
  whose clock is late still publishes last; compaction folds only days that
  have been closed for ``OPEN_DAYS``, and events for folded days are refused;
* a run that is published is never marked as failed, also when the call that
  published it raised.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.functions.columns import year_in_range
from statlake.operators.commit_log import CommitConflictError, CommitLog, Files
from statlake.operators.observe import observed
from statlake.operators.quality import non_finite
from statlake.operators.reshape import DatasetImportError, RunContext
from statlake.schema import (
    ERROR_MESSAGE_MAX,
    KEY,
    LEDGER_SCHEMA,
    MAX_VALID_YEAR,
    MIN_VALID_YEAR,
    REQUIRED,
    SCOPE,
    STAT_COLUMNS,
    STAT_SCHEMA,
)

# Events as stored: one folder per day, publishes in the numbered commit log.
_EVENT_SCHEMA = T.StructType(LEDGER_SCHEMA.fields + [T.StructField("event_day", T.StringType()),
                                                     T.StructField("number", T.LongType())])

# binaryFile listing of the fact folder with its partition columns.
_LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("indicator", T.StringType()),
    T.StructField("area_type", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("import_run_id", T.StringType()),
])

_AREAS_SCHEMA = "indicator string, area_type string, category string, area_name string, years array<int>, rows long, import_run_id string"
_FILES_SCHEMA = ("indicator string, area_type string, category string, year int, file string, first_area string, "
                 "last_area string, rows long, import_run_id string")
_NAMES_SCHEMA = "indicator string, area_type string, area_name string, categories array<string>, trigram string, import_run_id string"
_MANIFEST_SCHEMA = "path string, size long, mtime_ms long, import_run_id string"

# Ledger days younger than this many whole days are never folded.
OPEN_DAYS = 2
# Replaced partitions are kept this long for readers of older snapshots.
RETENTION = dt.timedelta(days=7)
# Areas of scopes whose names one task indexes, written facts whose years by area one task groups.
AREAS_PER_TASK = 100_000
FACTS_PER_TASK = 500_000


def scopes_frame(spark: SparkSession, scopes) -> DataFrame:
    """The (indicator, area_type, category) scopes of a spec as a frame of known size:
    joins send it to all tasks, where facts dealt by scope would be few tasks."""
    schema = pa.schema([(c, pa.string()) for c in ("indicator", "area_type", "category")])
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(schema.names, s)) for s in scopes], schema))


def in_scopes(df: DataFrame, scopes: DataFrame) -> DataFrame:
    return df.join(scopes, SCOPE, "left_semi")


def stale_rows(target: DataFrame, staged: DataFrame, scopes: DataFrame) -> DataFrame:
    """Target rows inside the scopes that the staged set no longer has."""
    return in_scopes(target, scopes).join(staged.select(*KEY), KEY, "left_anti")


def stale_counts(target: DataFrame, staged: DataFrame, scopes: DataFrame) -> DataFrame:
    return stale_rows(target, staged, scopes).groupBy(*SCOPE).agg(
        F.count(F.lit(1)).alias("stale"))


def upsert(target: DataFrame, staged: DataFrame) -> DataFrame:
    """INSERT OR REPLACE by key: staged rows replace all 11 columns."""
    return (target.join(staged.select(*KEY), KEY, "left_anti").select(*STAT_COLUMNS)
            .unionByName(staged.select(*STAT_COLUMNS)))


def replace_scopes(target: DataFrame, staged: DataFrame, scopes: DataFrame) -> DataFrame:
    """Upsert + stale delete in one expression (emptied scopes disappear)."""
    return (target.join(scopes, SCOPE, "left_anti").select(*STAT_COLUMNS)
            .unionByName(staged.select(*STAT_COLUMNS)))


# ------------------------------------------------------------------ ledger

def run_state(events: DataFrame) -> DataFrame:
    """Current state per run: the latest event (by sequence) wins."""
    cols = [c for c in events.columns if c != "run_id"]
    return (events.groupBy("run_id")
            .agg(F.max_by(F.struct(*cols), F.col("seq")).alias("s"))
            .select("run_id", *[F.col("s").getField(c).alias(c) for c in cols]))


def run_summary(states: DataFrame) -> DataFrame:
    return states.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("status") == "published").alias("published_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"))


def trigrams(text) -> Column:
    """The distinct runs of three characters of a text; none if it is shorter."""
    at = F.sequence(F.lit(1), F.char_length(text) - 2)
    found = F.transform(at, lambda k: F.substring(text, k, F.lit(3)))
    return F.when(F.char_length(text) >= 3, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def tasks_for(df: DataFrame, n: int, per_task: int) -> list[int]:
    """The number of tasks for ``n`` rows, as a leading argument of a repartition: so
    many that a task's rows stay the same for any input, or none up to the session's
    cores, where AQE sizes them."""
    tasks = -(-n // per_task)
    return [tasks] if tasks > df.sparkSession.sparkContext.defaultParallelism else []


def by_area(written: DataFrame) -> DataFrame:
    """Per scope and area of checked facts: its years in order, and its rows.  Years
    are collected as bits of a few numbers, so that areas are grouped by hashing;
    a set per area would sort the rows of a task."""
    starts = range(MIN_VALID_YEAR, MAX_VALID_YEAR + 1, 64)
    bits = [F.bit_or(F.expr(f"if(year BETWEEN {s} AND {s + 63}, shiftleft(1L, year - {s}), 0L)")).alias(f"from_{s}")
            for s in starts]
    found = written.groupBy(*SCOPE, "area_name").agg(
        F.min("year").alias("first"), F.max("year").alias("last"), *bits, F.count(F.lit(1)).alias("rows"))

    def has(year):
        of = F.coalesce(*[F.when(year < s + 64, F.col(f"from_{s}")) for s in starts])
        return F.getbit(of, F.pmod(year - starts[0], F.lit(64))) == 1

    return found.select(*SCOPE, "area_name", F.filter(F.sequence("first", "last"), has).alias("years"), "rows")


def by_file(written: DataFrame) -> DataFrame:
    """Per scope, year and file of written facts: first and last area, rows.  The
    year is taken from a set of one, as a collecting aggregate is grouped by
    hashing; the least and greatest text alone would sort every row of a task."""
    return (written.groupBy(*SCOPE, F.col("year").alias("of_year"), F.col("_metadata.file_path").alias("file"))
            .agg(F.get(F.collect_set("year"), F.lit(0)).alias("year"), F.min("area_name").alias("first_area"),
                 F.max("area_name").alias("last_area"), F.count(F.lit(1)).alias("rows"))
            .select(*SCOPE, "year", "file", "first_area", "last_area", "rows"))


class FactStore:
    """Append-only fact partitions plus a ledger of run events under ``root``
    (a folder every executor can reach, e.g. below spark.checkpoint.dir)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.facts_path = f"{self.root}/facts"
        self.ledger_path = f"{self.root}/ledger"
        self.state_path = f"{self.root}/ledger_state"
        self.areas_path = f"{self.root}/areas"
        self.files_path = f"{self.root}/files"
        self.manifest_path = f"{self.root}/manifest"
        self.names_path = f"{self.root}/names/by_area"   # beside it, older layouts may have a row per scope
        self.files = Files(spark)
        self.log = CommitLog(self.files, f"{self.root}/log")

    # -- files
    def _hadoop(self, path: str):
        return self.files.hadoop(path)

    def _exists(self, path: str) -> bool:
        """Whether ``path`` exists; any error of the storage is raised."""
        fs, p = self._hadoop(path)
        return fs.exists(p)

    def _run_folder(self, base: str, run_id: str) -> str:
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return f"{base}/import_run_id={escape(run_id)}"

    def _of_runs(self, base: str, schema, run_ids: list[str]) -> DataFrame:
        """The rows of some runs; folders of other runs are not even listed."""
        folders = [self._run_folder(base, r) for r in run_ids]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*folders)

    # -- ledger
    def version(self) -> int:
        """The number of the last publish."""
        return self.log.last()

    def _event(self, run: RunContext, status: str, row_count=None, error=None, scopes=None, read_at=None):
        """Record an event of a run: a file of its own, or, for a publish, the
        next entry of the commit log."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        day = now.strftime("%Y-%m-%d")
        folded = self._folded_day()
        if folded is not None and day <= folded:
            raise DatasetImportError(
                f"the clock of this writer ({now:%Y-%m-%d}) is behind the ledger, which is folded "
                f"up to {folded}")
        event = {"run_id": run.run_id, "dataset_id": run.dataset_id, "data_version": run.data_version, "status": status,
                 "row_count": row_count, "error_message": None if error is None else str(error)[:ERROR_MESSAGE_MAX],
                 "event_ts": now.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), "event_day": day}
        if status != "published":
            event |= {"seq": time.time_ns(), "scopes": None}
            self.files.put(f"{self.ledger_path}/event_day={day}/{uuid.uuid4().hex}.json",
                           (json.dumps(event) + "\n").encode())
            return None
        event["scopes"] = [dict(zip(("indicator", "area_type", "category", "rows", "loaded_at", "years"), x))
                           | {"loaded_at": x[4].strftime("%Y-%m-%dT%H:%M:%S.%f")} for x in scopes]
        mine = {tuple(x[:3]) for x in scopes}
        seen = read_at

        def prepare(number: int, before: dict | None) -> dict:
            nonlocal seen
            while seen is not None and seen < number - 1:   # what others have published since
                seen += 1
                theirs = {(s["indicator"], s["area_type"], s["category"]) for s in self.log.read(seen)["scopes"]}
                if theirs & mine:
                    raise CommitConflictError(f"publish {seen} replaced {sorted(theirs & mine)[:3]} after this run had read "
                                              f"publish {read_at}")
            # read time: the entry before has a smaller one
            return event | {"number": number, "seq": max(time.time_ns(), before["seq"] + 1 if before else 0)}

        return self.log.append(prepare)

    def _json(self, folders: list[str], base: str) -> DataFrame:
        """Events of some folders; a damaged one raises."""
        if not folders:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return (self.spark.read.schema(_EVENT_SCHEMA).option("mode", "FAILFAST").option("basePath", base).json(folders))

    def events(self, after_day: str | None = None, after_number: int = 0) -> DataFrame:
        """All events, or those of days after ``after_day`` and publishes after
        ``after_number`` (earlier folders are not listed)."""
        days = [f"{self.ledger_path}/{d}" for d in self.files.names(self.ledger_path)
                if after_day is None or d.partition("=")[2] > after_day] if self._exists(self.ledger_path) else []
        own = self._json(days, self.ledger_path).select(*LEDGER_SCHEMA.fieldNames())
        entries = self.log.paths_after(after_number)
        if not entries:
            return own
        published = self._json(entries, self.log.root).where(F.col("number") > after_number)
        return own.unionByName(published.select(*LEDGER_SCHEMA.fieldNames()))

    def _folded_day(self) -> str | None:
        """The last day that a complete compaction has folded, or None."""
        if not self._exists(self.state_path):
            return None
        fs, p = self._hadoop(self.state_path)
        days = [f.getPath().getName().partition("=")[2] for f in fs.listStatus(p)
                if self._exists(f"{self.state_path}/{f.getPath().getName()}/_SUCCESS")]
        return max(days, default=None)

    def _folded_number(self, day: str) -> int:
        """The last publish that the compaction up to ``day`` has folded."""
        fs, p = self._hadoop(f"{self.state_path}/upto_day={day}")
        marks = [f.getPath().getName() for f in fs.listStatus(p)]
        return max([int(m.rpartition("_")[2]) for m in marks if m.startswith("_publishes_")], default=0)

    def runs(self) -> DataFrame:
        """Current state per run: the newest compacted state plus all events of
        the days and publishes after it (older folders are not read)."""
        day = self._folded_day()
        if day is None:
            return run_state(self.events())
        state = self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.state_path}/upto_day={day}")
        return run_state(state.unionByName(self.events(day, self._folded_number(day))))

    def compact_ledger(self, today: dt.date | None = None) -> str | None:
        """Fold the events of all days closed for ``OPEN_DAYS`` into one state;
        later reads start from it.  Returns the last folded day."""
        today = today or dt.datetime.now(dt.timezone.utc).date()
        upto = (today - dt.timedelta(days=OPEN_DAYS + 1)).strftime("%Y-%m-%d")
        before = self._folded_day()
        if not self._exists(self.ledger_path) or (before is not None and before >= upto):
            return before
        folders = [f"{self.ledger_path}/{d}" for d in self.files.names(self.ledger_path)
                   if (before or "") < d.partition("=")[2] <= upto]
        folded = self._folded_number(before) if before is not None else 0
        # publishes up to the first one of an open day
        entries = self._json(self.log.paths_after(folded), self.log.root)
        upper = folded
        if "number" in entries.columns:
            entries = entries.where(F.col("number") > folded)
            least = entries.agg(F.min(F.when(F.col("event_day") > upto, F.col("number"))).alias("open"),
                                F.max("number").alias("last")).first()
            upper = least["open"] - 1 if least["open"] is not None else least["last"] or folded
            entries = entries.where(F.col("number") <= upper)
        names = LEDGER_SCHEMA.fieldNames()
        state = self._json(folders, self.ledger_path).select(*names).unionByName(entries.select(*names))
        if before is not None:
            state = state.unionByName(self.spark.read.schema(LEDGER_SCHEMA).parquet(
                f"{self.state_path}/upto_day={before}"))
        target = f"{self.state_path}/upto_day={upto}"
        run_state(state).select(*names).write.mode("overwrite").parquet(target)
        # without this mark all publishes are read again, which changes nothing
        self.files.put(f"{target}/_publishes_{upper}", b"")
        return upto

    def current_scopes(self, runs: DataFrame | None = None) -> DataFrame:
        """Per scope, the run id of its latest published import.  ``runs``: a
        kept result of ``runs()``, so that several reads see the same state."""
        pub = ((self.runs() if runs is None else runs).where(F.col("status") == "published")
               .select("run_id", "seq", F.explode("scopes").alias("s")))
        return (pub.groupBy(F.col("s.indicator").alias("indicator"),
                            F.col("s.area_type").alias("area_type"),
                            F.col("s.category").alias("category"))
                .agg(F.max_by("run_id", "seq").alias("import_run_id")))

    def scope_table(self, runs: DataFrame | None = None) -> DataFrame:
        """What is published, from the ledger alone: per scope its run, rows, load
        time, data version and years.  Scopes that were emptied are left out.
        It has the dimension columns of the facts, so lists and domain checks
        read it in their place."""
        pub = ((self.runs() if runs is None else runs).where(F.col("status") == "published")
               .select("run_id", "seq", "data_version", F.explode("scopes").alias("s")))
        latest = pub.groupBy(*[F.col(f"s.{c}").alias(c) for c in SCOPE]).agg(
            F.max_by(F.struct("run_id", "s.rows", "s.loaded_at", "s.years", "data_version"), "seq").alias("x"))
        return (latest.select(*SCOPE, F.col("x.run_id").alias("import_run_id"), "x.rows", "x.loaded_at",
                              "x.data_version", "x.years")
                .where(F.col("rows").isNull() | (F.col("rows") > 0)))

    def raw_facts(self) -> DataFrame:
        if not self._exists(self.facts_path):
            return self.spark.createDataFrame([], STAT_SCHEMA)
        return self.spark.read.schema(STAT_SCHEMA).parquet(self.facts_path)

    def facts(self) -> DataFrame:
        """The published fact table, as one lazy plan that follows the ledger."""
        return (self.raw_facts()
                .join(self.current_scopes(), [*SCOPE, "import_run_id"], "left_semi")
                .select(*STAT_COLUMNS))

    def visible(self, runs: DataFrame | None = None) -> "Visible":
        """Which scopes of which runs are published at this moment."""
        runs = self.runs() if runs is None else runs
        declared = (runs.where(F.col("status") == "published")
                    .select(F.col("run_id").alias("import_run_id"), F.size("scopes").alias("declared")))
        owned = self.current_scopes(runs).withColumn("key", F.concat_ws("\x1f", *SCOPE, "import_run_id"))
        owners = (owned.groupBy("import_run_id").agg(F.count(F.lit(1)).alias("owned"), F.collect_list("key").alias("keys"))
                  .join(declared, "import_run_id")
                  .select("import_run_id", (F.col("owned") == F.col("declared")).alias("whole"),
                          F.when(F.col("owned") != F.col("declared"), F.col("keys")).alias("keys")).collect())
        return Visible([r["import_run_id"] for r in owners if r["whole"]],
                       {r["import_run_id"]: r["keys"] for r in owners if not r["whole"]})

    def snapshot(self, visible: "Visible | None" = None) -> DataFrame:
        """The published fact table pinned to the scope map of this moment.

        A run that still owns all its scopes is visible as a whole: its id is in
        an ``IN`` list.  Of a run that owns only some, those scopes are listed.
        Both lists are predicates on partition columns alone, so a query reads
        no ledger, joins nothing, and prunes (by its own filters) other scopes
        at planning time; folders of superseded runs are not listed.  One plan
        for any number of scopes."""
        return self._pinned(self.facts_path, STAT_SCHEMA, visible).select(*STAT_COLUMNS)

    def _pinned(self, base: str, schema, visible: "Visible | None") -> DataFrame:
        visible = visible or self.visible()
        rows = self._of_runs(base, schema, visible.run_ids)
        return rows.where(visible.predicate()) if visible.run_ids else rows

    def dimensions(self, visible: "Visible | None" = None) -> DataFrame:
        """Per scope and area its years: what is published, without a fact."""
        return self._pinned(self.areas_path, _AREAS_SCHEMA, visible)

    def file_directory(self, visible: "Visible | None" = None) -> DataFrame:
        """Per scope, year and fact file its rows and its first and last area."""
        return self._pinned(self.files_path, _FILES_SCHEMA, visible)

    def index_names(self) -> int:
        """Write the name index of published runs that have none: a row per
        indicator, area type, area and three neighbouring letters of its name
        (small letters), with the categories the area is in.  Names are dealt once,
        to files of known size; each file has the rows of its names sorted by
        letters, so that a lookup reads few pages of it, also for letters that every
        name has.  A maintenance step, like the compaction; returns how many runs
        were indexed."""
        missing = [r for r in self.visible().run_ids if not self._exists(self._run_folder(self.names_path, r))]
        for run_id in missing:
            areas = self._of_runs(self.areas_path, _AREAS_SCHEMA, [run_id]).select(*SCOPE, "area_name")
            tasks = tasks_for(areas, areas.count(), AREAS_PER_TASK)
            named = areas.repartition(*tasks, "indicator", "area_type", "area_name")
            (named.groupBy("indicator", "area_type", "area_name").agg(F.collect_list("category").alias("categories"))
             .withColumn("trigram", F.explode(trigrams(F.lower("area_name"))))
             .sortWithinPartitions("trigram", "indicator", "area_type")
             .write.mode("overwrite").parquet(self._run_folder(self.names_path, run_id)))
        return len(missing)

    def name_index(self, visible: "Visible | None" = None) -> DataFrame | None:
        """The rows of ``index_names``, one per published category, or None while a
        visible run has none."""
        visible = visible or self.visible()
        if not all(self._exists(f"{self._run_folder(self.names_path, r)}/_SUCCESS") for r in visible.run_ids):
            return None
        rows = self._of_runs(self.names_path, _NAMES_SCHEMA, visible.run_ids).withColumn("category", F.explode("categories"))
        rows = rows.where(visible.predicate()) if visible.run_ids else rows
        return rows.select(*SCOPE, "area_name", "trigram", "import_run_id")

    def of_files(self, entries) -> DataFrame:
        """The rows of the facts in some files of the directory, others unread."""
        paths = sorted({unquote(e["file"]) for e in entries})   # metadata has them as URIs
        if not paths:
            return self.spark.createDataFrame([], STAT_SCHEMA)
        return self.spark.read.schema(STAT_SCHEMA).option("basePath", self.facts_path).parquet(*paths).select(*STAT_COLUMNS)

    def manifest(self, dataset_id: str | None = None) -> DataFrame:
        """The input files of the latest published run of each dataset (or of
        one): path, size, mtime_ms, import_run_id."""
        runs = self.runs().where(F.col("status") == "published")
        if dataset_id is not None:
            runs = runs.where(F.col("dataset_id") == dataset_id)
        latest = runs.groupBy("dataset_id").agg(F.max_by("run_id", "seq").alias("run_id")).collect()
        known = [r["run_id"] for r in latest if self._exists(self._run_folder(self.manifest_path, r["run_id"]))]
        return self._of_runs(self.manifest_path, _MANIFEST_SCHEMA, known)

    def _listing(self) -> DataFrame:
        """One row per file: its folder and partition values; contents are never read."""
        return (self.spark.read.format("binaryFile").schema(_LISTING_SCHEMA).load(self.facts_path)
                .select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"),
                        *SCOPE, "import_run_id"))

    def superseded(self, retention: dt.timedelta = RETENTION) -> DataFrame:
        """Partitions (scope, run id, folder) that may go: those of failed runs,
        and those whose scope was replaced more than ``retention`` ago.  Runs
        that are open, and runs the ledger does not know, are never listed."""
        runs = self.runs().select("run_id", "status", "seq", "event_ts", F.explode_outer("scopes").alias("s"))
        latest = (runs.where(F.col("status") == "published")
                  .groupBy(F.col("s.indicator").alias("indicator"), F.col("s.area_type").alias("area_type"),
                           F.col("s.category").alias("category"))
                  .agg(F.max_by(F.struct("run_id", "event_ts"), "seq").alias("now")))
        state = self.runs().select(F.col("run_id").alias("import_run_id"), "status")
        until = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - retention
        replaced = ((F.col("status") == "published") & (F.col("now.run_id") != F.col("import_run_id"))
                    & (F.col("now.event_ts") <= F.to_timestamp(F.lit(until.strftime("%Y-%m-%d %H:%M:%S.%f")))))
        return (self._listing().distinct().join(state, "import_run_id").join(latest, SCOPE, "left")
                .where((F.col("status") == "failed") | replaced)
                .select(*SCOPE, "import_run_id", "folder"))

    def _drop_folders(self, folders: DataFrame, dry_run: bool) -> int:
        """Delete folders, fetched partition by partition; returns how many there were."""
        n = 0
        for r in folders.select("folder").distinct().toLocalIterator(prefetchPartitions=True):
            n += 1
            if not dry_run:
                fs, p = self._hadoop(r["folder"])
                fs.delete(p, True)
        return n

    def drop_run_files(self, run: RunContext) -> int:
        """Remove what an unpublished attempt of ``run`` wrote (before a retry
        under the same run id); refused for a published run."""
        if not self._exists(self.facts_path):
            return 0
        if self.runs().where((F.col("run_id") == run.run_id) & (F.col("status") == "published")).take(1):
            raise DatasetImportError(f"run {run.run_id} is published; its files stay")
        return sum(self.files.delete(self._run_folder(base, run.run_id))
                   for base in (self.facts_path, self.areas_path, self.files_path, self.names_path))

    def drop_superseded(self, dry_run: bool = True, retention: dt.timedelta = RETENTION) -> int:
        """Delete the folders that ``superseded`` lists; returns how many."""
        if not self._exists(self.facts_path):
            return 0
        return self._drop_folders(self.superseded(retention), dry_run)

    # -- publish
    def keep_manifest(self, run_id: str, listing: DataFrame) -> DataFrame:
        """Write the listing of a run's input files (path, size, mtime_ms) before
        they are read, and return it as written: a file that changes afterwards
        is found changed by the next import."""
        listing.select("path", "size", "mtime_ms").write.parquet(self._run_folder(self.manifest_path, run_id))
        return self._of_runs(self.manifest_path, _MANIFEST_SCHEMA, [run_id])

    def forget_manifest(self, run_id: str) -> None:
        """Remove the manifest of a run that does not take place."""
        self.files.delete(self._run_folder(self.manifest_path, run_id))

    def begin(self, run: RunContext) -> None:
        self._event(run, "started")

    def fail(self, run: RunContext, error: Exception) -> None:
        """Mark a run as failed, unless it is published after all."""
        if not self.runs().where((F.col("run_id") == run.run_id) & (F.col("status") == "published")).take(1):
            self._event(run, "failed", error=error)

    def commit(self, staged: DataFrame, run: RunContext, scopes=None,
               check_duplicates: bool = False, after_write=(), read_at: int | None = None,
               tasks: int | None = None) -> int:
        """Append staged rows under the run id, check them, then commit one log
        entry for every scope.  Returns the published row count.  Raises (and
        publishes nothing) on zero rows, constraint violations, rows outside
        the declared scopes, or a conflict with ``read_at``.

        The checks (row count, NULLs, non-finite values, year range and rows
        outside the scopes) are observed *during* the write: one pass over the
        rows.  Rows and years per scope and the uniqueness of keys come from the
        summaries, grouped aggregates over the written area and year columns;
        their cost does not depend on the number of scopes.  ``after_write``
        callables (checks observed in the same job) run before anything is
        published.  ``check_duplicates`` is kept for callers; keys are always
        checked.  ``tasks``: into how many ranges the rows go, where the caller
        knows how many rows there are; AQE's ranges are of 64 MB, which is some
        million facts, and their sort and each later read is one task."""
        # observed in the write's final stage: each task's metrics are applied
        # once, also when lost executors force task retries
        obs = Observation(f"commit-{run.run_id}")
        metrics = [F.count(F.lit(1)).alias("rows"),
                   *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED],
                   F.count_if(non_finite(F.col("value"))).alias("non_finite_values"),
                   F.count_if(F.col("year").isNotNull() & ~year_in_range(F.col("year")))
                   .alias("years_out_of_range")]
        if scopes is not None:
            mark = F.concat_ws("\x1f", *SCOPE)
            declared = ["\x1f".join(s) for s in scopes]
            metrics.append(F.count_if(~mark.isin(declared) if declared else F.lit(True))
                           .alias("rows_outside_the_scopes"))
        # Range-cluster on (scope, year, area) before writing: each task then
        # writes one contiguous key range (about one file per task instead of
        # one per scope per task), a hot scope is split by year/area across
        # tasks, AQE or the caller sizes the ranges, and files come out sorted for row-group
        # skipping.  Deduplication already happened upstream, so this shuffle
        # moves each staged row once.
        order = ["indicator", "area_type", "category", "year", "area_name"]
        rows = (staged.withColumn("import_run_id", F.lit(run.run_id)).select(*STAT_COLUMNS)
                .repartitionByRange(*([tasks] if tasks else []), *order)
                .observe(obs, *metrics))
        (rows.sortWithinPartitions(*order)
         .write.mode("append")
         .partitionBy("import_run_id", "indicator", "area_type", "category")
         .parquet(self.facts_path))
        for verify in after_write:
            verify()
        check = observed(obs)
        if check is None:
            # the metrics did not arrive: compute them from this run's partitions
            check = self._of_runs(self.facts_path, STAT_SCHEMA, [run.run_id]).agg(*metrics).first().asDict()
        n = check.pop("rows")
        if n == 0:
            raise DatasetImportError(
                f"nothing to publish: dataset {run.dataset_id} gave no row, published rows stay")
        bad = {k: v for k, v in check.items() if v}
        if bad:
            raise DatasetImportError(f"staged rows violate constraints: {bad}")
        keys, found = self._summarise(run, n)
        if keys != n:
            raise DatasetImportError(f"staged rows violate constraints: {{'duplicate_keys': {n - keys}}}")
        owned = [(*scope, found[scope]["rows"] if scope in found else 0, run.loaded_at,
                  found[scope]["years"] if scope in found else [])
                 for scope in (map(tuple, scopes) if scopes is not None else sorted(found))]
        self._event(run, "published", row_count=n, scopes=owned, **({"read_at": read_at} if read_at is not None else {}))
        return n

    def _summarise(self, run: RunContext, n: int) -> tuple[int, dict[tuple, dict]]:
        """Write a run's ``areas`` and ``files``; the number of distinct keys,
        and per scope its rows and years.  ``n``: the run's rows."""
        written = self._of_runs(self.facts_path, STAT_SCHEMA, [run.run_id])
        path = self._run_folder(self.files_path, run.run_id)

        def areas() -> int:
            obs, distinct = Observation(f"areas-{run.run_id}"), F.sum(F.size("years")).alias("keys")
            # an area's years lie in as many files: rows are dealt before they are grouped, to tasks
            # of known size; sorted by scope and area, so that a lookup reads few row groups
            dealt = written.select(*SCOPE, "area_name", "year").repartition(
                *tasks_for(written, n, FACTS_PER_TASK), *SCOPE, "area_name")
            (by_area(dealt).observe(obs, distinct).sortWithinPartitions(*SCOPE, "area_name")
             .write.parquet(self._run_folder(self.areas_path, run.run_id)))
            found = observed(obs) or self._of_runs(self.areas_path, _AREAS_SCHEMA, [run.run_id]).agg(distinct).first().asDict()
            return found["keys"]

        def files() -> list:
            # one row per file and year: as many as there are files, times the years in each
            by_file(written).write.parquet(path)
            return (self.spark.read.parquet(path).groupBy(*SCOPE)
                    .agg(F.sum("rows").alias("rows"), F.sort_array(F.collect_set("year")).alias("years")).collect())

        # two small jobs that do not depend on each other run side by side
        with ThreadPoolExecutor(2) as pool:
            jobs = [pool.submit(inheritable_thread_target(self.spark)(job)) for job in (areas, files)]
            keys, per_scope = (j.result() for j in jobs)
        return keys, {tuple(r[c] for c in SCOPE): {"rows": r["rows"], "years": list(r["years"])} for r in per_scope}


class Visible:
    """Which runs, and of some of them which scopes, are published."""

    def __init__(self, whole: list[str], partly: dict[str, list[str]]):
        self.whole, self.partly = whole, partly
        self.run_ids = [*whole, *partly]

    def predicate(self):
        """On the partition columns of a store's tables."""
        seen = F.col("import_run_id").isin(self.whole) if self.whole else F.lit(False)
        keys = [k for some in self.partly.values() for k in some]
        return seen | F.concat_ws("\x1f", *SCOPE, "import_run_id").isin(keys) if keys else seen
