"""The publish store keeps published rows: drops, errors, scopes, late writers."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from statlake.operators import publish
from statlake.operators.publish import FactStore
from statlake.operators.reshape import DatasetImportError, RunContext
from statlake.schema import STAT_SCHEMA

NOW = dt.timedelta(0)


def rows(spark, *values, indicator="population", category="total"):
    return spark.createDataFrame(
        [(indicator, "district", f"area{k}", 2020, float(v), "u", category, "s", None, None, "v")
         for k, v in enumerate(values)], STAT_SCHEMA)


def put(store, frame, scopes=None):
    run = RunContext("d", "v")
    store.begin(run)
    store.commit(frame, run, scopes)
    return run


@pytest.fixture
def store(spark, tmp_path):
    return FactStore(spark, str(tmp_path / "store"))


def values(frame):
    return sorted(r["value"] for r in frame.collect())


def test_drop_during_an_open_run_keeps_its_files(spark, store, monkeypatch):
    put(store, rows(spark, 1))
    event = FactStore._event

    def late(self, run, status, **kw):
        if status == "published":
            self.drop_superseded(dry_run=False, retention=NOW)
        event(self, run, status, **kw)

    monkeypatch.setattr(FactStore, "_event", late)
    put(store, rows(spark, 2))
    assert values(store.facts()) == [2.0]


def test_unknown_runs_are_never_dropped(spark, store):
    put(store, rows(spark, 1))
    stray = RunContext("d", "v")   # wrote files, but the ledger has no event of it
    with pytest.raises(DatasetImportError):
        store.commit(rows(spark, 5), stray, scopes=[("other", "district", "total")])
    assert store.superseded(NOW).count() == 0
    store.fail(stray, ValueError("x"))
    assert {r["import_run_id"] for r in store.superseded(NOW).collect()} == {stray.run_id}
    assert store.drop_superseded(dry_run=False, retention=NOW) == 1
    assert values(store.facts()) == [1.0]


def test_a_snapshot_outlives_a_reimport_and_a_drop_within_the_retention(spark, store):
    put(store, rows(spark, 1))
    snapshot = store.snapshot()
    put(store, rows(spark, 2))
    assert store.drop_superseded(dry_run=False) == 0
    assert values(snapshot) == [1.0] and values(store.facts()) == [2.0]


def test_published_files_cannot_be_dropped_as_an_attempt(spark, store):
    run = put(store, rows(spark, 1))
    with pytest.raises(DatasetImportError, match="published"):
        store.drop_run_files(run)


@pytest.mark.parametrize("error", ["disk on fire"])
def test_storage_errors_are_raised(spark, store, monkeypatch, error):
    put(store, rows(spark, 1))

    class Broken:
        def exists(self, path):
            raise OSError(error)

    monkeypatch.setattr(FactStore, "_hadoop", lambda self, path: (Broken(), path))
    with pytest.raises(OSError, match=error):
        store.facts()


def test_a_damaged_event_is_an_error(spark, store, tmp_path):
    put(store, rows(spark, 1))
    day = next((tmp_path / "store" / "ledger").glob("event_day=*"))
    (day / "part-x.json").write_text('{"run_id": "r", "seq": "no number"')
    with pytest.raises(Exception):
        store.facts().collect()


def test_rows_outside_the_declared_scopes_are_refused(spark, store):
    both = rows(spark, 1).unionByName(rows(spark, 2, category="male"))
    with pytest.raises(DatasetImportError, match="rows_outside_the_scopes"):
        put(store, both, scopes=[("population", "district", "total")])
    assert store.facts().count() == 0
    put(store, both, scopes=[("population", "district", "total"), ("population", "district", "male")])
    assert store.facts().count() == 2


def test_a_writer_with_a_late_clock_publishes_last(spark, store, monkeypatch):
    put(store, rows(spark, 1))
    monkeypatch.setattr(publish.time, "time_ns", lambda at=time.time_ns() - 60 * 10**9: at)
    put(store, rows(spark, 2))
    assert values(store.facts()) == [2.0]


def test_late_events_after_a_compaction_stay_visible(spark, store, monkeypatch):
    put(store, rows(spark, 1))
    today = dt.datetime.now(dt.timezone.utc).date()
    folded = store.compact_ledger()
    assert folded == (today - dt.timedelta(days=publish.OPEN_DAYS + 1)).isoformat()
    monkeypatch.setattr(publish.time, "time_ns", lambda at=time.time_ns() - 60 * 10**9: at)
    late = put(store, rows(spark, 2, indicator="households"))
    assert {r["run_id"]: r["status"] for r in store.runs().collect()}[late.run_id] == "published"
    assert values(store.facts()) == [1.0, 2.0]


def test_folded_days_keep_their_runs_and_take_no_events(spark, store):
    run = put(store, rows(spark, 1))
    before = sorted((r["run_id"], r["status"], r["seq"]) for r in store.runs().collect())
    later = dt.datetime.now(dt.timezone.utc).date() + dt.timedelta(days=publish.OPEN_DAYS + 1)
    assert store.compact_ledger(today=later) == (later - dt.timedelta(days=publish.OPEN_DAYS + 1)).isoformat()
    assert sorted((r["run_id"], r["status"], r["seq"]) for r in store.runs().collect()) == before
    assert values(store.facts()) == [1.0]
    with pytest.raises(DatasetImportError, match="behind the ledger"):
        store.begin(RunContext("d", "v"))
    assert run.run_id in {r["run_id"] for r in store.runs().collect()}


def test_an_unfinished_compaction_is_ignored(spark, store, tmp_path):
    put(store, rows(spark, 1))
    (tmp_path / "store" / "ledger_state" / "upto_day=2999-01-01").mkdir(parents=True)
    assert store._folded_day() is None and values(store.facts()) == [1.0]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from statlake import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_replaced_scope_by_scope(spark, store):
    put(store, rows(spark, 1).unionByName(rows(spark, 5, category="male")))
    put(store, rows(spark, 2))
    assert values(store.facts()) == [2.0, 5.0] and values(store.snapshot()) == [2.0, 5.0]
    assert store.superseded(NOW).select(F.col("category")).collect() == [("total",)]


def test_lists_and_checks_read_the_ledger_only(spark, store):
    from statlake.operators import query as q
    from statlake.plans.service import StoreService

    put(store, rows(spark, 1, 2).unionByName(rows(spark, 5, category="male")),
        scopes=[("population", "district", "total"), ("population", "district", "male"),
                ("population", "district", "female")])
    s = StoreService(store)
    lists = [s.list_indicators()[0], s.list_area_types(), s.list_categories("population", "district")]
    for df in lists:
        assert not any("/facts/" in f for f in df.inputFiles())
    assert [[r[0] for r in df.collect()] for df in lists] == [["population"], ["district"], ["male", "total"]]
    assert s.freshness().first()["row_count"] == 3
    with pytest.raises(q.StatisticsValidationError, match="Unknown category: female"):
        s.get_ranking("population", "district", 2020, categories=["female"])
    page, meta, areas = s.get_timeseries("population", "district", [], limit=2)
    assert meta.first()["total"] == 3 and [r["area"] for r in areas.collect()] == ["area0"]
    assert len(page.collect()) == 2


def test_file_summaries_sort_no_rows(spark, tmp_path):
    """First and last areas are grouped by hashing: a sort would hold every row of a task, with its path."""
    rows = [("i", "t", c, f"area {k:03d}", 1990 + k % 3, float(k)) for c in ("a", "b") for k in range(90)]
    path = str(tmp_path / "facts")
    (spark.createDataFrame(rows, "indicator string, area_type string, category string, area_name string, year int, value double")
     .write.partitionBy("indicator", "area_type", "category").parquet(path))
    found = publish.by_file(spark.read.parquet(path))
    assert "Sort" not in found._jdf.queryExecution().sparkPlan().toString()
    least, most = {}, {}
    for r in found.collect():
        key = (r.category, r.year)
        least[key], most[key] = min(least.get(key, "z"), r.first_area), max(most.get(key, ""), r.last_area)
    assert least == {(c, 1990 + y): f"area {y:03d}" for c in "ab" for y in range(3)}
    assert most == {(c, 1990 + y): f"area {87 + y:03d}" for c in "ab" for y in range(3)}
    assert sum(r.rows for r in found.collect()) == 180


def test_facts_are_not_dealt_by_scope(spark):
    """A scope may hold most facts: its rows stay spread over all tasks."""
    facts, scopes = rows(spark, 1, 2, 3), publish.scopes_frame(spark, [("population", "district", "total")])
    for found, n in ((publish.in_scopes(facts, scopes), 3), (publish.replace_scopes(facts, facts.limit(0), scopes), 0)):
        assert "SortMergeJoin" not in found._jdf.queryExecution().sparkPlan().toString()
        assert found.count() == n
