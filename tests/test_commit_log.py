"""Concurrent publishes: one writer per number, losers retry, order is total."""

import threading

import pytest
from pyspark.sql import functions as F

from statlake.operators.commit_log import CommitConflictError, CommitLog, Files
from statlake.operators.publish import FactStore
from statlake.operators.reshape import DatasetImportError, RunContext
from tests.test_store import put, rows, values

SCOPE = [("population", "district", "total")]


@pytest.fixture
def store(spark, tmp_path):
    return FactStore(spark, str(tmp_path / "store"))


def numbers(store):
    return [(n, store.log.read(n)["run_id"]) for n in range(1, store.version() + 1)]


def test_two_interleaved_commits_of_one_scope(spark, store, monkeypatch):
    """The second writer publishes after the first has read the log and before it
    has created its entry: the first loses the number, retries and is last."""
    first, second = RunContext("first", "v"), RunContext("second", "v")
    create, prepared = Files.create, []

    def between(self, path, data):
        if not prepared:
            prepared.append(path)
            FactStore(spark, store.root).commit(rows(spark, 2), second, SCOPE)
        return create(self, path, data)

    monkeypatch.setattr(Files, "create", between)
    store.commit(rows(spark, 1), first, SCOPE)
    assert numbers(store) == [(1, second.run_id), (2, first.run_id)]
    assert prepared == [store.log.path(1)]
    seqs = [store.log.read(n)["seq"] for n in (1, 2)]
    assert seqs[0] < seqs[1]
    assert values(store.facts()) == values(store.snapshot()) == [1.0]


def test_a_writer_that_depends_on_what_it_read_is_refused(spark, store):
    put(store, rows(spark, 1))
    read_at = store.version()
    put(store, rows(spark, 2, indicator="households"))      # another scope: no conflict
    run = RunContext("d", "v")
    assert store.commit(rows(spark, 3), run, SCOPE, read_at=read_at) == 1
    late = RunContext("d", "v")
    with pytest.raises(CommitConflictError, match="replaced"):
        store.commit(rows(spark, 4), late, SCOPE, read_at=read_at)
    assert values(store.facts()) == [2.0, 3.0]


def test_a_conflict_found_while_retrying_is_refused(spark, store, monkeypatch):
    put(store, rows(spark, 1))
    create, done = Files.create, []

    def between(self, path, data):
        if not done:
            done.append(1)
            FactStore(spark, store.root).commit(rows(spark, 2), RunContext("other", "v"), SCOPE)
        return create(self, path, data)

    monkeypatch.setattr(Files, "create", between)
    with pytest.raises(CommitConflictError):
        store.commit(rows(spark, 3), RunContext("late", "v"), SCOPE, read_at=store.version())
    assert values(store.facts()) == [2.0]


@pytest.mark.parametrize("rename", [False, True])
def test_threads_take_distinct_numbers(spark, tmp_path, monkeypatch, rename):
    if rename:   # the way of file systems without hard links
        monkeypatch.setattr(Files, "create", lambda self, path, data: _renaming(self, path, data))
    log = CommitLog(Files(spark), str(tmp_path / "log"))
    taken, lock = [], threading.Lock()
    guard = threading.Lock() if rename else None   # the local rename checks and moves in two steps

    def write(name):
        for k in range(5):
            if guard:
                with guard:
                    n = log.append(lambda number, before: {"by": name, "number": number, "after": (before or {}).get("number", 0)})
            else:
                n = log.append(lambda number, before: {"by": name, "number": number, "after": (before or {}).get("number", 0)})
            with lock:
                taken.append((n, name))

    threads = [threading.Thread(target=write, args=(f"w{k}",)) for k in range(4)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert sorted(n for n, _ in taken) == list(range(1, 21)) and log.last() == 20
    for n, name in taken:
        assert log.read(n) == {"by": name, "number": n, "after": n - 1}


def _renaming(files, path, data):
    hidden = files._hidden(path, data)
    try:
        return files._rename_if_absent(hidden, path)
    finally:
        files.delete(hidden)


def test_an_existing_number_is_never_overwritten(spark, tmp_path):
    files = Files(spark)
    path = str(tmp_path / "a" / "1.json")
    assert files.create(path, b"one") and not files.create(path, b"two")
    assert not _renaming(files, path, b"three")
    assert files.read(path) == b"one" and files.names(str(tmp_path / "a")) == ["1.json"]


def test_a_lost_answer_counts_as_published(spark, store, monkeypatch):
    """The entry is written, but the call that wrote it raises."""
    create = Files.create

    def lost(self, path, data):
        create(self, path, data)
        raise OSError("connection reset")

    monkeypatch.setattr(Files, "create", lost)
    run = put(store, rows(spark, 1), SCOPE)
    monkeypatch.setattr(Files, "create", create)
    store.fail(run, OSError("connection reset"))
    assert {r["status"] for r in store.runs().collect()} == {"published"} and values(store.facts()) == [1.0]


def test_an_entry_that_was_not_written_is_an_error(spark, store, monkeypatch):
    monkeypatch.setattr(Files, "create", lambda self, path, data: (_ for _ in ()).throw(OSError("no space")))
    run = RunContext("d", "v")
    with pytest.raises(OSError, match="no space"):
        store.commit(rows(spark, 1), run, SCOPE)
    store.fail(run, OSError("no space"))
    assert [r["status"] for r in store.runs().collect()] == ["failed"] and store.version() == 0


def test_parts_of_the_log(spark, tmp_path, monkeypatch):
    from statlake.operators import commit_log
    monkeypatch.setattr(commit_log, "PART", 3)
    log = CommitLog(Files(spark), str(tmp_path / "log"))
    for n in range(1, 9):
        assert log.append(lambda number, before: {"number": number}) == n
    assert [p.rpartition("=")[2].lstrip("0") or "0" for p in log.paths_after(0)] == ["0", "1", "2"]
    assert [p.rpartition("=")[2].lstrip("0") for p in log.paths_after(6)] == ["2"]
    assert [p.rpartition("=")[2].lstrip("0") for p in log.paths_after(5)] == ["2"]


def test_compaction_folds_closed_publishes(spark, store):
    import datetime as dt

    from statlake.operators import publish
    put(store, rows(spark, 1))
    put(store, rows(spark, 2, category="male"))
    later = dt.datetime.now(dt.timezone.utc).date() + dt.timedelta(days=publish.OPEN_DAYS + 1)
    day = store.compact_ledger(today=later)
    assert store._folded_number(day) == 2 and store.events(day, 2).count() == 0
    assert values(store.facts()) == [1.0, 2.0]
    assert sorted(r["rows"] for r in store.scope_table().collect()) == [1, 1]


def test_duplicate_keys_are_always_refused(spark, store):
    twice = rows(spark, 1).unionByName(rows(spark, 1))
    with pytest.raises(DatasetImportError, match="duplicate_keys"):
        put(store, twice, SCOPE)
    assert store.version() == 0


def test_counts_of_many_scopes_come_from_one_aggregate(spark, store):
    frame = spark.range(600 * 20).select(
        F.concat(F.lit("ind"), F.col("id") % 600).alias("indicator"), F.lit("district").alias("area_type"),
        F.concat(F.lit("a"), F.floor(F.col("id") / 600)).alias("area_name"), (F.lit(1990) + F.col("id") % 3).cast("int").alias("year"),
        F.col("id").cast("double").alias("value"), F.lit("u").alias("unit"), F.lit("total").alias("category"),
        F.lit("s").alias("source_dataset"), F.lit(None).cast("timestamp").alias("loaded_at"), F.lit("v").alias("data_version"))
    scopes = [(f"ind{k}", "district", "total") for k in range(600)] + [("none", "district", "total")]
    put(store, frame, scopes)
    table = {r["indicator"]: r for r in store.scope_table().collect()}
    assert len(table) == 600 and {r["rows"] for r in table.values()} == {20}
    assert table["ind7"]["years"] == [1991]
    assert store.dimensions().count() == 12_000 and store.file_directory().agg(F.sum("rows")).first()[0] == 12_000
