"""Import pipeline: spec -> read -> headers -> tidy -> keep-last -> checks -> publish.

Steps up to the staged frame are one lazy plan.  Jobs run only for the header
probe and the write; the decoding test, the year check and the publish checks
are observed in the write itself.
"""

from __future__ import annotations

import logging
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from statlake.operators.publish import FactStore
from statlake.operators.reshape import RunContext, to_tidy, to_tidy_deferred
from statlake.plans.spec import DatasetSpec
from statlake.sources.csv import (
    CsvFileNotFoundError,
    UndecodableText,
    read_delimited,
    read_delimited_observed,
)
from statlake.sources.files import data_version, is_changed, list_files, version_of

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ImportResult:
    dataset_id: str
    imported: int
    run_id: str
    path: str
    updated: bool = True    # False: the input has not changed since run_id


def read_raw(spark: SparkSession, spec: DatasetSpec, path: str) -> DataFrame:
    return read_delimited(spark, path, spec.delimiter, spec.csv, spec.column_aliases)


def stage(spark: SparkSession, spec: DatasetSpec, path: str,
          run: RunContext | None = None) -> tuple[DataFrame, RunContext]:
    """The staged tidy rows of one input (lazy) and the run they belong to."""
    if run is None:
        run = RunContext(dataset_id=spec.id, data_version=data_version(spark, path))
    return to_tidy(read_raw(spark, spec, path), spec, run), run


def _version_or_missing(spark, path):
    try:
        return data_version(spark, path)
    except Exception as e:  # noqa: BLE001
        if isinstance(e, FileNotFoundError) or "PATH_NOT_FOUND" in str(e) \
                or "does not exist" in str(e):
            raise CsvFileNotFoundError(path) from e
        raise


def _listing(spark, path):
    try:
        return list_files(spark, path)
    except Exception as e:  # noqa: BLE001
        if isinstance(e, FileNotFoundError) or "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise CsvFileNotFoundError(path) from e
        raise


def unchanged_run(spec: DatasetSpec, listing: DataFrame, store: FactStore) -> str | None:
    """The run that has read exactly these files and still owns all it has
    published, or None."""
    manifest = store.manifest(spec.id)
    known = manifest.select("import_run_id").limit(1).collect()
    if not known or is_changed(listing, manifest):
        return None
    run_id = known[0]["import_run_id"]
    return run_id if run_id in store.visible().whole else None


def import_dataset(spark: SparkSession, spec: DatasetSpec, path: str,
                   store: FactStore, only_changed: bool = False) -> ImportResult:
    """Import one input and publish it atomically, recording the run and the
    files it has read.  ``only_changed``: not if these are the files, of the same
    sizes and times, that the dataset's published run has read."""
    run_id = str(uuid.uuid4())
    listing = store.keep_manifest(run_id, _listing(spark, path))
    version = version_of(listing)
    if version is None:
        raise CsvFileNotFoundError(path)
    if only_changed and (before := unchanged_run(spec, listing, store)):
        store.forget_manifest(run_id)
        return ImportResult(spec.id, 0, before, path, updated=False)
    run = RunContext(dataset_id=spec.id, data_version=version, run_id=run_id)
    store.begin(run)
    try:
        # One pass: the year check and the decoding test are observed inside
        # the write job.  Undecodable text (rare) drops this attempt's files
        # and retries the same run with the next fallback encoding, or, for a
        # folder of several files, with an encoding for each file.
        start = 0
        while True:
            raw_df, decode_check = read_delimited_observed(
                spark, path, spec.delimiter, spec.csv, spec.column_aliases, start=start)
            staged, checks = to_tidy_deferred(raw_df, spec, run)
            checks = ([decode_check] if decode_check else []) + checks
            try:
                n = store.commit(staged, run, spec.scopes(), after_write=checks)
                break
            except UndecodableText as e:
                log.warning("%s; retrying %s with the next encoding", e, spec.id)
                store.drop_run_files(run)
                start = e.next_index
    except Exception as e:
        store.fail(run, e)
        raise
    log.info("imported %s: %d rows (run %s)", spec.id, n, run.run_id)
    return ImportResult(spec.id, n, run.run_id, path)


def import_many(spark: SparkSession, specs, base_dir: str, store: FactStore,
                paths: dict[str, str] | None = None, only_changed: bool = True) -> list[ImportResult]:
    """Import each spec from ``base_dir/<csv_filename>`` (or ``paths[id]``).
    A missing input is a warning and is skipped; any other error stops.  An
    input that has not changed since its published run is not imported again
    (``updated`` is False) unless ``only_changed`` is."""
    out = []
    for spec in specs:
        path = (paths or {}).get(spec.id) or os.path.join(base_dir, spec.csv_filename)
        try:
            out.append(import_dataset(spark, spec, path, store, only_changed))
        except CsvFileNotFoundError:
            log.warning("skip %s: input %s not found", spec.id, path)
    return out


def stage_many(spark: SparkSession, specs, paths: dict[str, str],
               runs: dict[str, RunContext] | None = None) -> DataFrame | None:
    """Union of the staged frames of several specs (missing inputs skipped)."""
    frames = []
    for spec in specs:
        path = paths.get(spec.id)
        try:
            run = (runs or {}).get(spec.id)
            if run is None:
                run = RunContext(dataset_id=spec.id, data_version=_version_or_missing(spark, path))
            frames.append(stage(spark, spec, path, run)[0])
        except CsvFileNotFoundError:
            log.warning("skip %s: input %s not found", spec.id, path)
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
