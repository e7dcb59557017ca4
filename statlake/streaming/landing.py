"""Incremental imports of files that land in a folder.

The reference imports files in batch after downloading them.  On Spark the
same batch import runs for every *new* file of a landing folder: the file
stream source (metadata only: ``binaryFile`` with the content column
pruned) remembers in its checkpoint which files were already seen, which is
the changed-source decision, and ``foreachBatch`` runs the ordinary import
pipeline for the files of each micro-batch.  A replayed micro-batch after a
failure re-imports the same file, and an import replaces its scopes, so the
result is the same (idempotent sink).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from statlake.operators.publish import FactStore
from statlake.plans.importer import import_dataset
from statlake.plans.spec import DatasetSpec

log = logging.getLogger(__name__)

# The fixed schema of Spark's binaryFile source (content is never read here).
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def landed_files(spark: SparkSession, landing_dir: str, glob: str = "*.csv",
                 max_files_per_trigger: int = 1) -> DataFrame:
    """A stream of (path, size, modificationTime) for files arriving in the folder."""
    return (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
            .option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", str(max_files_per_trigger))
            .load(landing_dir)
            .select("path", "length", "modificationTime"))


def import_landed(spark: SparkSession, spec: DatasetSpec, landing_dir: str, store: FactStore,
                  checkpoint_location: str, glob: str = "*.csv", max_files_per_trigger: int = 1,
                  available_now: bool = False) -> StreamingQuery:
    """Start a query that imports each new file with ``spec`` into ``store``.
    Files of one micro-batch are imported in modification-time order (a
    micro-batch holds at most ``max_files_per_trigger`` paths)."""

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        files = batch.orderBy("modificationTime", "path").select("path").collect()
        for row in files:
            res = import_dataset(spark, spec, row["path"], store)
            log.info("epoch %s: imported %s rows from %s", epoch_id, res.imported, row["path"])

    writer = (landed_files(spark, landing_dir, glob, max_files_per_trigger)
              .writeStream.foreachBatch(run_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
