"""File listings: data versions and changed-source detection.

A listing is ``spark.read.format("binaryFile")`` with the ``content`` column
pruned, so only file metadata (path, size, modification time) is read and
the listing itself is distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select(
        "path", F.col("length").alias("size"),
        F.unix_millis(F.col("modificationTime")).alias("mtime_ms"))


def version_text(size_col, mtime_col):
    """``size:<bytes>;mtimeMs:<ms>`` as recorded in ``data_version``."""
    return F.concat(F.lit("size:"), F.col(size_col).cast("string"), F.lit(";mtimeMs:"),
                    F.col(mtime_col).cast("string"))


def file_versions(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file: path, size, mtime and its version text."""
    return list_files(spark, path, glob).withColumn(
        "data_version", version_text("size", "mtime_ms"))


#: A SHA-256 is added up in so many parts of 15 hex digits (60 bits) each.
DIGEST_PARTS = 4


def version_of(listing: DataFrame) -> str | None:
    """The version of the files of a listing: the file's own text for one file;
    for several files their number and the sums, modulo 2**60, of the parts of
    each file's SHA-256.  Sums do not depend on the order of a listing and are
    added up per task, so any number of files is one partial aggregate.  None
    for an empty listing."""
    digest = F.sha2(F.concat_ws("=", "path", version_text("size", "mtime_ms")), 256)
    parts = [F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)") for k in range(DIGEST_PARTS)]
    sums = [F.hex(F.pmod(F.sum(p), F.lit(1 << 60)).cast("long")) for p in parts]
    row = listing.agg(F.count(F.lit(1)).alias("n"), F.first(version_text("size", "mtime_ms")).alias("one"),
                      F.concat(*[F.lower(F.lpad(s, 15, "0")) for s in sums]).alias("digest")).first()
    if row["n"] == 0:
        return None
    return row["one"] if row["n"] == 1 else f"files:{row['n']};sha256:{row['digest']}"


def data_version(spark: SparkSession, path: str, glob: str | None = None) -> str:
    """The version of an input, see ``version_of``."""
    version = version_of(list_files(spark, path, glob))
    if version is None:
        raise FileNotFoundError(path)
    return version


def changed_sources(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose (path, size, mtime) is not in the last published manifest:
    those need a new import; the others are ``updated = false``."""
    key = ["path", "size", "mtime_ms"]
    known = manifest.select(*key).distinct().withColumn("__known", F.lit(True))
    return (listing.join(known, key, "left")
            .select(*listing.columns, F.col("__known").isNull().alias("updated")))


def is_changed(listing: DataFrame, manifest: DataFrame) -> bool:
    """Whether a listing differs from a manifest: a file is new, has another
    size or time, or is gone."""
    key = ["path", "size", "mtime_ms"]
    both = (listing.select(*key, F.lit(1).alias("side")).unionByName(manifest.select(*key, F.lit(2).alias("side")))
            .groupBy(*key).agg(F.count_distinct("side").alias("sides")))
    return bool(both.where("sides < 2").take(1))
