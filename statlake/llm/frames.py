"""Reading inputs and materialising intermediate tables."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint location and read
    it back: lineage is cut, and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly the two columns an operator works on, whatever else ``docs`` has."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers, once per application, so that
    tasks find it whatever the workers' own path is."""
    sc = spark.sparkContext
    if getattr(sc, "_statlake_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="statlake-py-")) / "statlake.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted((root / "statlake").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(str(target))
    sc._statlake_shipped = True
