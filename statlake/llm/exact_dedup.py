"""Exact deduplication by skew-safe combining.

1. *Local*: each map task combines its rows of equal (digest, salt, text).
2. *Salted merge*: the partial groups meet per (digest, salt, text); the salt
   comes from the row id, so a group of copies that holds a third of all rows
   is merged by ``salts`` tasks and reaches the next step as that many rows.
3. *Global*: the salt winners of a digest are combined per (digest, text).

Every stage groups on the full text next to the digest, so two texts whose
digests collide are never merged.  The rows then look up their group by
digest alone; digests shared by different texts (none, for SHA-256, but any
digest may be given) are looked up by digest and text.

Defined cases: null text counts as empty; the largest id of equal texts stays
(null ids sort lowest); rows repeating both id and text are one document in
``deduplicate`` and each have a row in ``exact_groups``; rows of one id (null
ids too) with different texts are different documents; empty tables give
empty results; other columns are ignored and passed through untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.frames import id_text, materialise
from statlake.llm.text import ascii_lower


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
                 digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    base = id_text(docs, id_col, text_col)
    base = base.select("doc_id", ascii_lower(F.coalesce("text", F.lit(""))).alias("text"))
    base = base.withColumn("digest", digest(F.col("text")))

    salted = (base.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
              .groupBy("digest", "salt", "text")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")))
    contents = (salted.repartition("digest").groupBy("digest", "text")
                .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n")))
    # one entry per different text of the digest, so one entry in practice
    found = (contents.groupBy("digest").agg(F.collect_list(F.struct("keep_id", "n")).alias("texts"))
             .where((F.size("texts") > 1) | (F.col("texts")[0]["n"] > 1)))
    found = materialise(found, "exact-groups")
    several = found.where(F.size("texts") > 1).select("digest")
    groups = found.select("digest", F.col("texts")[0]["keep_id"].alias("group_keep"),
                          F.col("texts")[0]["n"].alias("group_n"), F.size("texts").alias("texts"))

    def result(rows: DataFrame) -> DataFrame:
        return rows.select(
            "doc_id", F.coalesce("group_keep", "doc_id").alias("keep_id"),
            F.coalesce("group_n", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce("group_keep", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")

    # rows carry (id, digest) only; a hot digest is split by the skew join
    light = base.select("doc_id", "digest",
                        (F.col("digest") if digest is sha256_hex else F.sha2("text", 256)).alias("text_sha256"))
    if several.isEmpty():
        return result(light.join(groups, "digest", "left"))
    simple = light.join(several, "digest", "left_anti").join(groups.where("texts = 1"), "digest", "left")
    clash = base.join(several, "digest", "left_semi")
    exact = clash.groupBy("digest", "text").agg(F.max("doc_id").alias("group_keep"),
                                                F.count(F.lit(1)).alias("group_n"))
    resolved = (clash.join(exact, ["digest", "text"])
                .withColumn("text_sha256", F.sha2("text", 256)))
    return result(simple).unionByName(result(resolved))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct text, all columns."""
    keep = (exact_groups(docs, id_col, text_col, salts).where("kept")
            .groupBy(F.col("doc_id").alias("keep_id"), F.col("text_sha256").alias("keep_sha256"))
            .agg(F.count(F.lit(1)).alias("times")))
    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), sha256_hex(text).alias("sha256"))
    held = rows.join(keep, F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("sha256") == F.col("keep_sha256")))
    # only rows of a repeated id and digest are compared by their texts
    repeated = (held.where("times > 1")
                .withColumn("text", ascii_lower(F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))))
                .dropDuplicates(["doc_id", "text"]))
    return held.where("times = 1").select("row.*").unionByName(repeated.select("row.*"))
