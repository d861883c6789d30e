"""Exact deduplication by a content sort.

Texts are normalised (A-Z lower-cased, null is empty). Sampled splitters
range-partition the rows on the normalised bytes: the leading characters first,
then a 64-bit hash so that texts with a common beginning still spread. Inside a
partition Spark's external sort on the whole text brings equals together, and
each row is compared in full with its neighbour: a row that differs from the row
before starts a new run. The exchange's own keys are the window's partition
keys, so the texts are moved once.

A text whose copies make up more than a quarter of a partition's share of all
bytes is salted by a hash of doc_id over several partitions; its per-salt runs
(at most four a partition, a bound that does not depend on the data's content)
are merged by their SHA-256.

Which row stays is the largest identifier of the run (``keep="max"``) or the
smallest. Defined results: null and empty texts are equal; of repeated rows with
the same identifier one stays; a null identifier stays only if all of its group
are null; an empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (ascii_lower, few_files, files_for, in_small_batches, parts_for, read_table,
                     reliable_checkpoint, text_bytes, text_or_empty)

PREFIX = 24


@in_small_batches
def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "max") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256 (of the normalised text)."""
    spark = docs.sparkSession
    total = text_bytes(docs, text_col)
    files_for(spark, total)
    parts = parts_for(spark, total)
    norm = ascii_lower(text_or_empty(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"))
    rows = rows.withColumn("h", F.xxhash64("norm"))

    share = max(1, total // (4 * parts))
    hot = (rows.select("h", (F.octet_length("norm") + 16).alias("b")).groupBy("h")
           .agg(F.sum("b").alias("b"), F.count("*").alias("c")).filter(f"b > {share} AND c > 1")
           .select("h", F.ceil(F.col("b") / share).cast("int").alias("salts")))
    # at most 4 * parts rows, as each holds over 1 / (4 * parts) of the bytes
    rows = (rows.join(F.broadcast(hot), "h", "left")
            .withColumn("salts", F.coalesce("salts", F.lit(1)))
            .withColumn("salt", F.when(F.col("salts") > 1, F.pmod(F.xxhash64("doc_id"), "salts"))
                        .otherwise(F.lit(0)))
            .withColumn("lead", F.substring("norm", 1, PREFIX)))
    keys = ["lead", "h", "salt"]
    order = F.col("doc_id").desc_nulls_last() if keep == "max" else F.col("doc_id").asc_nulls_last()
    best = F.max if keep == "max" else F.min
    near = Window.partitionBy(*keys).orderBy("norm", order)
    run = Window.partitionBy(*keys, "norm")
    runs = reliable_checkpoint(
        rows.repartitionByRange(parts, *keys)
        .select("doc_id", "salts",
                F.sha2("norm", 256).alias("text_sha256"),
                (~F.col("norm").eqNullSafe(F.lag("norm").over(near))).alias("first"),
                best("doc_id").over(run).alias("run_keep"),
                F.count(F.lit(1)).over(run).alias("run_size")))

    split = (runs.filter("salts > 1 AND first").groupBy("text_sha256")
             .agg(best("run_keep").alias("all_keep"), F.sum("run_size").alias("all_size")))
    out = runs.join(F.broadcast(split), "text_sha256", "left")
    keep_id = F.when(F.col("salts") > 1, F.col("all_keep")).otherwise(F.col("run_keep"))
    return out.select(
        "doc_id", keep_id.alias("keep_id"),
        F.when(F.col("salts") > 1, F.col("all_size")).otherwise(F.col("run_size")).alias("group_size"),
        (F.col("first") & F.col("doc_id").eqNullSafe(keep_id)).alias("kept"), "text_sha256")


@in_small_batches
def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows repeated with
    identifier and text alike stay once."""
    mark = "_sha_of_" + "_".join(docs.columns)  # no input column can have this name
    kept = exact_duplicates(docs, id_col, text_col, keep).filter("kept").select(
        F.col("doc_id").alias("_k"), F.col("text_sha256").alias("_s"))
    rows = docs.withColumn(mark, F.sha2(ascii_lower(text_or_empty(text_col)), 256))
    out = rows.join(kept, (rows[mark] == kept["_s"]) & rows[id_col].eqNullSafe(kept["_k"]), "left_semi")
    return few_files(out.dropDuplicates([mark]).select(*[F.col(f"`{c}`") for c in docs.columns]))


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", "text_sha256")


OP6_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
