"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import gc
import math
import sys
import types
import uuid

import ledgerscope
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..session import scratch_path  # noqa: F401

# Task closures carry this package's functions by value, so executors need the
# public libraries only and no copy of the package.
cloudpickle.register_pickle_by_value(ledgerscope)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Bytes of text that one task of a text-sized exchange is given.
TASK_BYTES = 128 << 20

#: Bytes that a Python worker is sent at once: a batch is held by Spark, on its way, and by
#: the worker at the same time, beside the executor's heap.
BATCH_BYTES = 1 << 20

#: Bytes of input for each file of a working table, about.
FILE_BYTES = 8 << 20
#: Session settings while an operator is at work: Spark's size of a batch, and the most files
#: of a working table (0: one for each partition).
BATCH_KEY, FILES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch", "ledgerscope.files"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, UPPER.lower())


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Total UTF-8 bytes of a text column, rows counted as 16 bytes more."""
    row = docs.select(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 16).alias("b")).first()
    return int(row["b"] or 0)


def parts_for(spark: SparkSession, total_bytes: int, task_bytes: int = TASK_BYTES) -> int:
    """Partitions of an exchange over ``total_bytes``: from the data's size,
    at least the session's shuffle partitions."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, least, math.ceil(total_bytes / task_bytes))


def few_files(df: DataFrame) -> DataFrame:
    """``df``, to be written, in no more partitions than :func:`files_for` allows: each is a
    file, and for each local file the executor starts processes that set its rights."""
    files = int(df.sparkSession.conf.get(FILES_KEY, "0"))
    return df.coalesce(files) if files else df


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """``session.reliable_checkpoint`` in few files: empty partitions have one too."""
    return session.reliable_checkpoint(few_files(df))


def files_for(spark: SparkSession, total_bytes: int) -> None:
    """Let the operator at work write its tables in files for an input of so many bytes, if
    the session's shuffle partitions are far more than it needs."""
    files = math.ceil(total_bytes / FILE_BYTES) or 1
    if 4 * files <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(FILES_KEY, str(files))


def in_small_batches(operator):
    """``operator`` (of a DataFrame first), whose own steps send ``BATCH_BYTES`` to Python
    workers at once, not Spark's 64 MB; the session's setting is as before afterwards, and
    what it says by :func:`files_for` ends with it. An operator that it calls is a step."""
    @functools.wraps(operator)
    def run(docs, *args, **named):
        conf = docs.sparkSession.conf
        if conf.get(FILES_KEY, None) is not None:
            return operator(docs, *args, **named)
        before = conf.get(BATCH_KEY)
        conf.set(BATCH_KEY, str(BATCH_BYTES))
        conf.set(FILES_KEY, "0")
        try:
            return operator(docs, *args, **named)
        finally:
            conf.set(BATCH_KEY, before)
            conf.unset(FILES_KEY)

    return run


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a working table that this run wrote and has read for the last time."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of frames that are out of use
    now, instead of when the driver next happens to collect garbage: a job of
    several written steps then needs the disk of one step at a time."""
    gc.collect()
    spark._jvm.System.gc()


class Rows:
    """Rows of documents told apart by identifier and text, for operators that remove or
    cut rows. Usually an identifier has one text and stands for its row itself. Where any
    identifier has several texts, every distinct (identifier, text) gets a number in that
    order (of equal identifiers by a hash of the text), and ``docs`` is a written table
    with it. Rows with identifier and text alike are one document; null ids stay null.

    ``docs``: the input's columns and ``key``; ``names``: (key, doc_id) if they differ.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        from ..functions.keys import dense_surrogate_key

        spark = docs.sparkSession
        self.columns, self.key, self.path = docs.columns, "_row_" + "_".join(docs.columns), None
        own, digest = F.col(f"`{id_col}`").cast("long"), F.xxhash64(text_or_empty(F.col(f"`{text_col}`")))
        pairs = docs.select(own.alias("doc_id"), digest.alias("h")).filter("doc_id IS NOT NULL")
        shared = pairs.groupBy("doc_id").agg((F.min("h") < F.max("h")).alias("s")).filter("s")
        if shared.isEmpty():
            self.names, self.docs = None, docs.withColumn(self.key, own)
            return
        self.names = dense_surrogate_key(pairs.distinct(), ["doc_id", "h"], self.key, 0)
        self.path = scratch_path(spark, f"rows-{uuid.uuid4().hex}")
        numbers = self.names.select(F.col("doc_id").alias("_i" + self.key), F.col("h").alias("_h" + self.key), self.key)
        (docs.join(numbers, (own == F.col("_i" + self.key)) & (digest == F.col("_h" + self.key)), "left")
         .select(*[F.col(f"`{c}`") for c in self.columns], self.key).write.parquet(self.path))
        self.docs = spark.read.parquet(self.path)

    def only(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the input's columns."""
        return docs.select(*[F.col(f"`{c}`") for c in self.columns])

    def doc_ids(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """``rows`` with row numbers in ``columns`` replaced by their identifiers."""
        if self.names is None:
            return rows
        for c in columns:
            ids = self.names.select(F.col(self.key).alias("_n_" + c), F.col("doc_id").alias("_d_" + c))
            rows = rows.join(ids, F.col(c) == F.col("_n_" + c)).withColumn(c, F.col("_d_" + c)).drop("_n_" + c, "_d_" + c)
        return rows


def worker_cache(key, make):
    """``make()`` once per Python worker process and key. Executors that are
    lost only lose the cache; the next task builds it again."""
    holder = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache"))
    if key not in holder.__dict__:
        holder.__dict__[key] = make()
    return holder.__dict__[key]


def order_parts(total_bytes: int, small: int = 16 << 20) -> int:
    """Partitions of an ordered exchange whose consumers start anew in each:
    from the data's size alone, so small tables aren't cut into slivers."""
    return max(1, min(math.ceil(total_bytes / small), max(1024, math.ceil(total_bytes / TASK_BYTES))))


def in_id_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) range-partitioned and sorted by identifier, equal
    identifiers by text; null texts are empty. Sampled bounds include a hash of
    the text, so one identifier on very many rows still spreads."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    parts = order_parts(text_bytes(docs, text_col))
    return (rows.withColumn("h", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "h")
            .sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text"))
