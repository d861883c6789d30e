"""Hashes that occur more than once (or more than n times) in a very long list.

Most grams of a corpus are unique, and all that is to be learnt of them is that. So
hashes don't travel as rows: a task sorts some hundreds of thousands of them, adds equal
ones up, and sends runs, one per bucket of the hash, that the receiving task merges. A
frequent hash is in a run once, so no task's memory depends on how often it occurs, and
the number of tasks follows the number of hashes. The result, as a bitmap of fixed size
that every task gets, keeps rare hashes out of all later exchanges; the few that share a
place with a frequent one only cost a row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hashes sorted at once, and hashes that one receiving task adds up.
BLOCK, PER_TASK = 1 << 19, 1 << 21
#: Bits of a bitmap (16 MB).
FILTER_BITS = 27
RUNS = "bucket long, hashes binary, times binary"


def bucket_bits(expected: int) -> int:
    """Buckets for so many hashes: several a task, so that tasks are alike."""
    return min(40, math.ceil(math.log2(tasks(expected))) + 4)


def tasks(expected: int) -> int:
    return max(1, math.ceil(expected / PER_TASK))


def _binary_runs(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Consecutive parts of an array as binary values, without copying."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * data.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def runs_of(hashes: np.ndarray, bits: int) -> pa.RecordBatch:
    """The runs (:data:`RUNS`) of some 63-bit hashes."""
    found, times = np.unique(hashes, return_counts=True)
    bucket = found >> np.uint64(63 - bits)
    first = np.flatnonzero(np.diff(bucket, prepend=np.uint64(1 << 63)))
    bounds = np.append(first, len(found))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[first].view(np.int64)), _binary_runs(found, bounds), _binary_runs(times.astype(np.uint32), bounds)],
        ["bucket", "hashes", "times"])


def frequent_hashes(runs: DataFrame, expected: int, least: int) -> DataFrame:
    """(hash): those that occur ``least`` times or more in all runs together."""
    def add(batches):
        hashes, times = [], []
        for batch in batches:
            hashes += [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
            times += [np.frombuffer(x, np.uint32) for x in batch.column(2).to_pylist()]
        if hashes:
            every, n = np.concatenate(hashes), np.concatenate(times)
            del batch, hashes, times
            order = np.argsort(every)
            every, n = every[order], n[order]
            del order
            first = np.flatnonzero(np.diff(every, prepend=~every[:1]))
            often = np.add.reduceat(n, first, dtype=np.int64) >= least
            yield pa.RecordBatch.from_arrays([pa.array(every[first[often]].view(np.int64))], ["hash"])

    return runs.repartition(tasks(expected), "bucket").mapInArrow(add, "hash long")


def bitmap(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Which of 2^bits places the hashes have, as bytes; fixed in size."""
    place = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    cells = (hashes.select(F.shiftright(place, 6).cast("int").alias("cell"),
                           F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
             .groupBy("cell").agg(F.bit_or("bit").alias("word")).toArrow())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[cells.column("cell").to_numpy()] = cells.column("word").to_numpy()
    return out.astype("<i8").view(np.uint8)


def set_in(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the hashes' places are set."""
    place = hashes & np.uint64(len(held) * 8 - 1)
    return (held[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _spread(tokens: np.ndarray) -> np.ndarray:
    """63-bit hashes of 64-bit tokens that may have a sign."""
    x = tokens.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) >> np.uint64(1)


def with_repeated(rows: DataFrame, token: str, expected: int, bits: int = FILTER_BITS) -> DataFrame:
    """``rows``, which are stored, without most of those whose token is in no other row.
    None with a token that occurs again is left out."""
    spark, split = rows.sparkSession, bucket_bits(expected)

    def runs(batches):
        held, n = [], 0
        for batch in batches:
            held.append(_spread(batch.column(0).to_numpy()))
            n += len(held[-1])
            if n >= BLOCK:
                yield runs_of(np.concatenate(held), split)
                held, n = [], 0
        if n:
            yield runs_of(np.concatenate(held), split)

    found = bitmap(frequent_hashes(rows.select(token).mapInArrow(runs, RUNS), expected, 2), bits)
    shared = spark.sparkContext.broadcast(found)
    at = rows.columns.index(token)

    def keep(batches):
        held = shared.value
        for batch in batches:
            yield batch.filter(pa.array(set_in(held, _spread(batch.column(at).to_numpy()))))

    return rows.mapInArrow(keep, rows.schema)


def texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``texts`` (doc_id, ..) joined with ``wanted`` (doc_id, ..), which is stored. Most
    texts that aren't wanted are left out before anything is exchanged."""
    of_id = F.xxhash64("doc_id")
    shared = texts.sparkSession.sparkContext.broadcast(bitmap(wanted.select(of_id.alias("hash"))))

    @F.arrow_udf("boolean")
    def is_held(hashes: pa.Array) -> pa.Array:
        return pa.array(set_in(shared.value, hashes.to_numpy(zero_copy_only=False).view(np.uint64)))

    return texts.filter(is_held(of_id)).join(wanted, "doc_id")
