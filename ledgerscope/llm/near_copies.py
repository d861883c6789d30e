"""Near copies of passages, to their extent.

Two passages of ``PASSAGE`` words or more whose word 5-grams are similar at 0.8 have
``RUN`` words in a row in common at the least: an edit costs five grams of either side,
so there is at most one in some 45 words. Every run of ``RUN`` words is therefore a
small paragraph with a band of one row: its least hash of ``SEED`` words in a row, a
seed. Passages that are similar share a seed, wherever lines and sentences end.

A seed that a document of a lower identifier has is a candidate, together with the
least such place. Around both places the texts are compared word by word; where they
part they are joined again behind at most ``EDIT`` words of either side, if ``GRAM``
words agree there. Of all stretches between two such edges the longest one with
``PASSAGE`` words and an exact Jaccard similarity of 0.8 is the copy, and nothing of
the document's own words beyond it.

Limits: a copy is followed ``REACH`` words to either side of a seed; longer ones have
seeds in every ``CELL`` words, each with an extent of its own. Only the least place of
a seed is compared, so a passage goes unseen if all seeds it shares with its likeness
stand in documents of lower identifiers without the rest of the passage.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, few_files, release, reliable_checkpoint
from .frequent import texts_of, with_repeated
from .shingles import mix, slices

GRAM, FACTOR, PASSAGE = 5, 9, 50
SEED, RUN = 12, 25
CELL, REACH, EDIT = 64, 96, 16
#: Bytes of text for each seed, about.
SEED_BYTES = 40

_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]
PLACES = "doc_id long, at long, lead int, words binary, starts binary, ends binary"
EXTENTS = "doc_id long, at long, words int, start long, length long, keep_doc_id long, keep_at long"


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (least or most) of every ``width`` neighbours."""
    out, span = values, 1
    while 2 * span <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    n = len(values) - width + 1
    return pick(out[:n], out[width - span:width - span + n])


def seeds(words: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (among all words) and hashes of the seeds of texts that begin at
    ``base[:-1]``. A seed that comes again within ``CELL`` words of a text is one."""
    n = len(words)
    if n < RUN:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs, width, four = mix(words), 1, None
    while width < 8:
        runs = mix(runs[:-width] * _ODD[0] + (runs[width:] ^ _ODD[1]))
        width *= 2
        four = runs if width == 4 else four
    grams = mix(runs[:n - SEED + 1] * _ODD[2] + four[8:])
    least = _slide(grams, RUN - SEED + 1, np.minimum)
    sizes = np.diff(base)
    ends = np.repeat(base[1:], sizes)
    least[ends[:len(least)] - np.arange(len(least)) < RUN] = 0
    beyond = np.zeros(RUN - SEED, np.uint64)
    most = _slide(np.concatenate((beyond, least, beyond)), RUN - SEED + 1, np.maximum)
    at = np.flatnonzero((most == grams) & (grams > 0))
    text = np.repeat(np.arange(len(sizes)), sizes)[at]
    cell = text.astype(np.uint64) * _ODD[0] + ((at - base[text]) // CELL).astype(np.uint64)
    _, once = np.unique(grams[at] ^ mix(cell), return_index=True)
    at = at[np.sort(once)]
    return at, grams[at].view(np.int64)


def _resume(a: list, b: list) -> tuple[int, int] | None:
    """The nearest places behind which both go on alike."""
    places = {}
    for q, word in enumerate(b[:EDIT + 1]):
        places.setdefault(word, []).append(q)
    found = [(p + q, p, q) for p, word in enumerate(a[:EDIT + 1]) for q in places.get(word, ())
             if len(a) - p >= GRAM and a[p:p + GRAM] == b[q:q + GRAM]]
    return min(found)[1:] if found else None


def _stretches(a: list, b: list) -> list[tuple[int, int, int]]:
    """Equal stretches (place in a, place in b, words) from the beginning of both on."""
    out, x, y = [], 0, 0
    while True:
        most, n = min(len(a) - x, len(b) - y), 0
        while n < most and a[x + n] == b[y + n]:
            n += 1
        out.append((x, y, n))
        x, y = x + n, y + n
        step = _resume(a[x:x + EDIT + GRAM], b[y:y + EDIT + GRAM]) if n < most else None
        if step is None:
            return out
        x, y = x + step[0], y + step[1]


def _similar(a: list, b: list) -> bool:
    one, two = ({tuple(x[k:k + GRAM]) for k in range(len(x) - GRAM + 1)} for x in (a, b))
    return FACTOR * len(one ^ two) <= len(one) + len(two)


def extent(a: list, i: int, b: list, j: int, least: int = PASSAGE) -> tuple[int, int, int, int] | None:
    """First word and end in a, and in b, of the longest near copy around the equal
    words at a[i] and b[j]; None if there is none of ``least`` words."""
    after = _stretches(a[i:], b[j:])
    before = _stretches(a[:i][::-1], b[:j][::-1])
    whole = [(i - x - n, j - y - n, n) for x, y, n in reversed(before)]
    first = whole.pop()
    whole.append((first[0], first[1], first[2] + after[0][2]))
    whole += [(i + x, j + y, n) for x, y, n in after[1:]]
    spans = sorted(((end[0] + end[2] - start[0], start[0], end[0] + end[2], start[1], end[1] + end[2])
                    for s, start in enumerate(whole) for end in whole[s:]), reverse=True)
    for words, x, to, y, end in spans:
        if words < least:
            return None
        if _similar(a[x:to], b[y:end]):
            return x, to, y, end
    return None


def _candidates(seeds_of: DataFrame, runs: DataFrame, expected: int) -> DataFrame:
    """(doc_id, at, keep_doc_id, keep_at): one seed for each cell of a document, keeper
    and distance, of seeds that do not lie in the exact copies ``runs``."""
    rows = reliable_checkpoint(with_repeated(seeds_of, "token", expected))
    first = (rows.groupBy("token").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.max("doc_id").alias("last"))
             .filter("first.doc_id < last").select("token", "first"))
    copied = runs.groupBy("doc_id").agg(F.collect_list(F.struct("at", (F.col("at") + F.col("words")).alias("end"))).alias("runs"))
    return (rows.join(first, "token").filter("first.doc_id < doc_id")
            .select("doc_id", "at", F.col("first.doc_id").alias("keep_doc_id"), F.col("first.at").alias("keep_at"))
            .join(copied, "doc_id", "left")
            .filter(f"NOT coalesce(exists(runs, r -> r.at <= at AND at + {SEED} <= r.end), false)")
            .groupBy("doc_id", "keep_doc_id", F.expr(f"at div {CELL}").alias("cell"), (F.col("at") - F.col("keep_at")).alias("shift"))
            .agg(F.min("at").alias("at")).select("doc_id", "at", "keep_doc_id", (F.col("at") - F.col("shift")).alias("keep_at")))


def _places(docs: DataFrame, read: Callable) -> DataFrame:
    """The words around the wanted places: documents (doc_id, text, wanted: [at])."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                units, rows = read(part.column(1)), []
                words = units.words.astype("<u4")
                place, ends = units.place.astype("<i4"), (units.place + units.size).astype("<i4")
                for t, (doc_id, wanted) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist())):
                    low, high = units.base[t], units.base[t + 1]
                    for at in wanted:
                        a, b = max(low, low + at - REACH), min(high, low + at + SEED + REACH)
                        rows.append((doc_id, at, low + at - a, words[a:b].tobytes(), place[a:b].tobytes(), ends[a:b].tobytes()))
                        if len(rows) == 4096:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    def batch_of(rows):
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                          [f.split()[0] for f in PLACES.split(", ")])

    return docs.select("doc_id", "text", "wanted").mapInArrow(run, PLACES)


def _extents(pairs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            out = []
            for doc_id, at, lead, words, starts, ends, keep_id, keep_at, keep_lead, keep_words in zip(
                    *(c.to_pylist() for c in batch.columns)):
                found = extent(np.frombuffer(words, "<u4").tolist(), lead, np.frombuffer(keep_words, "<u4").tolist(), keep_lead)
                if found:
                    x, to, y, _ = found
                    start = int.from_bytes(starts[4 * x:4 * x + 4], "little")
                    end = int.from_bytes(ends[4 * to - 4:4 * to], "little")
                    out.append((doc_id, at - lead + x, to - x, start, end - start, keep_id, keep_at - keep_lead + y))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if k == 2 else pa.int64()) for k, c in enumerate(zip(*out))],
                    [f.split()[0] for f in EXTENTS.split(", ")])

    return pairs.select("doc_id", "at", "lead", "words", "starts", "ends", "keep_doc_id", "keep_at", "keep_lead",
                        "keep_words").mapInArrow(run, EXTENTS)


def near_copies(texts: DataFrame, seeds_of: DataFrame, runs: DataFrame, size: int, base: str, read: Callable) -> DataFrame:
    """The near copies (:data:`EXTENTS`) in texts (doc_id, text) of ``size`` bytes, without
    what the exact copies ``runs`` (doc_id, at, words) hold already. ``seeds_of`` (token,
    doc_id, at) is stored; ``read`` gives the words of an array of texts."""
    spark = texts.sparkSession
    pairs = reliable_checkpoint(_candidates(seeds_of, runs, size // SEED_BYTES))
    release(spark)
    wanted = reliable_checkpoint(
        pairs.select("doc_id", "at").unionByName(pairs.select(F.col("keep_doc_id").alias("doc_id"), F.col("keep_at").alias("at")))
        .groupBy("doc_id").agg(F.collect_set("at").alias("wanted")))
    _places(few_files(texts_of(texts, wanted)), read).write.option("compression", "zstd").parquet(f"{base}/places")
    release(spark)
    places = spark.read.parquet(f"{base}/places").dropDuplicates(["doc_id", "at"])
    keepers = places.select(F.col("doc_id").alias("keep_doc_id"), F.col("at").alias("keep_at"),
                            F.col("lead").alias("keep_lead"), F.col("words").alias("keep_words"))
    found = _extents(pairs.join(keepers, ["keep_doc_id", "keep_at"]).join(places, ["doc_id", "at"])).distinct()
    out = reliable_checkpoint(found)
    drop_table(spark, f"{base}/places")
    release(spark)
    return out
