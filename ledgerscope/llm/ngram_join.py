"""N-gram Jaccard join by prefix trees.

A document's set is its distinct word 3-grams (fewer words: the whole sequence as
one), as 63-bit hashes. Documents with equal sets are one class, found by a 128-bit
digest, so copies never meet pair by pair. Each class offers the first codes of its
set under one global order as candidate records: two sets of Jaccard similarity j
share k of their first n - ceil(j n) + k codes, here with k = 2 + n / ``EXTRA``, so
texts that have a few grams in common by chance are no candidates. The order puts grams with a rare
word first: words are counted over the whole table (those seen ``OFTEN_IN_TASK``
times within a task at least), and a gram's place is the rank of its rarest word
among the ``ORDERED`` most frequent. The order steers cost alone; any order gives the
same links. ``setlink`` turns records into blocks, joins
them by prefix trees and finds the components.

Defined results: no words (or null): an empty set, linked with nothing, its component
is its own identifier; repeated rows get equal results; rows without identifier take
part through their text, the component is the least identifier that is not null; an
empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import setlink
from .common import (Rows, drop_table, few_files, files_for, in_small_batches, parts_for, read_table, release,
                     reliable_checkpoint, scratch_path, text_bytes)
from .frequent import texts_of, with_repeated
from .shingles import WordRanks, gram_hashes, gram_sets, rarest_first, slices, word_hashes

WORDS = 3
#: (1 + j) / (1 - j) for a similarity of j = 0.9.
FACTOR = 19
ORDERED = 1 << 16
OFTEN_IN_TASK = 4
#: Words that a task adds up at once, and distinct ones that it holds.
COUNTED, HELD = 1 << 18, 1 << 20
EXTRA = 40
#: Bytes of text for each candidate record, about.
RECORD_BYTES = 20
SETS = "sid long, key binary, n int, codes binary, large int"


def digest_of(codes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(codes.astype("<u8").tobytes())


def sid_of(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


class WordCounts:
    """How often words occur, added up whenever ``COUNTED`` have come."""

    def __init__(self):
        self.words, self.times, self.new, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, words: np.ndarray) -> None:
        self.new.append(words)
        self.n += len(words)
        if self.n >= COUNTED:
            self.merge()

    def merge(self) -> None:
        words, times = np.unique(np.concatenate([self.words[:0], *self.new]), return_counts=True)
        both, place = np.unique(np.concatenate((self.words, words)), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, place, np.concatenate((self.times, times)))
        self.words, self.times, self.new, self.n = both, total, [], 0


def _classes(docs: DataFrame, size: int) -> DataFrame:
    """Rows of documents (doc_id, n, key, sid) and rows of frequent words (word, times)."""

    names = ["is_doc", "doc_id", "n", "key", "sid", "word", "times"]
    kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def batch_of(rows, **columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], kind) if c in columns else pa.nulls(rows, kind) for c, kind in zip(names, kinds)], names)

    def often(words, times):
        chosen = times >= OFTEN_IN_TASK
        n = int(chosen.sum())
        return batch_of(n, is_doc=np.zeros(n, bool), word=words[chosen].view(np.int64), times=times[chosen])

    def run(batches):
        seen = WordCounts()
        for part in (part for batch in batches for part in slices(batch)):
            ids, sizes, keys, sids, start = part.column(0).to_pylist(), [], [], [], 0
            words, ends = word_hashes(part.column(1))
            for end in ends.tolist():
                grams = np.unique(gram_hashes(words[start:end], size))
                sizes.append(len(grams))
                keys.append(digest_of(grams) if len(grams) else None)
                sids.append(sid_of(keys[-1]) if len(grams) else None)
                start = end
            yield batch_of(len(ids), is_doc=np.ones(len(ids), bool), doc_id=ids, n=sizes, key=keys, sid=sids)
            seen.add(words)
            if len(seen.words) >= HELD:
                yield often(seen.words, seen.times)
                seen = WordCounts()
        seen.merge()
        yield often(seen.words, seen.times)

    return docs.mapInArrow(
        run, "is_doc boolean, doc_id long, n long, key binary, sid long, word long, times long")


def _records(docs: DataFrame, size: int, factor: int, frequent: list[int]) -> DataFrame:
    """(token, sid, core): each set's first codes; linked sets share one that is core for both."""

    def run(batches):
        ranks = WordRanks(frequent)
        for batch in batches:
            for part in slices(batch):
                tokens, sids, core = [], [], []
                for grams, ordered in rarest_first(part.column(1), size, ranks):
                    n = len(grams)
                    if n:
                        least = n + (-n * (factor - 1) // (factor + 1)) + 1
                        first = min(n, least + 1 + n // EXTRA)
                        tokens.append(ordered[:first])
                        sids.append(np.full(first, sid_of(digest_of(grams)), np.int64))
                        core.append(np.arange(first) < least)
                if tokens:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(sids)),
                        pa.array(np.concatenate(core))], ["token", "sid", "core"])

    return docs.mapInArrow(run, "token long, sid long, core boolean")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(sid, key, n, codes, large) of the sets of documents (doc_id, text, large)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                rows = []
                for grams, large in zip(gram_sets(part.column(1), size), part.column(2).to_pylist()):
                    if len(grams):
                        key = digest_of(grams)
                        rows.append((sid_of(key), key, len(grams), grams.astype("<u8").tobytes(), large))
                if rows:
                    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     ["sid", "key", "n", "codes", "large"])

    return docs.mapInArrow(run, SETS)


@in_small_batches
def similar_documents(docs: DataFrame, size: int = WORDS, factor: int = FACTOR, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    spark = docs.sparkSession
    release(spark)
    total = text_bytes(docs, text_col)
    files_for(spark, total)
    parts = parts_for(spark, total)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = scratch_path(spark, f"ngram-join-{uuid.uuid4().hex}")
    _classes(texts, size).write.parquet(f"{base}/classes")
    both = spark.read.parquet(f"{base}/classes")
    rows = both.filter("is_doc").select("doc_id", "n", "key", "sid")
    often = (both.filter("NOT is_doc").groupBy("word").agg(F.sum("times").alias("t"))
             .orderBy(F.desc("t"), "word").limit(ORDERED).collect())
    frequent = [r["word"] for r in reversed(often)]  # at most ORDERED words

    _records(texts, size, factor, frequent).write.parquet(f"{base}/records")
    release(spark)
    classes = rows.filter("key IS NOT NULL").groupBy("key", "sid", "n").agg(F.min("doc_id").alias("rep"))
    # a partner has at least (factor - 1) / (factor + 1) times the grams
    needs = classes.select("sid", "n", F.expr(
        f"least(2 + (n * {factor - 1} div {factor + 1}) div {EXTRA}, ceil(n * {factor - 1}D / {factor + 1}))"
    ).alias("need"))
    # most tokens are unique: they leave before anything is exchanged by token
    records = reliable_checkpoint(with_repeated(spark.read.parquet(f"{base}/records"), "token", total // RECORD_BYTES))
    drop_table(spark, f"{base}/records")
    members = reliable_checkpoint(setlink.worth_joining(
        reliable_checkpoint(setlink.blocks_of(reliable_checkpoint(setlink.members_of(records, needs, factor)))),
        classes.select("sid", "n"), factor))
    del records
    release(spark)
    in_large = members.groupBy("sid").agg((F.max("m") > setlink.SMALL).cast("int").alias("large"))
    needed = reliable_checkpoint(classes.join(in_large, "sid").groupBy(F.col("rep").alias("doc_id"))
                                 .agg(F.max("large").alias("large")))
    found = texts_of(texts, needed).dropDuplicates(["doc_id", "text"])
    nameless = (texts.filter("doc_id IS NULL").dropDuplicates(["text"])  # not reached by identifier
                .withColumn("large", F.lit(1)))
    _sets(few_files(found.unionByName(nameless)), size).write.partitionBy("large").parquet(f"{base}/sets")
    release(spark)
    links = setlink.links_of(members, spark.read.schema(SETS).parquet(f"{base}/sets"), factor, parts)
    links.write.parquet(f"{base}/links")
    drop_table(spark, f"{base}/sets")
    release(spark)

    tree = setlink.components(spark.read.parquet(f"{base}/links"))
    rooted = (classes.join(tree.withColumnRenamed("node", "key"), "key", "left")
              .select("key", "rep", F.coalesce("root", "key").alias("root")))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_key = rooted.join(least, "root").select("key", "component_id")
    return rows.join(of_key, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


@in_small_batches
def keep_one_of_each(docs: DataFrame, size: int = 5, factor: int = 9, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component of documents that are similar at
    0.8 (``factor`` 9) in their word 5-grams: the one with the least identifier, of
    equal identifiers the one whose text has the least hash. Documents are rows told
    apart by identifier and text (:class:`Rows`), so texts that share an identifier are
    judged one by one. Rows without identifier and documents without words stay."""
    rows = Rows(docs, id_col, text_col)
    gone_key = "_gone" + rows.key
    gone = (similar_documents(rows.docs, size, factor, rows.key, text_col)
            .filter("doc_id <> component_id AND n_shingles > 0").select(F.col("doc_id").alias(gone_key)).distinct())
    return few_files(rows.only(rows.docs.join(gone, F.col(rows.key) == F.col(gone_key), "left_anti")))


def op5_ngram_join(spark, sf_dir: str) -> DataFrame:
    return similar_documents(read_table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN array_to_string(words, ' ')
    ELSE array_to_string(words[i:i + 2], ' ') END AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(w.doc_id, coalesce((SELECT min(y) FROM r WHERE r.x = w.doc_id), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
"""
