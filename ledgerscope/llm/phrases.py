"""Phrase mining over ordered streams of counts.

Texts are counted slice by slice with exact word codes; what leaves a slice are its
distinct phrases of one to four words with their numbers. Before that, a first pass
counts phrases by 63-bit hashes and turns the frequent ones into a bitmap of fixed
size, so that rare phrases (most of them) never travel as strings. A bit too many
only costs a row; what counts is the exact number that Spark adds up afterwards.

The frequent phrases, whose parts are all frequent too, then are two streams of the
same counts: in prefix order (by first word, then second, ...) and in suffix order (by
last word, ...). In prefix order a phrase stands behind its own beginnings, so one walk
with a stack of at most four open phrases gives every phrase the counts of its left
parts, and every open phrase the largest count among its extensions by one word to the
right. Suffix order gives right parts and extensions to the left the same way. The two
are merged by phrase. Nothing is looked up in a table of hashes, and memory stays at one
stack. The streams are range-partitioned, so a frequent first word spreads over many
tasks; the beginnings that a partition's first phrase has in earlier partitions are
handed to it (at most three a partition).

A longer phrase that contains a phrase and is nearly as frequent contains an extension
of it by one word, which is at least as frequent as the longer one: so the largest
extension by one word decides.

Defined results: null or empty texts have no words; a null language is ``und``; repeated
rows count each; ties in score and count are ordered by phrase; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, read_table, release, reliable_checkpoint, scratch_path, text_bytes
from .frequent import FILTER_BITS, RUNS, bitmap, bucket_bits, frequent_hashes, runs_of, set_in
from .shingles import mix, slices

MAX_WORDS = 4
MIN_COUNT = 30
TOP = 2000
SCORE_UNIT = 2_000_000
#: A phrase goes if an extension has this share of its count, in percent.
ABSORBED = 80
#: Rows of a stream's partition, and bytes of text worked on at once.
STREAM_ROWS = 400_000
SLICE_BYTES = 4 << 20

BREAK = r"[.,;:!?\x0A-\x0D]"
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Slice:
    """The words of some texts, one after the other: word codes, language codes, how
    many words are left in the piece from each word on."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        plain = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), BREAK, " \n ")
        lists = pc.split_pattern(pc.replace_substring(plain, "\t", " "), " ")
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        words = coded.dictionary
        skip = pc.is_in(words, pa.array(["", "\n"], words.type)).to_numpy(zero_copy_only=False)
        breaks = pc.equal(words, "\n").to_numpy(zero_copy_only=False)
        per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(len(per_text)), per_text)
        piece = np.cumsum(breaks[index]) + text  # another number behind every break and text
        real = ~skip[index]
        self.words, self.code = words, index[real].astype(np.int64)
        piece, text = piece[real], text[real]
        names = pc.fill_null(langs, "und").dictionary_encode()
        self.langs = names.dictionary
        self.lang = names.indices.to_numpy()[text].astype(np.int64) if len(text) else np.zeros(0, np.int64)
        last = np.searchsorted(piece, piece, "right") if len(piece) else piece
        self.left = last - np.arange(len(piece))

    def hashes(self, size: int) -> np.ndarray:
        """Hashes of all windows of ``size`` words, also of those across pieces."""
        if size == 1:
            own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words.to_numpy(zero_copy_only=False)),
                              np.uint64, len(self.words))
            of_lang = np.fromiter((xxhash.xxh3_64_intdigest(x, seed=1) for x in self.langs.to_pylist()),
                                  np.uint64, len(self.langs))
            self.of_word, self.of_lang = own[self.code], of_lang[self.lang]
        n = max(0, len(self.code) - size + 1)
        total = self.of_lang[:n] + np.uint64(size)
        for k in range(size):
            total = total + self.of_word[k:k + n] * _ODD[k]
        return mix(total)

    def inside(self, size: int) -> np.ndarray:
        """Whether the window of ``size`` words from each word on lies in one piece."""
        return self.left[:max(0, len(self.code) - size + 1)] >= size


def _frequent_hashes(texts: DataFrame, min_count: int, total_bytes: int) -> DataFrame:
    """(hash): of phrases of one to three words that occur ``min_count`` times or more."""
    expected = total_bytes // 2  # three windows a word, and a word is some six bytes
    bits = bucket_bits(expected)

    def split(batches):
        for batch in batches:
            for part in slices(batch, slice_bytes=SLICE_BYTES):
                own = Slice(part.column(0), part.column(1))
                yield runs_of(np.concatenate([own.hashes(size)[own.inside(size)] for size in range(1, MAX_WORDS)]), bits)

    return frequent_hashes(texts.mapInArrow(split, RUNS), expected, min_count)


def _phrase_counts(texts: DataFrame, held_bits) -> DataFrame:
    """(lang, words, times): per slice its phrases whose parts may all be frequent, and
    the number of all words as an empty phrase."""
    def run(batches):
        held = held_bits.value
        for batch in batches:
            for part in slices(batch, slice_bytes=SLICE_BYTES):
                own = Slice(part.column(0), part.column(1))
                at, ids = np.zeros(0, np.int64), own.lang * len(own.words) + own.code
                may = np.zeros(0, bool)
                n = np.bincount(own.lang, minlength=len(own.langs))
                yield pa.RecordBatch.from_arrays(
                    [own.langs.cast(pa.string()), pa.array([[]] * len(n), pa.list_(pa.string())), pa.array(n, pa.int64())],
                    ["lang", "words", "times"])
                for size in range(1, MAX_WORDS + 1):
                    good = own.inside(size)
                    if size < MAX_WORDS:
                        good &= set_in(held, own.hashes(size))
                    if size > 1:
                        good &= may[:len(good)] & may[1:len(good) + 1]
                        # the phrase without its last word, and that word
                        keys = np.where(good, ids[:len(good)] * len(own.words) + own.code[size - 1:], -1)
                    else:
                        keys = ids
                    may = good
                    where = np.flatnonzero(good)
                    found, first, which, times = np.unique(keys[where], return_index=True, return_inverse=True,
                                                           return_counts=True)
                    ids = np.zeros(len(good), np.int64)
                    ids[where] = which
                    at = where[first]
                    flat = own.words.take(pa.array((own.code[at[:, None] + np.arange(size)]).ravel()))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * size, pa.int32()), flat)
                    yield pa.RecordBatch.from_arrays(
                        [own.langs.take(pa.array(own.lang[at])).cast(pa.string()), lists, pa.array(times, pa.int64())],
                        ["lang", "words", "times"])

    return texts.mapInArrow(run, "lang string, words array<string>, times long")


STREAM = "lang string, key array<string>, a long, parts array<long>, wider long"


def ordered_stream(counts: DataFrame, parts: int) -> DataFrame:
    """A walk over the counts (lang, key, a) in key order: for each key the counts of its
    beginnings (``parts``, the shortest first), and of the keys that are longer by one
    the largest count (``wider``, maybe in several rows, one a partition)."""
    ordered = reliable_checkpoint(
        counts.select("lang", "key", "a").repartitionByRange(parts, "lang", "key").sortWithinPartitions("lang", "key")
        .withColumn("part", F.spark_partition_id()))
    firsts = ordered.groupBy("part").agg(F.min(F.struct("lang", "key")).alias("f")).select("part", "f.lang", "f.key")
    heads = (firsts.filter(F.size("key") > 1)
             .withColumn("size", F.explode(F.sequence(F.lit(1), F.size("key") - 1)))
             .select("part", "lang", F.slice("key", F.lit(1), F.col("size")).alias("key"), "size"))
    open_at: dict[int, dict[int, int]] = {}
    for r in counts.join(F.broadcast(heads), ["lang", "key"]).select("part", "size", "a").collect():
        open_at.setdefault(r["part"], {})[r["size"]] = r["a"]  # at most MAX_WORDS - 1 a partition

    def run(batches):
        out: list[tuple] = []
        path: list[list] = []  # of each open beginning: its last word, its count, the widest count
        here = None

        def close(depth):
            while len(path) > depth:
                key = [p[0] for p in path]
                if path[-1][2]:
                    out.append((here, key, None, None, path[-1][2]))
                path.pop()

        def batch_of():
            kinds = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in STREAM.split(", ")])

        for batch in batches:
            for lang, key, a, part in zip(*(c.to_pylist() for c in batch.columns)):
                if here is None:
                    path += [[key[s - 1], n, 0] for s, n in sorted(open_at.get(part, {}).items())]
                elif lang != here:
                    close(0)
                here, same = lang, 0
                while same < len(path) and same < len(key) - 1 and path[same][0] == key[same]:
                    same += 1
                close(same)
                if path:
                    path[-1][2] = max(path[-1][2], a)
                out.append((lang, key, a, [p[1] for p in path], None))
                path.append([key[-1], a, 0])
            if out:
                yield batch_of()
                out.clear()
        close(0)
        if out:
            yield batch_of()

    return ordered.mapInArrow(run, STREAM)


def mine_phrases(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, text_col: str = "text",
                 lang_col: str = "lang", filter_bits: int = FILTER_BITS, stream_rows: int = STREAM_ROWS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases."""
    spark = docs.sparkSession
    base = scratch_path(spark, f"phrases-{uuid.uuid4().hex}")
    texts = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    _frequent_hashes(texts, min_count, text_bytes(docs, text_col)).write.parquet(f"{base}/often")
    release(spark)
    held_bits = spark.sparkContext.broadcast(bitmap(spark.read.parquet(f"{base}/often"), filter_bits))
    (_phrase_counts(texts, held_bits).groupBy("lang", "words").agg(F.sum("times").alias("a"))
     .filter((F.col("a") >= min_count) | (F.size("words") == 0)).write.parquet(f"{base}/counts"))
    release(spark)
    both = spark.read.parquet(f"{base}/counts")
    counts = both.filter(F.size("words") > 0)
    parts = max(1, math.ceil(counts.count() / stream_rows))

    def stream(key, left: str, right: str):
        rows = ordered_stream(counts.select("lang", key.alias("key"), "a"), parts)
        nothing = F.lit(None).cast("array<long>")
        return rows.select("lang", (F.reverse("key") if right == "parts" else F.col("key")).alias("words"), "a",
                           (F.col("parts") if left == "parts" else nothing).alias("lefts"),
                           (F.col("parts") if right == "parts" else nothing).alias("rights"), "wider")

    merged = (stream(F.col("words"), "parts", "").unionByName(stream(F.reverse("words"), "", "parts"))
              .groupBy("lang", "words").agg(*[F.max(c).alias(c) for c in ("a", "lefts", "rights", "wider")])
              .filter(F.size("words") > 1))
    size = F.size("words")
    cut = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(
        k.alias("k"), F.get("lefts", k - 1).alias("l"), F.get("rights", size - k - 1).alias("r")))
    scored = F.array_min(F.transform(cut, lambda c: F.struct(
        F.call_function("div", F.col("a").cast("decimal(20,0)") * F.lit(SCORE_UNIT).cast("decimal(7,0)"),
                        (c["l"] + c["r"]).cast("decimal(20,0)")).alias("score"),
        c["k"].alias("k"), c["l"].alias("l"), c["r"].alias("r"))))
    kept = (merged.filter(F.col("wider").isNull() | (F.col("wider") * 100 < F.col("a") * ABSORBED))
            .select("lang", F.array_join("words", " ").alias("phrase"), "a", scored.alias("s"))
            .select("lang", "phrase", "a", "s.l", "s.r", "s.score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    totals = both.filter(F.size("words") == 0).select("lang", F.col("a").alias("n"))
    out = reliable_checkpoint(first.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
    held_bits.destroy()
    drop_table(spark, base)
    return out


def op11_phrase_mining(spark, sf_dir: str) -> DataFrame:
    return mine_phrases(read_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, ws[i:i + m - 1] AS words FROM (
      SELECT lang, ws, m, unnest(range(1, greatest(len(ws) - m + 2, 1))) AS i
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS m))),
f AS (SELECT lang, words, len(words) AS m, count(*) AS a FROM g GROUP BY lang, words HAVING count(*) >= 30),
longer AS (SELECT lang, words[i:i + k - 1] AS words, max(a) AS wider FROM (
      SELECT lang, words, a, m, k, unnest(range(1, m - k + 2)) AS i
      FROM f, (SELECT unnest([2, 3]) AS k) WHERE m > k) GROUP BY 1, 2),
c AS (SELECT f.lang, f.words, f.a, unnest(range(1, f.m)) AS k, f.m FROM f LEFT JOIN longer USING (lang, words)
      WHERE f.m > 1 AND (wider IS NULL OR 100 * wider < 80 * f.a)),
s AS (SELECT c.lang, c.words, c.a, c.k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a // (x.a + y.a))::BIGINT AS score
      FROM c JOIN f x ON x.lang = c.lang AND x.words = c.words[1:c.k]
             JOIN f y ON y.lang = c.lang AND y.words = c.words[c.k + 1:c.m]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score FROM b) JOIN n USING (lang)
QUALIFY rank <= 2000
"""
