"""Substring deduplication by MinHash banding of paragraphs.

Passages are copied into the middle of lines too, so a paragraph here is a short run
of words whose ends the words themselves decide: it ends with its line, behind a
word that ends a sentence, and behind a word whose hash is divisible by ``CUT``. A
copied passage is therefore cut alike wherever it stands, but for its two ends.

Equal paragraphs are one class by a 128-bit key. Paragraphs of ``BANDED_WORDS`` words
or more (shorter ones cannot be similar at 0.8 without being equal) get a MinHash
signature of their word 5-grams in ``BANDS`` bands of ``ROWS`` values; bands are tuned
for recall: 1 - (1 - 0.8^ROWS)^BANDS = 0.992 at the similarity 0.8 itself. Colliding
paragraphs are joined, exact Jaccard verifies them (``setlink``), and components join
classes. Of a class the occurrence in the document with the least identifier stays.

A repeated paragraph alone proves little: a common line or a licence line is no copied
passage. Repeated paragraphs are added up per (document, document they repeat, place
relative to it); a passage is reported if they have ``MIN_WORDS`` words or more in
common. Its two ends are cut differently, so it is longer than what is found of it.

Exact copies don't depend on paragraphs: every run of ``COPY_WORDS`` words that a
document of a lower identifier has is found by itself, to its first and last word and
across lines (``_copied_runs``). Nor do near copies of ``COPY_WORDS`` words or more:
every 25 words in a row are a paragraph with a band of its own (``near_copies``), colliding
ones are verified by exact Jaccard and reported from their first to their last common
word. Paragraphs inside such copies are not reported again.

Defined results: null, empty and one-line texts without repeats are left alone, and so
are rows without identifier and repeats within one document; repeated rows with
identifier and text alike are one document, an identifier's other texts are documents
of their own (of equal identifiers, the least hash of a text keeps a passage); an empty table gives no rows. ``drop_passages`` keeps
all columns and leaves out documents of which only white space remains.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import near_copies, setlink
from .common import (Rows, drop_table, few_files, files_for, in_small_batches, parts_for, read_table, release,
                     reliable_checkpoint, scratch_path, text_bytes)
from .frequent import texts_of, with_repeated
from .shingles import SPACES, gram_hashes, mix, slices

GRAM = 5
#: (1 + j) / (1 - j) for a similarity of j = 0.8.
FACTOR = 9
CUT = 16
LEAST_WORDS = 4
BANDED_WORDS = 8
BANDS, ROWS = 3, 1
MIN_WORDS = 24
#: Most words between two parts of one passage that can go with them.
BRIDGE_WORDS = 8
#: Words inserted or deleted between two parts of a near copy, and words between them, at most.
SHIFT_WORDS, GAP_WORDS = 8, 50
#: Words of the windows that find exact copies, and of the grams that stand for them.
COPY_WORDS, ANCHOR = 50, 16
#: Windows of larger tables are joined in so many rounds, to bound the disk of one exchange.
ROUNDS, ROUNDS_FROM = 4, 64 << 20
#: Bytes of text for each band record, and for each anchor, about.
BAND_BYTES, ANCHOR_BYTES = 30, 100

UNITS = "doc_id long, at long, words int, start long, length long, sid long, key long, grams int"
_SEEDS = [np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344), np.uint64(0x24093822299F31D0)]


class Units:
    """The paragraphs of some texts, one after the other: document number, place of
    the first word, words, first character, characters, key; and the words' hashes."""

    def __init__(self, texts: pa.Array):
        lower = pc.ascii_lower(pc.fill_null(texts, ""))
        lines = pc.split_pattern(lower, "\n")
        plain = lines.flatten()
        for space in SPACES.replace("\n", ""):
            plain = pc.replace_substring(plain, space, " ")
        chunks = pc.split_pattern(plain, " ")
        coded = chunks.flatten().dictionary_encode()
        dictionary = coded.dictionary
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in dictionary.to_numpy(zero_copy_only=False)),
                             np.uint64, len(dictionary))
        ending = pc.match_substring_regex(dictionary, r"[.!?]$").to_numpy(zero_copy_only=False).astype(bool)
        ending |= hashes % np.uint64(CUT) == 0
        chars = pc.utf8_length(dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
        index = coded.indices.to_numpy()
        per_line = pc.list_value_length(chunks).to_numpy(zero_copy_only=False)
        per_text = pc.list_value_length(lines).to_numpy(zero_copy_only=False)
        line = np.repeat(np.arange(len(per_line)), per_line)
        text = np.repeat(np.arange(len(per_text)), per_text)[line]
        size = chars[index]
        place = np.cumsum(size + 1) - size - 1
        first_of_text = np.searchsorted(text, np.arange(len(per_text)))
        place = place - place[np.minimum(first_of_text, len(place) - 1)][text]
        real = size > 0
        index, line, text, size, place = index[real], line[real], text[real], size[real], place[real]
        self.words = hashes[index]
        self.place, self.size = place, size
        n = len(index)
        last = np.append(line[1:] != line[:-1], True) if n else np.zeros(0, bool)
        stop = np.flatnonzero(last | ending[index])
        self.first = np.concatenate(([0], stop[:-1] + 1)).astype(np.int64) if n else np.zeros(0, np.int64)
        self.count = stop - self.first + 1
        self.text = text[self.first]
        self.base = np.searchsorted(text, np.arange(len(per_text) + 1))
        self.at = self.first - self.base[self.text] if n else self.first
        self.start = place[self.first]
        self.length = place[stop] + size[stop] - self.start
        within = np.arange(n) - np.repeat(self.first, self.count)
        spread = self.words * np.uint64(0x9E3779B97F4A7C15) + (within + 1).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        halves = [np.add.reduceat(mix(spread ^ seed), self.first) if n else np.zeros(0, np.uint64)
                  for seed in _SEEDS[:2]]
        self.keys = np.stack(halves, axis=1).astype("<u8")

    def grams(self, unit: int) -> np.ndarray:
        a = self.first[unit]
        return np.unique(gram_hashes(self.words[a:a + self.count[unit]], GRAM))

    def long_grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Paragraphs long enough for bands, their grams, and where each one's grams end."""
        long = np.flatnonzero(self.count >= BANDED_WORDS)
        if not len(long):
            return long, np.zeros(0, np.uint64), long
        every = gram_hashes(self.words, GRAM)
        runs = self.count[long] - GRAM + 1
        ends = np.cumsum(runs)
        return long, every[np.repeat(self.first[long] - (ends - runs), runs) + np.arange(ends[-1])], ends

    def distinct(self) -> np.ndarray:
        """How many distinct grams a paragraph has; exact for those that get bands."""
        counts = np.maximum(self.count - GRAM + 1, 1)
        long, grams, ends = self.long_grams()
        if len(long):
            owner = np.repeat(np.arange(len(long)), np.diff(ends, prepend=0))
            order = np.lexsort((grams, owner))
            grams = grams[order]
            again = (grams[1:] == grams[:-1]) & (owner[1:] == owner[:-1])
            counts[long] -= np.bincount(owner[1:][again], minlength=len(long))
        return counts

    def signatures(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Paragraphs long enough for bands, and the bands' values."""
        long, grams, ends = self.long_grams()
        if not len(long):
            return long, [np.zeros(0, np.int64)] * BANDS
        starts = np.append(0, ends[:-1])
        return long, [np.minimum.reduceat(mix(grams ^ seed), starts).view(np.int64) * BANDS + k
                      for k, seed in enumerate(_SEEDS)]


class Windows:
    """All windows of ``COPY_WORDS`` words of some texts: text, first word (of all),
    hash, and anchor, the least gram hash in the window. Equal windows have equal anchors."""

    def __init__(self, texts: pa.Array):
        self.units = units = Units(texts)
        starts = [np.arange(a, b - COPY_WORDS + 1) for a, b in zip(units.base[:-1].tolist(), units.base[1:].tolist())]
        self.first = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.text = np.repeat(np.arange(len(starts)), [len(x) for x in starts])
        if not len(self.first):
            self.hash = self.anchor = np.zeros(0, np.int64)
            return
        # a window is 32 words and 32 words, a gram is 16: by doubling, order counts
        runs, width = mix(units.words), 1
        while width < 32:
            runs = mix(runs[:-width] * np.uint64(0x9E3779B97F4A7C15) + (runs[width:] ^ _SEEDS[0]))
            width *= 2
            if width == ANCHOR:
                least = mix(runs ^ _SEEDS[1])
        self.hash = mix(runs[self.first] * np.uint64(0xC2B2AE3D27D4EB4F)
                        + (runs[self.first + COPY_WORDS - 32] ^ _SEEDS[2])).view(np.int64)
        reach, span = COPY_WORDS - ANCHOR + 1, 1
        while 2 * span <= reach:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        self.anchor = np.minimum(least[self.first], least[self.first + reach - span]).view(np.int64)


def _anchors(docs: DataFrame) -> DataFrame:
    """(anchor, doc_id, at): the distinct anchors of each text's windows, at -1, and
    the seeds of near copies with their places."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                windows = Windows(part.column(1))
                ids = part.column(0).to_numpy(zero_copy_only=False)
                change = np.ones(len(windows.first), bool)
                change[1:] = (windows.anchor[1:] != windows.anchor[:-1]) | (windows.text[1:] != windows.text[:-1])
                anchors, base = windows.anchor[change], windows.units.base
                place, seeds = near_copies.seeds(windows.units.words, base)
                text = np.searchsorted(base, place, "right") - 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate((anchors, seeds))),
                    pa.array(ids[np.concatenate((windows.text[change], text))], pa.int64()),
                    pa.array(np.concatenate((np.full(len(anchors), -1), place - base[text])), pa.int64())],
                    ["anchor", "doc_id", "at"])

    return docs.mapInArrow(run, "anchor long, doc_id long, at long")


COPIES = "doc_id long, at int, start int, stop int, keep_doc_id long, keep_at int"
WINDOWS = "hash long, anchor long, doc_id long, at int, start int, stop int"


def _windows(docs: DataFrame) -> DataFrame:
    """The windows with wanted anchors: documents (doc_id, text, wanted: [anchor])."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                windows = Windows(part.column(1))
                units, wanted = windows.units, part.column(2)
                bounds = np.searchsorted(windows.text, np.arange(part.num_rows + 1))
                chosen = np.zeros(len(windows.first), bool)
                for t, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    chosen[a:b] = np.isin(windows.anchor[a:b], wanted[t].values.to_numpy())
                first, text = windows.first[chosen], windows.text[chosen]
                last = first + COPY_WORDS - 1
                ids = part.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([
                    pa.array(windows.hash[chosen]), pa.array(windows.anchor[chosen]), pa.array(ids[text], pa.int64()),
                    pa.array(first - units.base[text], pa.int32()), pa.array(units.place[first], pa.int32()),
                    pa.array(units.place[last] + units.size[last], pa.int32())], [f.split()[0] for f in WINDOWS.split(", ")])

    return docs.select("doc_id", "text", "wanted").mapInArrow(run, WINDOWS)


def _copied_runs(texts: DataFrame, base: str, rounds: int = 1) -> DataFrame:
    """Exact copies of ``COPY_WORDS`` words or more to their last word: each run of
    windows that stand in a document of a lower identifier, and the least such
    document of each window. Windows are compared whole, so it doesn't matter in
    which other documents their parts occur; no pairs of documents are formed."""
    spark = texts.sparkSession
    _anchors(texts).write.option("compression", "zstd").parquet(f"{base}/anchors")
    anchors = reliable_checkpoint(with_repeated(
        spark.read.parquet(f"{base}/anchors").filter("at < 0").select("anchor", "doc_id"), "anchor",
        text_bytes(texts) // ANCHOR_BYTES))
    repeated = (anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                .filter("a < b").select("anchor"))
    wanted = reliable_checkpoint(
        anchors.join(repeated, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("wanted")))
    release(spark)
    (_windows(few_files(texts_of(texts, wanted))).withColumn("round", F.pmod(F.xxhash64("hash", "anchor"), F.lit(rounds)).cast("int"))
     .write.partitionBy("round").option("compression", "zstd").parquet(f"{base}/windows"))
    release(spark)
    for k in range(rounds):
        windows = (spark.read.schema(f"{WINDOWS}, round int").parquet(f"{base}/windows").filter(F.col("round") == k))
        (few_files(windows.groupBy("hash", "anchor")
                   .agg(F.min(F.struct("doc_id", "at")).alias("first"), F.max("doc_id").alias("last"))
                   .filter("first.doc_id < last").select("hash", "anchor", "first"))
         .write.option("compression", "zstd").parquet(f"{base}/classes_{k}"))
        release(spark)
        (few_files(windows.join(spark.read.parquet(f"{base}/classes_{k}"), ["hash", "anchor"]).filter("first.doc_id < doc_id")
                   .select("doc_id", "at", "start", "stop", F.col("first.doc_id").alias("keep_doc_id"),
                           F.col("first.at").alias("keep_at")))
         .write.mode("append").option("compression", "zstd").parquet(f"{base}/copies"))
        drop_table(spark, f"{base}/classes_{k}")
        drop_table(spark, f"{base}/windows/round={k}")
        release(spark)
    # one exchange by document serves the three steps
    found = spark.read.schema(COPIES).parquet(f"{base}/copies").repartition("doc_id").dropDuplicates(["doc_id", "at"])
    place = F.row_number().over(Window.partitionBy("doc_id", "keep_doc_id").orderBy("at"))
    runs = reliable_checkpoint(
        found.withColumn("run", F.col("at") - place).groupBy("doc_id", "keep_doc_id", "run").agg(
            F.min("at").cast("long").alias("at"), (F.max("at") - F.min("at") + COPY_WORDS).cast("int").alias("words"),
            F.min("start").cast("long").alias("start"), (F.max("stop") - F.min("start")).cast("long").alias("length"),
            F.min(F.struct("at", "keep_at")).getField("keep_at").cast("long").alias("keep_at")).drop("run"))
    drop_table(spark, f"{base}/windows")
    drop_table(spark, f"{base}/copies")
    release(spark)
    return runs


def _units(docs: DataFrame) -> DataFrame:
    """The paragraphs; (sid, key) are the two halves of their 128-bit keys."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                units = Units(part.column(1))
                chosen = np.flatnonzero(units.count >= LEAST_WORDS)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[units.text[chosen]], pa.int64()), pa.array(units.at[chosen], pa.int64()),
                    pa.array(units.count[chosen], pa.int32()), pa.array(units.start[chosen], pa.int64()),
                    pa.array(units.length[chosen], pa.int64()), pa.array(units.keys[chosen, 0].view("<i8")),
                    pa.array(units.keys[chosen, 1].view("<i8")), pa.array(units.distinct()[chosen], pa.int32())],
                    [f.split()[0] for f in UNITS.split(", ")])

    return docs.mapInArrow(run, UNITS)


def _bands(docs: DataFrame) -> DataFrame:
    """(token, sid): a record for each band of each long paragraph."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                units = Units(part.column(1))
                long, values = units.signatures()
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(values)), pa.array(np.tile(units.keys[long, 0].view("<i8"), BANDS))],
                    ["token", "sid"])

    return docs.mapInArrow(run, "token long, sid long")


SETS = "sid long, key binary, n int, codes binary, large int"


def _sets(docs: DataFrame) -> DataFrame:
    """Gram sets of the wanted paragraphs: documents (doc_id, text, wanted: [sid], large)."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                units, rows = Units(part.column(1)), []
                wanted = [set(w) for w in part.column(2).to_pylist()]
                large = part.column(3).to_pylist()
                raw = units.keys.tobytes()
                for u, (t, sid) in enumerate(zip(units.text.tolist(), units.keys[:, 0].view("<i8").tolist())):
                    if sid in wanted[t]:
                        wanted[t].discard(sid)
                        grams = units.grams(u)
                        rows.append((sid, raw[16 * u:16 * u + 16], len(grams), grams.astype("<u8").tobytes(), large[t]))
                if rows:
                    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     [f.split()[0] for f in SETS.split(", ")])

    return docs.select("doc_id", "text", "wanted", "large").mapInArrow(run, SETS)


@in_small_batches
def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """The paragraphs of copied passages, of texts that have identifiers of their own: doc_id, at, words, start, length,
    keep_doc_id, keep_at, and passage_words (all that the passage has in common);
    with copy_at, an exact copy to its first and last word."""
    spark = docs.sparkSession
    size = text_bytes(docs, text_col)
    files_for(spark, size)
    parts = parts_for(spark, size)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter(
        "doc_id IS NOT NULL")
    base = scratch_path(spark, f"paragraphs-{uuid.uuid4().hex}")
    runs = _copied_runs(texts, base, ROUNDS if size > ROUNDS_FROM else 1)
    seeds = spark.read.parquet(f"{base}/anchors").filter("at >= 0").select(F.col("anchor").alias("token"), "doc_id", "at")
    runs = runs.unionByName(near_copies.near_copies(texts, seeds, runs, size, base, Units))
    drop_table(spark, f"{base}/anchors")
    _units(texts).write.option("compression", "zstd").parquet(f"{base}/units")
    units = spark.read.parquet(f"{base}/units")
    (few_files(units.groupBy("sid", "key").agg(F.min(F.struct("doc_id", "at")).alias("first"),
                                               F.max("doc_id").alias("last"), F.min("grams").alias("grams")))
     .write.option("compression", "zstd").parquet(f"{base}/classes"))
    release(spark)
    classes = spark.read.parquet(f"{base}/classes")

    _bands(texts).write.option("compression", "zstd").parquet(f"{base}/bands")
    bands = reliable_checkpoint(with_repeated(spark.read.parquet(f"{base}/bands"), "token", size // BAND_BYTES))
    drop_table(spark, f"{base}/bands")
    members = reliable_checkpoint(setlink.worth_joining(
        reliable_checkpoint(setlink.blocks_of(reliable_checkpoint(setlink.members_of(bands)))),
        classes.select("sid", F.col("grams").alias("n")), FACTOR))
    del bands
    release(spark)
    in_large = members.groupBy("sid").agg((F.max("m") > setlink.SMALL).cast("int").alias("large"))
    wanted = reliable_checkpoint(classes.join(in_large, "sid").groupBy(F.col("first.doc_id").alias("doc_id"))
                                 .agg(F.collect_set("sid").alias("wanted"), F.max("large").alias("large")))
    found = few_files(texts_of(texts, wanted))
    _sets(found).write.partitionBy("large").parquet(f"{base}/sets")
    release(spark)
    setlink.links_of(members, spark.read.schema(SETS).parquet(f"{base}/sets"), FACTOR, parts).write.parquet(f"{base}/links")
    half = [F.expr(f"aggregate(sequence({i}, {i + 7}), 0L, (x, i) -> x | shiftleft("
                   f"cast(conv(hex(substring(node, i + 1, 1)), 16, 10) as long), 8 * (i - {i})))") for i in (0, 8)]
    tree = setlink.components(spark.read.parquet(f"{base}/links")).select(
        half[0].alias("sid"), half[1].alias("key"), "root")
    joined = reliable_checkpoint(classes.join(tree, ["sid", "key"]).select("sid", "key", "root", "first", "last"))
    near = (joined.groupBy("root").agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .join(joined.select("root", "sid", "key"), "root").select("sid", "key", "first", "last"))
    exact = classes.filter("first.doc_id < last").join(joined.select("sid", "key"), ["sid", "key"], "left_anti")
    kept = reliable_checkpoint(exact.select("sid", "key", "first", "last").unionByName(near)
                               .filter("first.doc_id < last").select("sid", "key", "first"))
    drop_table(spark, f"{base}/classes")
    release(spark)

    again = (units.join(kept, ["sid", "key"])
             .filter("first.doc_id < doc_id").dropDuplicates(["doc_id", "at"])
             .select("doc_id", "at", "words", "start", "length", F.col("first.doc_id").alias("keep_doc_id"),
                     F.col("first.at").alias("keep_at"), (F.col("at") - F.col("first.at")).alias("shift")))
    again = reliable_checkpoint(again)
    drop_table(spark, base)
    release(spark)
    # Words add up over one shift, and over neighbours whose shifts differ by a few words.
    in_order = Window.partitionBy("doc_id", "keep_doc_id").orderBy("at")
    breaks = ((F.abs(F.col("shift") - F.lag("shift").over(in_order)) > SHIFT_WORDS)
              | (F.col("at") - F.lag(F.col("at") + F.col("words")).over(in_order) > GAP_WORDS))
    near = (again.withColumn("breaks", F.coalesce(breaks.cast("int"), F.lit(0)))
            .withColumn("chain", F.sum("breaks").over(in_order))
            .withColumn("passage_words", F.greatest(
                F.sum("words").over(Window.partitionBy("doc_id", "keep_doc_id", "shift")),
                F.sum("words").over(Window.partitionBy("doc_id", "keep_doc_id", "chain"))))
            .filter(F.col("passage_words") >= min_words).drop("breaks", "chain"))
    spans = runs.groupBy("doc_id").agg(F.collect_list(F.struct("at", (F.col("at") + F.col("words")).alias("end"))).alias("runs"))
    near = (near.join(spans, "doc_id", "left")
            .filter("NOT coalesce(exists(runs, r -> r.at <= at AND at + words <= r.end), false)").drop("runs"))
    return near.withColumn("copy_at", F.lit(None).cast("long")).unionByName(
        runs.withColumn("shift", F.col("at") - F.col("keep_at"))
        .withColumn("passage_words", F.col("words").cast("long")).withColumn("copy_at", F.col("at")))


def whole_spans(spans: list) -> list[tuple[int, int]]:
    """First and end character of what goes from one text. Parts of one passage (same
    keeper, same shift) that touch are one block; the words between two blocks go too
    if the blocks with these words are similar at 0.8 to the same place in the keeper,
    even if none of the words between is."""
    out, blocks = [], []
    for s in sorted(spans, key=lambda s: (s["keep_doc_id"], s["shift"], s["at"])):
        passage, at, end = (s["keep_doc_id"], s["shift"]), s["at"], s["at"] + s["words"]
        if blocks and blocks[-1][0] == passage and at <= blocks[-1][2]:
            if end > blocks[-1][2]:
                blocks[-1][2], blocks[-1][4] = end, s["start"] + s["length"]
        else:
            blocks.append([passage, at, end, s["start"], s["start"] + s["length"]])
    for k, (passage, at, end, first, stop) in enumerate(blocks):
        out.append((first, stop))
        if k and blocks[k - 1][0] == passage and at - blocks[k - 1][2] <= BRIDGE_WORDS:
            before = blocks[k - 1]
            common = max(0, before[2] - before[1] - GRAM + 1) + max(0, end - at - GRAM + 1)
            if FACTOR * 2 * (end - before[1] - GRAM + 1 - common) <= 2 * (end - before[1] - GRAM + 1):
                out.append((before[4], first))
    return out


@in_small_batches
def drop_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without their copied passages, all columns as they were. Documents are
    rows told apart by identifier and text, so what is cut from one text never touches
    another one with the same identifier."""
    source = Rows(docs, id_col, text_col)
    held, key = "_spans" + source.key, "_of" + source.key
    spans = (repeated_units(source.docs, source.key, text_col).groupBy(F.col("doc_id").alias(key))
             .agg(F.collect_list(F.struct("keep_doc_id", "shift", "at", "words", "start", "length")).alias(held)))
    names = docs.columns
    column = names.index(text_col)
    rows = source.docs.join(spans, F.col(source.key) == F.col(key), "left").select(
        *[F.col(f"`{c}`") for c in names], F.col(held))

    def without(text, spans):
        out, done = [], 0
        for start, end in sorted(whole_spans(spans)):
            out.append(text[done:start])
            done = max(done, end)
        return "".join(out) + text[done:]

    def run(batches):
        for part in (part for batch in batches for part in slices(batch, column)):
            spans = part.column(len(names)).to_pylist()
            texts = part.column(column)
            new = [without(t.as_py(), s) if s and t.as_py() else t.as_py() for t, s in zip(texts, spans)]
            keep = [not s or bool((t or "").strip(" " + SPACES)) for t, s in zip(new, spans)]
            columns = [pa.array(new, texts.type) if i == column else part.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(
                [part.schema.field(i) for i in range(len(names))])).filter(pa.array(keep, pa.bool_()))

    return few_files(rows).mapInArrow(run, docs.schema)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """One row per copied passage: the document it is to be removed from, where,
    and the document that keeps it."""
    rows = Rows(read_table(spark, sf_dir, "documents"))
    units = repeated_units(rows.docs, rows.key)
    passages = units.groupBy("doc_id", "keep_doc_id", "shift", "copy_at").agg(
        F.min("at").alias("first_word"), F.max(F.col("at") + F.col("words")).alias("end_word"),
        F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("end"),
        F.max("passage_words").alias("repeated_words"), F.count("*").alias("paragraphs")).drop("shift", "copy_at")
    return rows.doc_ids(passages, ["doc_id", "keep_doc_id"])
