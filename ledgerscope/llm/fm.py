"""Quality classifier: a factorisation machine.

Features of a whole text: hashed words (square roots of counts, the document's
vector scaled to length one), statistics of its structure, and metadata (n_chars).
A factorisation machine adds to the linear score the products of all pairs of
features, weighted by the inner products of low-rank vectors; the identity
``sum of pairs = (square of the sum - sum of the squares) / 2`` scores a document in
time linear in its distinct words.

The model is fitted on at most ``LABELLED_ROWS`` labelled documents (those whose
identifiers have the smallest hashes, among identifiers whose CRC-32 mod 4 is not
2), and every document of the table is scored by it, some megabytes at a time as
numpy vectors. Labels, language, source and identifier are no inputs of a score.

Defined results: null and empty texts are scored by their statistics; without any
labelled document every score is 0.5, with one class only it is near that class;
repeated rows get equal scores; an empty table gives no rows. Columns other than
identifier, text and n_chars are ignored, a missing or null n_chars is the text's length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table

LABELLED_ROWS = 3000
BUCKETS = 1 << 15
RANK = 8
STEPS = 600
RATE = 0.05
BATCH = 64
DECAY = 1e-5
SEED = 7
SLICE_BYTES = 8 << 20
KEEP = 0.7

STATISTICS = ("log_words", "word_length", "symbols", "upper", "digits", "marks", "shouts", "letters",
              "repeated_words", "repeated_lines", "line_words", "log_chars")


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros((1,) + values.shape[1:]), np.cumsum(values, axis=0, dtype=np.float64)))
    return total[ends] - total[np.concatenate(([0], ends[:-1]))]


def _distinct(codes: np.ndarray, ends: np.ndarray, width: int):
    """Per document: its distinct codes, how often each, and where a document's end."""
    doc = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], ends))))
    key, count = np.unique(doc * width + codes, return_counts=True)
    return key % width, count, np.searchsorted(key, (np.arange(len(ends)) + 1) * width)


def featurize(texts: pa.Array, n_chars: np.ndarray):
    """(buckets, values, ends, statistics): sparse words of all texts one after the
    other, where each text's end, and a row of statistics for each."""
    texts = pc.fill_null(texts, "")
    lines = pc.split_pattern(texts, "\n")
    line_ends = np.cumsum(pc.list_value_length(lines).to_numpy(zero_copy_only=False)).astype(np.int64)
    line_codes = lines.flatten().dictionary_encode()
    _, times, distinct_ends = _distinct(line_codes.indices.to_numpy(), line_ends, max(1, len(line_codes.dictionary)))
    n_lines = np.diff(np.concatenate(([0], line_ends)))
    distinct_lines = np.diff(np.concatenate(([0], distinct_ends)))

    chunks = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    ends = np.cumsum(pc.list_value_length(chunks).to_numpy(zero_copy_only=False)).astype(np.int64)
    coded = chunks.flatten().dictionary_encode()
    words, index = coded.dictionary, coded.indices.to_numpy()

    def per_word(pattern):
        return pc.count_substring_regex(words, pattern).to_numpy(zero_copy_only=False).astype(np.float64)

    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.float64)
    table = np.stack([(length > 0).astype(np.float64), length, per_word(r"[#*$%&|<>]"), per_word(r"\p{Lu}"),
                      per_word(r"\p{Nd}"), per_word(r"[.,;:!?]"), per_word(r"!!|\?\?"), per_word(r"\p{L}")], axis=1)
    total = _sums(table[index], ends)
    n, chars = np.maximum(total[:, 0], 1), np.maximum(total[:, 1], 1)
    bucket = np.fromiter((zlib.crc32(w.encode()) % BUCKETS for w in words.to_numpy(zero_copy_only=False)),
                         np.int64, len(words))
    buckets, count, word_ends = _distinct(bucket[index], ends, BUCKETS)
    distinct_words = np.diff(np.concatenate(([0], word_ends)))
    value = np.sqrt(count)
    norm = np.sqrt(_sums(value ** 2, word_ends))
    value = value / np.repeat(np.maximum(norm, 1e-9), distinct_words)
    stats = np.stack([np.log1p(total[:, 0]), chars / n, total[:, 2] / n, total[:, 3] / chars, total[:, 4] / chars,
                      total[:, 5] / n, total[:, 6] / n, total[:, 7] / chars, 1 - distinct_words / (n + 1),
                      1 - distinct_lines / np.maximum(n_lines, 1), n / np.maximum(n_lines, 1),
                      np.log1p(n_chars)], axis=1)
    stats[:, 10] = np.log1p(stats[:, 10])
    return buckets, value, word_ends, stats


class FactorisationMachine:
    def __init__(self, mean, spread, bias, linear, factors):
        self.mean, self.spread, self.bias, self.linear, self.factors = mean, spread, bias, linear, factors

    def rows(self, buckets, values, ends, stats):
        """Words and standardised statistics as one sparse matrix."""
        n, k = len(ends), stats.shape[1]
        begins = np.concatenate(([0], ends[:-1]))
        at = np.repeat(ends, k)  # each document's statistics go behind its words
        dense = np.clip((stats - self.mean) / self.spread, -5, 5) * 0.3
        idx = np.insert(buckets, at, np.tile(np.arange(BUCKETS, BUCKETS + k), n))
        val = np.insert(values, at, dense.ravel())
        return idx, val, begins + np.arange(n) * k, ends + (np.arange(n) + 1) * k

    def margin(self, idx, val, ends):
        vx = self.factors[idx] * val[:, None]
        s = _sums(vx, ends)
        return self.bias + _sums(self.linear[idx] * val, ends) + 0.5 * (s ** 2 - _sums(vx ** 2, ends)).sum(1), s

    def score(self, buckets, values, ends, stats):
        idx, val, _, ends = self.rows(buckets, values, ends, stats)
        return 1 / (1 + np.exp(-np.clip(self.margin(idx, val, ends)[0], -30, 30)))

    @classmethod
    def fit(cls, parts, labels: np.ndarray) -> FactorisationMachine:
        """Stochastic gradients of the log loss with per-weight step sizes (Adagrad)."""
        buckets, values, ends, stats = parts
        rnd = np.random.default_rng(SEED)
        size = BUCKETS + stats.shape[1]
        share = np.clip(labels.mean(), 0.02, 0.98)
        fm = cls(stats.mean(0), stats.std(0) + 1e-3, float(np.log(share / (1 - share))),
                 np.zeros(size), rnd.normal(0, 0.01, (size, RANK)))
        idx, val, begins, ends = fm.rows(buckets, values, ends, stats)
        seen_w, seen_v, seen_b = np.full(size, 1e-2), np.full((size, RANK), 1e-2), 1e-2
        batches = max(1, len(labels) // BATCH)
        for _ in range(-(-STEPS // batches)):
            for batch in np.array_split(rnd.permutation(len(labels)), batches):
                where = np.concatenate([np.arange(begins[d], ends[d]) for d in batch])
                i, x = idx[where], val[where]
                e = np.cumsum(ends[batch] - begins[batch])
                margin, s = fm.margin(i, x, e)
                slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[batch]) / len(batch)
                row = np.repeat(np.arange(len(batch)), ends[batch] - begins[batch])
                used, back = np.unique(i, return_inverse=True)
                gx = slope[row] * x
                gw = np.bincount(back, gx, len(used)) + DECAY * fm.linear[used]
                gv = np.stack([np.bincount(back, gx * (s[row, f] - fm.factors[i, f] * x), len(used))
                               for f in range(RANK)], axis=1) + DECAY * fm.factors[used]
                seen_w[used] += gw ** 2
                seen_v[used] += gv ** 2
                seen_b += slope.sum() ** 2
                fm.linear[used] -= RATE * gw / np.sqrt(seen_w[used])
                fm.factors[used] -= RATE * gv / np.sqrt(seen_v[used])
                fm.bias -= RATE * slope.sum() / np.sqrt(seen_b)
        return fm


def _slices(batch, slice_bytes=SLICE_BYTES):
    """Parts of a batch (id, text, n_chars) of some megabytes of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(sizes[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, before + slice_bytes, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _inputs(docs: DataFrame, id_col: str, text_col: str) -> list:
    length = F.coalesce(F.length(text_col), F.lit(0)).cast("long")
    chars = F.coalesce(F.col("n_chars").cast("long"), length) if "n_chars" in docs.columns else length
    return [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), chars.alias("n_chars")]


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = LABELLED_ROWS,
                id_col: str = "doc_id", text_col: str = "text") -> FactorisationMachine | None:
    """Fit on at most ``rows`` labelled documents, None without any."""
    chosen = (labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("double").alias("_y"))
              .filter("_y IS NOT NULL AND _id IS NOT NULL").filter(~held_out("_id"))
              .orderBy(F.xxhash64("_id"), "_id", "_y").limit(rows))
    sample = docs.select(*_inputs(docs, id_col, text_col)).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))

    def run(batches):
        for batch in batches:
            for part in _slices(batch):
                buckets, values, ends, stats = featurize(part.column(1), part.column(2).to_numpy(zero_copy_only=False))
                begins = np.concatenate(([0], ends[:-1]))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(3),
                    pa.array([buckets[a:b].astype("<u2").tobytes() for a, b in zip(begins, ends)], pa.binary()),
                    pa.array([values[a:b].astype("<f4").tobytes() for a, b in zip(begins, ends)], pa.binary()),
                    pa.array([r.astype("<f8").tobytes() for r in stats], pa.binary())],
                    ["doc_id", "y", "buckets", "vals", "stats"])

    got = (sample.select("doc_id", "text", "n_chars", "_y")
           .mapInArrow(run, "doc_id long, y double, buckets binary, vals binary, stats binary")
           .orderBy("doc_id", "y").limit(rows).collect())  # <= rows documents' features
    if not got:
        return None
    buckets = [np.frombuffer(r.buckets, "<u2").astype(np.int64) for r in got]
    parts = (np.concatenate(buckets), np.concatenate([np.frombuffer(r.vals, "<f4") for r in got]).astype(np.float64),
             np.cumsum([len(b) for b in buckets]), np.stack([np.frombuffer(r.stats, "<f8") for r in got]))
    return FactorisationMachine.fit(parts, np.array([r.y for r in got]))


def score_documents(docs: DataFrame, model: FactorisationMachine | None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches):
        for batch in batches:
            for part in _slices(batch):
                if model is None:
                    score = np.full(part.num_rows, 0.5)
                else:
                    score = model.score(*featurize(part.column(1), part.column(2).to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    return docs.select(*_inputs(docs, id_col, text_col)).mapInArrow(run, "doc_id long, score double")


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))
