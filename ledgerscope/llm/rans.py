"""Token ids in files of range-asymmetric-numeral-system blocks.

Documents in identifier order are tokenized, and their ids written as a narrow
working table. One static frequency table over all ids of the corpus (an entry per
vocabulary id at most) is shared by all blocks. A block holds whole documents up to
about ``BLOCK_TOKENS`` ids. Its ids are cut into even segments; in a segment, id i
belongs to lane i mod ``LANES``, and the lanes are interleaved in one stream of
32-bit words. Every segment stores its lanes' states and stream length as a
checkpoint and a checksum of its ids, so blocks, and segments within them, decode
independently; all segments of a block are coded side by side as numpy vectors.

The files are Parquet rows of self-describing blocks: (part, at, doc_ids,
doc_tokens, n_tokens, table_crc, block). ``at`` counts the part's ids before the
block; the parts' totals give every document's place in the whole stream.

Defined results: a null or empty text is its end id alone; repeated rows are
documents of their own, next to each other; a null identifier comes first; an id
that the table lacks, a wrong checksum or a foreign table raises; an empty table
gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, in_id_order, read_table, scratch_path
from .tokens import chunk_tokenizer

END_ID = 1
BITS = 20
SLOTS = 1 << BITS
LOW = np.uint64(1 << 32)
LANES = 64
SEGMENT_TOKENS = 1 << 16
BLOCK_TOKENS = 1 << 20
MAGIC = b"RNS1"
HEAD = "<4sIIII"
OUT_BYTES = 8 << 20
WORK_NAMES = ("part", "at", "doc_id", "n_tokens", "width", "ids", "counts")
WORK_KINDS = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
WORK_SCHEMA = "part int, at long, doc_id long, n_tokens long, width int, ids binary, counts binary"


class FrequencyTable:
    """Static frequencies that sum to SLOTS - 1; every counted id has one at least."""

    def __init__(self, ids, counts):
        order = np.argsort(np.asarray(ids, np.int64))
        self.ids = np.asarray(ids, np.int64)[order].astype(np.uint32)
        counts = np.asarray(counts, np.float64)[order]
        room = SLOTS - 1
        if len(self.ids) > room:
            raise ValueError(f"{len(self.ids)} different ids, at most {room}")
        spare = room - len(self.ids)
        exact = counts / counts.sum() * spare
        freq = np.floor(exact).astype(np.int64)
        rest = spare - int(freq.sum())
        freq[np.argsort(freq - exact, kind="stable")[:rest]] += 1
        self.freq = (freq + 1).astype(np.uint64)
        self.first = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(np.uint64)
        self.crc = zlib.crc32(self.ids.tobytes() + self.freq.tobytes())
        self._slots = self._index = None

    def index(self, ids: np.ndarray) -> np.ndarray:
        if self._index is None:
            self._index = np.full(int(self.ids[-1]) + 1, -1, np.int32)
            self._index[self.ids] = np.arange(len(self.ids))
        if len(ids) and (ids.max() >= len(self._index) or (self._index[ids] < 0).any()):
            raise ValueError("an id is missing from the frequency table")
        return self._index[ids]

    def of_slot(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.zeros(SLOTS, np.int32)
            self._slots[:SLOTS - 1] = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq.astype(np.int64))
        return self._slots


def _shape(n: int) -> tuple[int, int, int]:
    """Segments, ids of a segment, steps of a lane."""
    segments = max(1, -(-n // SEGMENT_TOKENS))
    per = -(-n // segments)
    return segments, per, -(-per // LANES)


def encode_block(ids: np.ndarray, table: FrequencyTable) -> bytes:
    n = len(ids)
    segments, per, steps = _shape(n)
    common = int(np.argmax(table.freq))
    grid = np.full((segments, steps * LANES), common, np.int32)
    index = table.index(ids)
    for s in range(segments):
        own = index[s * per:(s + 1) * per]
        grid[s, :len(own)] = own
    grid = grid.reshape(segments, steps, LANES).transpose(1, 0, 2)  # step, segment, lane
    state = np.full((segments, LANES), LOW, np.uint64)
    words = np.zeros((steps, segments, LANES), np.uint32)
    sent = np.zeros((steps, segments, LANES), bool)
    for t in range(steps - 1, -1, -1):
        f, c = table.freq[grid[t]], table.first[grid[t]]
        full = state >= f << np.uint64(64 - BITS)
        words[t], sent[t] = state, full  # the low 32 bits
        state = np.where(full, state >> np.uint64(32), state)
        q = state // f
        state = (q << np.uint64(BITS)) + (state - q * f) + c
    out = [struct.pack(HEAD, MAGIC, n, segments, LANES, table.crc)]
    streams = []
    for s in range(segments):
        stream = words[:, s][sent[:, s]].astype("<u4").tobytes()
        own = ids[s * per:(s + 1) * per].astype("<u4").tobytes()
        out.append(struct.pack("<II", len(stream) // 4, zlib.crc32(own)) + state[s].astype("<u8").tobytes())
        streams.append(stream)
    return b"".join(out + streams)


def decode_block(block: bytes, table: FrequencyTable) -> np.ndarray:
    magic, n, segments, lanes, crc = struct.unpack_from(HEAD, block)
    if magic != MAGIC or crc != table.crc:
        raise ValueError("not a block of this table")
    segments_, per, steps = _shape(n)
    at = struct.calcsize(HEAD)
    state, lengths, checks = np.empty((segments, lanes), np.uint64), [], []
    for s in range(segments):
        length, check = struct.unpack_from("<II", block, at)
        state[s] = np.frombuffer(block, "<u8", lanes, at + 8)
        lengths.append(length)
        checks.append(check)
        at += 8 + 8 * lanes
    stream = np.append(np.frombuffer(block, "<u4", sum(lengths), at), np.uint32(0))
    place = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)[:, None]
    out = np.empty((steps, segments, lanes), np.int32)
    slots, mask = table.of_slot(), np.uint64(SLOTS - 1)
    for t in range(steps):
        slot = state & mask
        symbol = slots[slot.astype(np.int64)]
        out[t] = symbol
        state = table.freq[symbol] * (state >> np.uint64(BITS)) + slot - table.first[symbol]
        need = state < LOW
        taken = np.cumsum(need, axis=1)
        word = stream[np.where(need, place + taken - 1, len(stream) - 1)]
        state = np.where(need, (state << np.uint64(32)) | word, state)
        place = place + taken[:, -1:]
    flat = table.ids[out.transpose(1, 0, 2).reshape(segments, steps * lanes)]
    pieces = []
    for s in range(segments):
        own = flat[s, :max(0, min(per, n - s * per))].astype("<u4")
        if zlib.crc32(own.tobytes()) != checks[s]:
            raise ValueError(f"segment {s} is damaged")
        pieces.append(own)
    return np.concatenate(pieces) if pieces else np.zeros(0, "<u4")


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Rows in identifier order within each part: part, at (ids of the part
    before), doc_id, n_tokens, ids (little-endian unsigned 16 bit where all ids
    fit, else 32); and for each part a row with how often it has each id."""

    def run(batches):
        tokenizer = chunk_tokenizer(tokenizer_path, 2)
        if tokenizer.tokenizer.get_vocab_size() > 1 << 16:
            tokenizer = chunk_tokenizer(tokenizer_path, 4)
        kind = tokenizer.type
        width = np.dtype(kind).itemsize
        close = np.array([end_id], kind).tobytes()
        part, at = TaskContext.get().partitionId(), 0
        rows, size, total = [], 0, np.zeros(tokenizer.tokenizer.get_vocab_size(), np.int64)

        def packed():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), WORK_KINDS)], list(WORK_NAMES))

        def counted():
            own = np.bincount(np.frombuffer(b"".join([r[5] for r in rows]), kind), minlength=len(total))
            own[:len(total)] += total
            return own

        for key, ids in tokenizer.documents(batches):
            rows.append((part, at, key, len(ids) + 1, width, ids.tobytes() + close, None))
            at += len(ids) + 1
            size += ids.nbytes
            if size >= OUT_BYTES:
                total = counted()
                yield packed()
                rows, size = [], 0
        if rows:
            total = counted()
            yield packed()
        rows = [(part, at, None, 0, 0, None, total.astype("<i8").tobytes())]
        yield packed()

    return in_id_order(docs, id_col, text_col).mapInArrow(run, WORK_SCHEMA)


def count_ids(counts: DataFrame) -> DataFrame:
    """(id, n) from the parts' dense counts, summed in the task first."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                own = np.frombuffer(raw.as_py(), "<i8")
                total = own + (total if len(total) else 0)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])

    return counts.select("counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``path``/blocks, ``path``/table and ``path``/parts."""
    spark = docs.sparkSession
    work = f"{path}/ids"
    (tokenized(docs, tokenizer_path, end_id, id_col, text_col)
     .write.option("compression", "zstd").parquet(work))
    rows = spark.read.parquet(work).filter("counts IS NULL")
    counts = spark.read.parquet(work).filter("counts IS NOT NULL")
    count_ids(counts).coalesce(1).write.parquet(f"{path}/table")  # one row per vocabulary id at most
    counts.select("part", F.col("at").alias("n")).coalesce(1).write.parquet(f"{path}/parts")
    counted = spark.read.parquet(f"{path}/table").collect()
    ids, counts = [r["id"] for r in counted], [r["n"] for r in counted]

    def run(batches):
        table = FrequencyTable(ids, counts) if ids else None
        held, size, here = [], 0, None

        def block():
            all_ids = np.concatenate([np.frombuffer(x[4], f"<u{x[3]}").astype(np.uint32) for x in held])
            return pa.RecordBatch.from_arrays([
                pa.array([held[0][0]], pa.int32()), pa.array([held[0][1]], pa.int64()),
                pa.array([[x[2] for x in held]], pa.list_(pa.int64())),
                pa.array([[x[5] for x in held]], pa.list_(pa.int64())),
                pa.array([len(all_ids)], pa.int64()), pa.array([table.crc], pa.int64()),
                pa.array([encode_block(all_ids, table)], pa.binary())],
                ["part", "at", "doc_ids", "doc_tokens", "n_tokens", "table_crc", "block"])

        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(6))):
                row = [x.as_py() for x in row]
                if held and (size >= BLOCK_TOKENS or here != (row[0], row[1])):
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += row[5]
                here = (row[0], row[1] + row[5])
        if held:
            yield block()

    (rows.select("part", "at", "doc_id", "width", "ids", "n_tokens")
     .mapInArrow(run, "part int, at long, doc_ids array<long>, doc_tokens array<long>, n_tokens long, "
                      "table_crc long, block binary")
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))
    drop_table(spark, work)


def read_files(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files: start is its
    place in the whole stream, ids are little-endian unsigned 32 bit."""
    counted = spark.read.parquet(f"{path}/table").collect()
    ids, counts = [r["id"] for r in counted], [r["n"] for r in counted]

    def run(batches):
        table = FrequencyTable(ids, counts) if ids else None
        for batch in batches:
            for part, at, keys, sizes, block in zip(*(batch.column(i) for i in range(5))):
                all_ids = decode_block(block.as_py(), table)
                keys, sizes = keys.as_py(), sizes.as_py()
                ends = np.cumsum(sizes)
                starts = ends - sizes
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.as_py()] * len(keys), pa.int32()),
                    pa.array(starts + at.as_py(), pa.int64()), pa.array(keys, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([all_ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())],
                    ["part", "at", "doc_id", "n_tokens", "ids"])

    parts = spark.read.parquet(f"{path}/parts")  # one row per task that wrote
    base = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    rows = (spark.read.parquet(f"{path}/blocks").select("part", "at", "doc_ids", "doc_tokens", "block")
            .mapInArrow(run, "part int, at long, doc_id long, n_tokens long, ids binary"))
    return rows.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def op10_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
    write_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
