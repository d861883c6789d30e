"""Order-preserving packing of documents into training sequences.

Documents, in identifier order, form one stream of tokens, each document closed by
an end id. Dynamic programming chooses where to cut the stream into windows of at
most ``window`` tokens: candidates are document ends, sentence ends, and, where
neither comes for ``HARD_GAP`` tokens, a place in between. A window costs its
padding, and a cut inside a document its penalty. As the padding is linear in the
window's length, the best predecessor of a cut is a sliding minimum, kept in a
monotone queue: constant work per candidate.

The stream is dealt to tasks by identifier ranges of bounded bytes; a task plans
``PLAN_TOKENS`` at a time and plans a plan's last window again with what follows,
so memory is bounded and only a task's last window is padded without need.

Defined results: a null or empty text is its end id alone; a document longer than a
window is cut at sentence ends; each id lies in exactly one piece; repeated rows are
documents of their own; a null identifier comes first; an empty table gives no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_id_order, read_table
from .tokens import chunk_tokenizer

WINDOW = 2048
END_ID = 1
SENTENCE_PENALTY = 1
HARD_PENALTY = 8
HARD_GAP = 32
PLAN_TOKENS = 1 << 20
OUT_BYTES = 8 << 20

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, tokens_in_sequence long")


def sentence_ends(tokenizer) -> np.ndarray:
    """By id: whether the token ends a sentence."""
    vocab = tokenizer.get_vocab()
    out = np.zeros(max(vocab.values()) + 1, bool)
    for token, i in vocab.items():
        word = token.removesuffix("</w>")
        out[i] = bool(word) and not word.strip(".!?")
    return out


def cuts_of(places: list[int], penalties: list[int], window: int = WINDOW) -> list[int]:
    """The cheapest increasing cuts through ``places`` (the last is always one),
    starting at 0, no two further apart than ``window``. Places must be
    increasing, positive and nowhere further apart than ``window``."""
    queue = deque([(0, 0, -1)])  # (cost up to a cut + its place, place, index), both increasing
    back = [0] * len(places)
    for j, place in enumerate(places):
        while place - queue[0][1] > window:
            queue.popleft()
        least, _, back[j] = queue[0]
        worth = least + window + penalties[j]  # cost up to here + place
        while queue and queue[-1][0] >= worth:
            queue.pop()
        queue.append((worth, place, j))
    out, j = [], len(places) - 1
    while j >= 0:
        out.append(places[j])
        j = back[j]
    return out[::-1]


def candidates(ids: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Places within a document after which it may be cut, and their penalties."""
    gap = min(HARD_GAP, window)
    n = len(ids)
    soft = np.flatnonzero(ends[ids[:-1]]) + 1 if n > 1 else np.zeros(0, np.int64)
    edges = np.concatenate(([0], soft, [n]))
    wide = np.flatnonzero(np.diff(edges) > gap)
    penalty = np.full(len(soft), SENTENCE_PENALTY)
    if len(wide):
        hard = np.concatenate([np.arange(edges[i] + gap, edges[i + 1], gap) for i in wide])
        soft = np.concatenate((soft, hard))
        penalty = np.concatenate((penalty, np.full(len(hard), HARD_PENALTY)))
        order = np.argsort(soft, kind="stable")
        soft, penalty = soft[order], penalty[order]
    return soft.tolist() + [n], penalty.tolist() + [0]


class Packer:
    """Takes documents in order, gives pieces window by window."""

    def __init__(self, ends: np.ndarray, window: int, first_sequence: int):
        self.ends, self.window, self.sequence = ends, window, first_sequence
        self.docs: deque = deque()  # (place of the first token, id, tokens)
        self.places: list[int] = []
        self.penalties: list[int] = []
        self.size = 0

    def add(self, key, ids: np.ndarray) -> list[tuple]:
        places, penalties = candidates(ids, self.ends, self.window)
        self.places += [self.size + p for p in places]
        self.penalties += penalties
        self.docs.append((self.size, key, ids))
        self.size += len(ids)
        return self.flush(last=False) if self.size >= PLAN_TOKENS else []

    def flush(self, last: bool) -> list[tuple]:
        if not self.places:
            return []
        cuts = cuts_of(self.places, self.penalties, self.window)
        if not last:
            cuts.pop()  # the last window is planned again
        out, begin = [], 0
        for end in cuts:
            at = begin
            while at < end:
                first, key, ids = self.docs[0]
                stop = min(end, first + len(ids))
                out.append((key, at - first, stop - at, ids[at - first:stop - first].tobytes(), len(ids),
                            self.sequence, at - begin, end - begin))
                at = stop
                if stop == first + len(ids):
                    self.docs.popleft()
            self.sequence += 1
            begin = end
        kept = next((i for i, p in enumerate(self.places) if p > begin), len(self.places))
        self.places = [p - begin for p in self.places[kept:]]
        self.penalties = self.penalties[kept:]
        self.docs = deque((first - begin, key, ids) for first, key, ids in self.docs)
        self.size -= begin
        return out


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start (within the document), length, ids
    (little-endian unsigned 32 bit), doc_tokens, sequence_id, offset (within the
    sequence), tokens_in_sequence. Sequence ids are the task's number times 2^32
    plus a gapless count."""

    def run(batches):
        tokenizer = chunk_tokenizer(tokenizer_path)
        packer = Packer(sentence_ends(tokenizer.tokenizer), window, TaskContext.get().partitionId() << 32)
        close = np.array([end_id], "<u4")
        rows, size = [], 0

        def packed():
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for key, ids in tokenizer.documents(batches):
            rows += packer.add(key, np.append(ids, close))
            size += ids.nbytes
            if rows and size >= OUT_BYTES:
                yield packed()
                rows, size = [], 0
        rows += packer.flush(last=True)
        if rows:
            yield packed()

    return in_id_order(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")
