"""Byte-level BPE encoding and decoding in linear time.

A piece's bytes are mapped to Latin-1, one character a byte, so that an
Aho-Corasick automaton over the vocabulary (pyahocorasick) finds in one pass the
longest token that starts at every byte. From the left, the longest token is
taken if it may stand next to the token before it, else its longest proper prefix
that is a token, and so on; if none fits, the end reached so far is marked dead
and the last token is taken back. Every position dies at most once, so the work is
linear in the piece. Two tokens may stand side by side if the merges, applied to
their joined bytes, give back exactly these two; undoing the tokens' own last
merges tells, and the answers are memoised.

This gives the exact merges: a token sequence is what the merges produce if and
only if each token reproduces itself and each neighbouring pair does. A piece
that is a token as a whole is that token, as in tiktoken.

Texts are cut by a pattern (a parameter), and pieces of up to 64 characters are
remembered per worker, in two generations of 200,000 pieces.

Defined results: null text is empty and gives no ids; any text decodes to its own
bytes; an empty table gives no rows; repeated rows give repeated rows. Columns
other than the identifier and the text are ignored.
"""

from __future__ import annotations

import base64
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, worker_cache

REMEMBER_CHARS = 64
REMEMBER_PIECES = 200_000
REMEMBER_PAIRS = 500_000
NEVER = 1 << 60
#: Bytes of texts and ids handed back to Spark at once.
OUT_BYTES = 8 << 20


class BytePairs:
    """A vocabulary of byte strings with ranks: ``encode`` and ``decode``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.rank = {b.decode("latin-1"): r for b, r in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.trie = ahocorasick.Automaton()
        for token in self.rank:
            self.trie.add_word(token, token)
        self.trie.make_automaton()
        self.neighbours: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, tuple | None] = {}
        self.shorter: dict[str, str | None] = {}
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        size = max(ranks.values()) + 1
        sizes = np.zeros(size, np.int64)
        for b, r in ranks.items():
            sizes[r] = len(b)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        by_rank = dict(zip(ranks.values(), ranks))
        self.all_bytes = np.frombuffer(b"".join(by_rank.get(r, b"") for r in range(size)), np.uint8)

    def halves(self, token: str) -> tuple | None:
        """The two tokens of the last merge that makes ``token``; () for a byte,
        None if the merges never make it."""
        if token not in self.parts:
            own, last = list(token), ()
            while len(own) > 1:
                best, at = min((self.rank.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(own, own[1:])))
                if best == NEVER:
                    break
                last = (own[at], own[at + 1])
                own[at:at + 2] = [own[at] + own[at + 1]]
            self.parts[token] = last if len(own) == 1 else None
        return self.parts[token]

    def next_shorter(self, token: str) -> str | None:
        """The longest proper prefix that is a token the merges can make."""
        if token not in self.shorter:
            self.shorter[token] = next((token[:n] for n in range(len(token) - 1, 0, -1)
                                        if token[:n] in self.rank and self.halves(token[:n]) is not None), None)
        return self.shorter[token]

    def fits(self, left: str, right: str) -> bool:
        """Whether the merges leave ``left + right`` as these two. From the last
        merge back, whichever side was merged later is undone, and each time no
        merge across the border may have come before that one. Of equal ranks the
        leftmost is merged first."""
        rank, until = self.rank, NEVER
        while True:
            if rank.get(left + right, NEVER) < until:
                return False
            ends, begins = self.halves(left), self.halves(right)
            if not ends and not begins:
                return True
            if begins and (not ends or rank[right] >= rank[left]):
                until, right = rank[right] + 1, begins[0]
            else:
                until, left = rank[left], ends[1]

    def tokens(self, s: str) -> list[str]:
        """The tokens of one piece, given as Latin-1 characters."""
        if s in self.rank:
            return [s]
        longest: list[str] = [""] * len(s)
        for end, token in self.trie.iter(s):
            longest[end - len(token) + 1] = token  # later ends are longer
        neighbours, parts = self.neighbours, self.parts
        out: list[str] = []
        dead = bytearray(len(s) + 1)
        at, token, size = 0, longest[0], len(s)
        while at < size:
            end = at + len(token)
            good = not dead[end] and (parts[token] if token in parts else self.halves(token)) is not None
            if good and out:
                pair = (out[-1], token)
                good = neighbours.get(pair)
                if good is None:
                    if len(neighbours) >= REMEMBER_PAIRS:
                        neighbours.clear()
                    good = neighbours[pair] = self.fits(*pair)
            if good:
                out.append(token)
                at = end
                token = longest[at] if at < size else ""
                continue
            less = self.next_shorter(token)
            if less is None:
                dead[at] = 1
                token = out.pop()
                at -= len(token)
            else:
                token = less
        return out

    def piece_ids(self, piece: str) -> bytes:
        known = self.known
        ids = known.get(piece) or self.old.get(piece)
        if ids is None:
            rank = self.rank
            ids = array("I", [rank[t] for t in self.tokens(piece.encode("utf-8").decode("latin-1"))]).tobytes()
        if len(piece) <= REMEMBER_CHARS:
            if len(known) >= REMEMBER_PIECES:
                self.old, self.known = known, {}
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, make = self.known, self.piece_ids
        return b"".join([known.get(p) or make(p) for p in self.pieces(text)])

    def decode(self, ids: bytes) -> bytes:
        own = np.frombuffer(ids, "<u4")
        sizes = self.sizes[own]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        take = np.repeat(self.starts[own] - (ends - sizes), sizes) + np.arange(total)
        return self.all_bytes[take].tobytes()


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, decode: bool = True,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): ids as little-endian unsigned 32-bit integers,
    and the bytes that they decode to (null unless ``decode``)."""

    def run(batches):
        bpe = worker_cache(("bpe", ranks_path, pattern), lambda: BytePairs(load_ranks(ranks_path), pattern))

        def packed(keys, ids, texts):
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(ids, pa.binary()), pa.array(texts, pa.binary())],
                ["doc_id", "ids", "decoded"])

        for batch in batches:
            keys, ids, texts, size = [], [], [], 0
            for key, text in zip(batch.column(0), batch.column(1)):
                got = bpe.encode(text.as_py() or "")
                back = bpe.decode(got) if decode else None
                keys.append(key.as_py())
                ids.append(got)
                texts.append(back)
                size += len(got) + len(back or b"")
                if size >= OUT_BYTES:
                    yield packed(keys, ids, texts)
                    keys, ids, texts, size = [], [], [], 0
            if keys:
                yield packed(keys, ids, texts)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded binary")


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode_documents(read_table(spark, sf_dir, "documents"),
                           public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
