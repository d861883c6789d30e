"""Exact token counts of every prefix of a text, by dynamic programming.

The tokenizer is a byte-level BPE file of the tokenizers library. Within a piece of
its pattern, the encoding of a prefix ends with exactly one token: of the vocabulary's
tokens that end there (an Aho-Corasick automaton finds them), the one that may stand
behind the last token of what is left before it. So a prefix's count is the count of
that shorter prefix plus one, and a text is read once. Two tokens may stand side by
side if the merges, applied to their joined bytes, leave just these two; undoing the
tokens' own merges from the last one back tells, and answers are memoised.

A text's prefix ends inside one of its pieces, and the pieces before are those of the
whole text, with three exceptions that get counts of their own: a run of white space
whose last character belongs to the next piece, the first two characters of a long
contraction ('re is cut as ' and r), and a prefix that ends inside the string of a
special token, which is ordinary text until it is complete.

Counts are kept per character as little-endian 32-bit integers, the empty prefix
first. ``count_at``, ``longest_prefix`` and ``tokens_between`` answer questions about
budgets and truncation from them, without encoding anything again.

Defined results: null text is empty: no tokens, one prefix; repeated rows give
repeated rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, worker_cache
from .shingles import slices

#: The pattern of the tokenizers library's byte-level pieces, and its
#: contractions of which the first two characters alone are two pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")

GENERATION = 200_000
REMEMBER_CHARS = 64
REMEMBER_PAIRS = 500_000
SLICE_BYTES = 4 << 20
LIMIT = 512
NEVER = 1 << 60


def byte_names() -> dict[str, str]:
    """The library's printable name of every byte, to the byte as a Latin-1 character:
    printable Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): chr(b) for b in plain} | {chr(0x100 + k): chr(b) for k, b in enumerate(other)}


class PrefixCounter:
    """Token counts of all prefixes of texts, for one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if (spec["normalizer"] is not None or pre["type"] != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or model["type"] != "BPE" or model.get("ignore_merges")
                or model.get("dropout") or model.get("byte_fallback")):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        names = byte_names()
        latin = lambda name: "".join(names[c] for c in name)
        self.rank: dict[tuple[str, str], int] = {}
        self.made: dict[str, tuple[str, str]] = {}
        for k, pair in enumerate(model["merges"]):
            a, b = map(latin, pair.split(" ") if isinstance(pair, str) else pair)
            self.rank[a, b] = k
            self.made.setdefault(a + b, (a, b))
        specials = [t for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in specials):
            raise ValueError(f"{path} has special tokens that take their neighbours along")
        strings = sorted((t["content"] for t in specials), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, strings))) if strings else None
        self.longest_special = max(map(len, strings), default=0)
        self.pieces = regex.compile(PATTERN).findall
        self.whole: dict[str, bool] = {}
        self.trie = ahocorasick.Automaton()
        for token in [*map(chr, range(256)), *self.made]:
            if self.is_whole(token):
                self.trie.add_word(token, token)
        self.trie.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def is_whole(self, token: str) -> bool:
        """Whether the merges make one token of the token's own bytes: they do if its
        two halves are whole and no merge across their border comes before both are."""
        if len(token) == 1:
            return True
        if token not in self.whole:
            a, b = self.made[token]
            self.whole[token] = self.is_whole(a) and self.is_whole(b) and self.apart(a, b, 0)
        return self.whole[token]

    def apart(self, left: str, right: str, until: int) -> bool:
        """Whether no merge goes across the border of two tokens before the rank
        ``until``, nor while they are made. A token's own merge has the highest rank of
        all that make it, so the one merged later is undone first; of equal ranks the
        leftmost merge goes first."""
        rank, made = self.rank, self.made
        while rank.get((left, right), NEVER) >= until:
            a = rank[made[left]] if len(left) > 1 else -1
            b = rank[made[right]] if len(right) > 1 else -1
            if a < 0 and b < 0:
                return True
            if b >= a:
                until, right = b + 1, made[right][0]
            else:
                until, left = a, made[left][1]
        return False

    def fits(self, left: str, right: str) -> bool:
        """Whether two tokens may stand side by side."""
        return self.apart(left, right, NEVER)

    def of_piece(self, piece: str) -> bytes:
        """Counts of the piece's prefixes of 1, 2, ... characters, as int32."""
        if piece in LONG_CONTRACTIONS:
            return array("i", [1, 2, self.of_bytes(piece)[-1]]).tobytes()
        counts = self.of_bytes(piece)
        if len(counts) == len(piece):
            return counts.tobytes()
        ends = np.cumsum([len(c.encode("utf-8")) for c in piece])
        return np.frombuffer(counts, np.int32)[ends - 1].tobytes()

    def of_bytes(self, piece: str) -> array:
        """Counts of all byte prefixes of one piece, but the empty one."""
        s = piece.encode("utf-8").decode("latin-1")
        pairs, last, counts, at = self.pairs, [], array("i"), 0
        for end, token in self.trie.iter(s):
            if end < at:
                continue  # this prefix has its token
            before = end - len(token)
            if before >= 0:
                pair = (last[before], token)
                good = pairs.get(pair)
                if good is None:
                    if len(pairs) >= REMEMBER_PAIRS:
                        pairs.clear()
                    good = pairs[pair] = self.fits(*pair)
                if not good:
                    continue
            last.append(token)
            counts.append(counts[before] + 1 if before >= 0 else 1)
            at = end + 1
        return counts

    def _counts(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) >= GENERATION:
            self.old, self.known = self.known, {}
        out, known, old = [], self.known, self.old
        for p in pieces:
            got = known.get(p)
            if got is None:
                got = old.get(p) or self.of_piece(p)
                if len(p) <= REMEMBER_CHARS:
                    known[p] = got
            out.append(got)
        return out

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Counts of all prefixes of texts without special tokens."""
        lists = [self.pieces(t) for t in texts]
        flat = [p for own in lists for p in own]
        if not flat:
            return [np.zeros(1, np.int32) for _ in texts]
        coded = pa.array(flat, pa.string()).dictionary_encode()
        index = coded.indices.to_numpy()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        raw = self._counts(distinct)
        pool = np.frombuffer(b"".join(raw), np.int32)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) >> 2
        starts = np.cumsum(sizes) - sizes
        totals = pool[starts + sizes - 1].astype(np.int64)
        text = np.repeat(np.arange(len(lists)), list(map(len, lists)))
        ends = np.cumsum(totals[index])
        before = ends - totals[index]
        first = np.searchsorted(text, np.arange(len(lists)))
        has = np.array([len(own) > 0 for own in lists])
        base = np.zeros(len(lists), np.int64)
        base[has] = before[first[has]]
        before = before - base[text]
        chars = sizes[index]
        stop = np.cumsum(chars)
        take = np.repeat(starts[index] - (stop - chars), chars) + np.arange(int(stop[-1]))
        counts = (pool[take] + np.repeat(before, chars)).astype(np.int32)
        # a run of white space that leaves its last character to the next piece
        blank = np.fromiter((p.isspace() for p in distinct), bool, len(distinct))
        opens = np.fromiter((p[0].isspace() for p in distinct), bool, len(distinct))
        runs = np.flatnonzero(blank[index[:-1]] & opens[index[1:]] & (text[:-1] == text[1:]))
        for k in runs.tolist():
            run = distinct[index[k]] + distinct[index[k + 1]][0]
            counts[stop[k]] = before[k] + np.frombuffer(self._counts([run])[0], np.int32)[-1]
        bounds = np.concatenate(([0], stop))[np.append(first, len(flat))]
        return [np.concatenate((np.zeros(1, np.int32), counts[a:b])) for a, b in zip(bounds[:-1], bounds[1:])]

    def _with_specials(self, text: str) -> np.ndarray:
        """A prefix that ends inside a special token's string reads it as plain text."""
        out, at, base = [np.zeros(1, np.int32)], 0, 0
        found = [*self.special.finditer(text)]
        reach = [(at, m.start(), m.end()) for at, m in zip([0, *(m.end() for m in found)], found)]
        plain = self._plain([text[a:end - 1] for a, _, end in reach] + [text[found[-1].end():]])
        for (start, stop, end), counts in zip(reach, plain):
            out.append(counts[1:] + base)
            base += int(counts[stop - start]) + 1
            out.append(np.array([base], np.int32))
        out.append(plain[-1][1:] + base)
        return np.concatenate(out)

    def of_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text, the counts of its prefixes of 0, 1, ... characters."""
        odd = [bool(self.special and self.special.search(t)) for t in texts]
        plain = iter(self._plain([t for t, o in zip(texts, odd) if not o]))
        return [self._with_specials(t) if o else next(plain) for t, o in zip(texts, odd)]


def count_at(counts: np.ndarray, chars: int) -> int:
    """Tokens of the text's first ``chars`` characters."""
    return int(counts[min(chars, len(counts) - 1)])


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens (a longer prefix
    can have fewer tokens, so this is the last one that keeps to it)."""
    return int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else 0


def tokens_between(counts: np.ndarray, start: int, stop: int) -> int:
    """How many tokens the prefix up to ``stop`` has beyond the one up to ``start``."""
    return count_at(counts, stop) - count_at(counts, start)


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts): the table that answers questions later, a row per row."""
    def run(batches):
        counter = worker_cache(("prefix", path), lambda: PrefixCounter(path))
        for batch in batches:
            for part in slices(batch, slice_bytes=SLICE_BYTES):
                counts = counter.of_texts([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([c.astype("<i4").tobytes() for c in counts], pa.binary())],
                    ["doc_id", "counts"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, counts binary")


def budget_answers(docs: DataFrame, path: str, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, budget_chars): the tokens of each whole text and the
    characters of its longest prefix within ``budget``, both read off the counts."""
    def run(batches):
        counter = worker_cache(("prefix", path), lambda: PrefixCounter(path))
        for batch in batches:
            for part in slices(batch, slice_bytes=SLICE_BYTES):
                counts = counter.of_texts([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2),
                     pa.array([int(c[-1]) for c in counts], pa.int64()),
                     pa.array([longest_prefix(c, budget) for c in counts], pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens", "budget_chars"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, budget_chars long")


def truncate_documents(docs: DataFrame, counts: DataFrame, budget: int, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``docs`` with every text cut to its longest prefix of at most ``budget`` tokens,
    by a stored table of :func:`prefix_counts` (one row per identifier)."""
    def run(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            chars = [longest_prefix(np.frombuffer(c, "<i4"), budget) for c in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chars, pa.int64())], ["_of", "_chars"])

    mark = "_cut_" + "_".join(docs.columns)
    ends = counts.mapInArrow(run, "_of long, _chars long").select(
        F.col("_of").alias(mark + "_of"), F.col("_chars").cast("int").alias(mark))
    rows = docs.join(ends, docs[id_col].cast("long") == ends[mark + "_of"], "left")
    cut = F.when(F.col(mark).isNull(), F.col(f"`{text_col}`")).otherwise(
        F.col(f"`{text_col}`").substr(F.lit(1), F.col(mark)))
    return rows.select(*[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def op12_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = budget_answers(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), LIMIT)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "budget_chars")
