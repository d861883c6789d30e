"""Whole-text tokenization with a public tokenizer file.

The tokenizer drops white space between words, lower-cases, and keeps letters and
marks apart, so a text's ids are the ids of its chunks, one after the other, where
chunks end at spaces and line breaks, and between a plain letter and one mark before
a space. Arrow finds the distinct chunks of some megabytes of text; each is encoded
once by the tokenizers library and remembered per worker, in two generations of
bounded size: when the young one is full it becomes the old one, so frequent chunks
stay. Any other white space stays inside its chunk and is left to the library.
A text that holds the string of a special token is given to the library as a whole, so
the string becomes that token, as by the library's default; with ``special_as_text``
such strings are ordinary text.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import worker_cache

GENERATION = 100_000
REMEMBER_CHARS = 64
#: One mark behind a letter that stays as it is when composed, before a space.
MARK_BEHIND_WORD = r"([a-z\x{df}-\x{f6}\x{f8}-\x{ff}])([.,;:!?])( |$)"
PLAIN_TO = "\u00ff"
SEPARATOR = ","
#: Chunks joined into one call of the library.
JOIN = 400
#: Bytes of text encoded at once.
SLICE_BYTES = 8 << 20


class ChunkTokenizer:
    """Ids (little-endian unsigned 16 or 32 bit) of whole texts."""

    def __init__(self, path: str, width: int = 4, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)  # for chunks, which hold no special tokens
        self.tokenizer.encode_special_tokens = True
        self.whole = Tokenizer.from_file(path)
        self.special = [] if special_as_text else [
            t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.type, self.code = {2: ("<u2", "H"), 4: ("<u4", "I")}[width]
        names = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_names = {b: names.pre_tokenize_str(bytes([0xC3, b]).decode())[0][0][1]
                           for b in range(0x80, 0xC0)}  # the name of a byte behind 0xC3
        self.byte_names[0xC3] = names.pre_tokenize_str("\u00e9")[0][0][0]
        self.byte_names[0xC2] = names.pre_tokenize_str("\u00b5")[0][0][0]
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        (self.separator,) = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids

    def _encode(self, chunks: list[str]) -> None:
        """A chunk of plain lower-case letters is one word for the model, which
        needs neither normalizing nor cutting. Of the others, chunks without the
        separator are joined by it; their ids are cut at its id, which only the
        separator standing alone can give."""
        known, tokenize, code = self.known, self.tokenizer.model.tokenize, self.code
        others = []
        for c in chunks:
            if not c.isalpha():
                others.append(c)
            elif c.isascii():
                known[c] = array(code, [t.id for t in tokenize(c)]).tobytes()
            elif max(c) <= PLAIN_TO and c.islower():
                raw = c.encode("utf-8").decode("latin-1").translate(self.byte_names)
                known[c] = array(code, [t.id for t in tokenize(raw)]).tobytes()
            else:
                others.append(c)
        joined = [c for c in others if SEPARATOR not in c]
        groups = [joined[i:i + JOIN] for i in range(0, len(joined), JOIN)]
        calls = [f" {SEPARATOR} ".join(g) for g in groups]
        for group, got in zip(groups, self.tokenizer.encode_batch_fast(calls, add_special_tokens=False)):
            ids = np.array(got.ids, self.type)
            raw, size, start = ids.tobytes(), ids.itemsize, 0
            for c, end in zip(group, [*(np.flatnonzero(ids == self.separator) * size).tolist(), len(raw)]):
                self.known[c] = raw[start:end]
                start = end + size
        rest = [c for c in others if SEPARATOR in c]
        for c, got in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.known[c] = np.array(got.ids, self.type).tobytes()

    def _ids_of(self, words: list[str]) -> list[bytes]:
        if len(self.known) >= GENERATION:
            self.old, self.known = self.known, {"": b""}
        known, old, fresh = self.known, self.old, []
        for w in words:
            if w not in known:
                if (ids := old.get(w)) is not None:
                    known[w] = ids
                else:
                    fresh.append(w)
        if fresh:
            self._encode(fresh)
        out = list(map(known.__getitem__, words))
        for w in fresh:
            if len(w) > REMEMBER_CHARS:
                del known[w]
        return out

    def encode(self, text: str) -> bytes:
        """The ids of one text."""
        return self.encode_column(pa.array([text], pa.string()))[0].tobytes()

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's end.
        Nulls are empty. Chunks are told apart by Arrow's dictionary, so Python
        sees each distinct chunk of the column once."""
        texts, odd = pc.fill_null(texts, ""), {}
        for string in self.special:
            for at in np.flatnonzero(pc.match_substring(texts, string).to_numpy(zero_copy_only=False)).tolist():
                odd[at] = None
        if odd:
            for at in odd:
                odd[at] = np.array(self.whole.encode(texts[at].as_py(), add_special_tokens=False).ids, self.type)
            texts = pc.if_else(pa.array([i in odd for i in range(len(texts))]), "", texts)
        ids, ends = self._plain_column(texts)
        return self._with(ids, ends, odd) if odd else (ids, ends)

    @staticmethod
    def _with(ids: np.ndarray, ends: np.ndarray, odd: dict) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a column with those of the texts that the library encoded."""
        parts, start, sizes = [], 0, np.diff(ends, prepend=0)
        for at in sorted(odd):
            parts += [ids[start:ends[at]], odd[at]]
            start = ends[at]
            sizes[at] = len(odd[at])
        return np.concatenate([*parts, ids[start:]]), np.cumsum(sizes)

    def _plain_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.ascii_lower(pc.replace_substring(texts, "\n", " "))
        lists = pc.split_pattern(pc.replace_substring_regex(plain, MARK_BEHIND_WORD, r"\1 \2\3"), " ")
        chunks = lists.flatten().dictionary_encode()
        of_word = self._ids_of(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(of_word), self.type)
        sizes = np.fromiter(map(len, of_word), np.int64, len(of_word)) // ids.itemsize
        starts = np.cumsum(sizes) - sizes
        index = chunks.indices.to_numpy()
        lengths = sizes[index]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        take = np.repeat(starts[index] - (ends - lengths), lengths) + np.arange(total)
        last = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)) - 1
        return ids[take], ends[last]

    def documents(self, batches, slice_bytes: int = SLICE_BYTES):
        """(identifier, ids) of every row of two-column batches, in order. Rows
        are encoded some megabytes at a time, a longer text on its own."""
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(keys):
                before = int(sizes[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(sizes, before + slice_bytes, "right")))
                ids, ends = self.encode_column(texts.slice(at, stop - at))
                start = 0
                for key, end in zip(keys[at:stop], ends.tolist()):
                    yield key, ids[start:end]
                    start = end
                at = stop


def chunk_tokenizer(path: str, width: int = 4, special_as_text: bool = False) -> ChunkTokenizer:
    """The worker's tokenizer for a file."""
    return worker_cache(("tokenizer", path, width, special_as_text), lambda: ChunkTokenizer(path, width, special_as_text))
