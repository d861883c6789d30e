"""Word n-gram sets of many texts at once, as 63-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SPACES = "\t\n\x0b\x0c\r"
SLICE_BYTES = 1 << 20
_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                   0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly and drop a bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and where each text's words end.
    Words are runs of characters other than space and \\t..\\r."""
    plain = pc.ascii_lower(pc.fill_null(texts, ""))
    for space in SPACES:
        plain = pc.replace_substring(plain, space, " ")
    lists = pc.split_pattern(plain, " ")
    coded = lists.flatten().dictionary_encode()
    of_word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_numpy(zero_copy_only=False)),
                          np.uint64, len(coded.dictionary))
    index = coded.indices.to_numpy()
    real = (pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0)[index]
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
    return of_word[index[real]], np.concatenate(([0], np.cumsum(real)))[ends]


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of fewer words, of the whole run."""
    if len(words) < size:
        if not len(words):
            return np.zeros(0, np.uint64)
        whole = xxhash.xxh3_64_intdigest(words.tobytes(), seed=len(words))
        return mix(np.array([whole], np.uint64))
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += words[k:k + n] * _ODD[k]
    return mix(total)


def slices(batch: pa.RecordBatch, column: int = 1, slice_bytes: int = SLICE_BYTES):
    """Parts of a batch with some megabytes of text each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0)
                      .to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(sizes[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, before + slice_bytes, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def gram_sets(texts: pa.Array, size: int):
    """The sorted set of n-gram hashes of each text."""
    words, ends = word_hashes(texts)
    start = 0
    for end in ends.tolist():
        yield np.unique(gram_hashes(words[start:end], size))
        start = end


class WordRanks:
    """How frequent words are: 0 for words that are not in the list, then 1 for
    the least frequent of the list and so on."""

    def __init__(self, from_rare_to_frequent: list[int]):
        words = np.array(from_rare_to_frequent, np.int64).view(np.uint64)
        order = np.argsort(words, kind="stable")
        self.words, self.ranks = words[order], order + 1

    def of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.ranks[at], 0)


def rarest_first(texts: pa.Array, size: int, ranks: WordRanks):
    """The set of n-gram hashes of each text, sorted, and again in the order of
    the rank of each gram's rarest word, equal ranks by hash. (A hash belongs to one
    gram, so the second order is the same for all texts.)"""
    words, ends = word_hashes(texts)
    rank = ranks.of(words)
    start = 0
    for end in ends.tolist():
        grams, first = np.unique(gram_hashes(words[start:end], size), return_index=True)
        own = rank[start:end]
        n = end - start - size + 1
        rarest = np.minimum.reduce([own[k:k + n] for k in range(size)]) if n > 0 else own[:1] * 0
        yield grams, grams[np.lexsort((grams, rarest[first]))] if len(grams) else grams
        start = end
