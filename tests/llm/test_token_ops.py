"""BPE against tiktoken, packing and token files against the tokenizers library."""

import base64
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from ledgerscope.llm import bpe, packing, rans
from ledgerscope.llm.tokens import ChunkTokenizer

from .conftest import AWKWARD

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
SPECIAL = ["<|endoftext|> x", "a b<|endoftext|>c, <|startoftext|><|endoftext|>", "<|ENDOFTEXT|> y", "<|endof text|>", "x <|endoftext|>"]
ALPHABET = ("aábc étiΣςσİıΩ' the  \x1c\x85\n\t\x0b\r 日本語한국ñ🙂é́̈123①²!?.,;<>|‍﻿\U0001F1EB　'sǅßŉक़")


def random_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


@pytest.mark.parametrize("file", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_bpe_equals_tiktoken(spark, small, file):
    ranks = bpe.load_ranks(P.path(file))
    ours = bpe.BytePairs(ranks, P.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = random_texts(3000, 5) + ["a" * 9000, "ab" * 4000, "thethe" * 3000, "é" * 3000, " " * 999 + "x", "<|endoftext|>"]
    texts += [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    for t in texts:
        ids = ours.encode(t)
        assert list(memoryview(ids).cast("I")) == theirs.encode_ordinary(t)
        assert ours.decode(ids) == t.encode()


def test_bpe_rows(awkward):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.encode_documents(awkward, RANKS, P.PATTERN).collect()
    want = Counter((i, np.array(theirs.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in AWKWARD)
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in rows) == want
    assert bpe.encode_documents(awkward.limit(0), RANKS, P.PATTERN).count() == 0


def test_chunk_tokenizer_equals_library(spark, small, words, monkeypatch):
    monkeypatch.setattr("ledgerscope.llm.tokens.GENERATION", 500)
    ours = ChunkTokenizer(WORDS, 4)
    texts = random_texts(4000, 6) + [*SPECIAL, "don't DON'T 's,", "x" * 3000, ", , ,,"]
    texts += [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    for t in texts:
        assert np.frombuffer(ours.encode(t), "<u4").tolist() == words.encode(t, add_special_tokens=False).ids


def test_special_tokens_follow_the_librarys_default(docs_of, words, tmp_path, spark):
    pairs = list(enumerate([*SPECIAL, "plain text", None]))
    ours = ChunkTokenizer(WORDS, 2)
    ids, ends = ours.encode_column(pa.array([t for _, t in pairs]))
    want = [words.encode(t or "", add_special_tokens=False).ids for _, t in pairs]
    assert ids.tolist() == sum(want, []) and ends.tolist() == np.cumsum(list(map(len, want))).tolist()
    assert 49407 in want[0] and 49407 not in want[2]
    check_pieces(packing.pack_documents(docs_of(pairs), WORDS, 64).collect(), pairs, words, 64)
    rans.write_files(docs_of(pairs), f"{tmp_path}/f", WORDS)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rans.read_files(spark, f"{tmp_path}/f").collect()}
    assert got == {i: w + [1] for i, w in enumerate(want)}
    plain = ChunkTokenizer(WORDS, 4, special_as_text=True)
    text = Tokenizer.from_file(WORDS)
    text.encode_special_tokens = True
    for t in SPECIAL:
        assert np.frombuffer(plain.encode(t), "<u4").tolist() == text.encode(t, add_special_tokens=False).ids


def brute_cost(places, penalties, window):
    best = {0: 0}
    for p, c in zip(places, penalties):
        best[p] = min(best[q] + window - (p - q) + c for q in best if p - window <= q < p)
    return best[places[-1]]


def test_cuts_are_the_cheapest():
    rnd = random.Random(4)
    for _ in range(300):
        window = rnd.choice([5, 20, 64])
        places = sorted(set(np.cumsum([rnd.randint(1, window) for _ in range(rnd.randint(1, 40))]).tolist()))
        penalties = [rnd.choice([0, 3, 9]) for _ in places]
        cuts = packing.cuts_of(places, penalties, window)
        cost = sum(window - (b - a) + penalties[places.index(b)] for a, b in zip([0] + cuts, cuts))
        assert cuts[-1] == places[-1] and cost == brute_cost(places, penalties, window)


def check_pieces(rows, pairs, words, window):
    want = Counter()
    for i, t in pairs:
        ids = words.encode(t or "", add_special_tokens=False).ids + [1]
        want[(i, np.array(ids, "<u4").tobytes())] += 1
    docs = defaultdict(list)
    for r in rows:
        docs[(r.doc_id, r.doc_tokens)].append(r)
    got = Counter()
    for (i, n), pieces in docs.items():
        pieces.sort(key=lambda r: (r.start, r.sequence_id, r.offset))
        firsts = [r for r in pieces if r.start == 0]
        rest = defaultdict(list)
        for r in pieces:
            rest[r.start].append(r)
        for r in firsts:
            whole, at = bytes(r.ids), r.length
            while at < n:
                nxt = rest[at].pop()
                whole += bytes(nxt.ids)
                at += nxt.length
            got[(i, whole)] += 1
    assert got == want
    sequences = defaultdict(list)
    for r in rows:
        assert r.length * 4 == len(r.ids)
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences), sum(r.length for r in rows)


@pytest.mark.parametrize("window", [64, 2048])
def test_packing(awkward, words, window):
    check_pieces(packing.pack_documents(awkward, WORDS, window).collect(), AWKWARD, words, window)
    assert packing.pack_documents(awkward.limit(0), WORDS).count() == 0


def test_packing_leaves_little_padding(spark, small, words, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    for plan, least in ((1 << 15, 0.97), (1 << 19, 0.98)):  # planned in several parts or at once
        monkeypatch.setattr(packing, "PLAN_TOKENS", plan)
        n, tokens = check_pieces(packing.pack_documents(docs, WORDS).collect(), pairs, words, 2048)
        assert tokens / (n * 2048) > least


@pytest.mark.parametrize("n", [0, 1, 63, 65, 70_001, 300_000])
def test_rans_round_trip(n):
    rnd = np.random.default_rng(n)
    ids = (rnd.zipf(1.3, n) % 49_000).astype(np.uint32)
    u, c = np.unique(np.append(ids, 3), return_counts=True)
    table = rans.FrequencyTable(u, c)
    assert int(table.freq.sum()) == rans.SLOTS - 1
    block = rans.encode_block(ids, table)
    assert (rans.decode_block(block, table) == ids).all()
    if n > 1000:
        p = c / c.sum()
        assert len(block) * 8 / n < 1.1 * -(p * np.log2(p)).sum() + 0.2
        spoilt = bytearray(block)
        spoilt[-5] ^= 255
        with pytest.raises(ValueError):
            rans.decode_block(bytes(spoilt), table)
        with pytest.raises(ValueError):
            rans.encode_block(np.array([48_999_999], np.uint32), table)


@pytest.mark.parametrize("block", [1 << 20, 500])
def test_token_files(spark, awkward, words, tmp_path, monkeypatch, block):
    monkeypatch.setattr(rans, "BLOCK_TOKENS", block)
    rans.write_files(awkward, f"{tmp_path}/f", WORDS)
    rows = rans.read_files(spark, f"{tmp_path}/f").collect()
    want = Counter((i, np.array(words.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
                   for i, t in AWKWARD)
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


def test_token_files_of_nothing(spark, awkward, tmp_path):
    rans.write_files(awkward.limit(0), f"{tmp_path}/f", WORDS)
    assert rans.read_files(spark, f"{tmp_path}/f").count() == 0


def test_token_file_query(spark, small, words):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rows = {r.doc_id: r for r in rans.op10_token_files(spark, small).collect()}
    at = 0
    for d in docs:
        ids = np.array(words.encode(d.text, add_special_tokens=False).ids + [1], "<u4")
        r = rows[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
