"""Prefix token counts against the tokenizers library, at every prefix."""

import random

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from ledgerscope.llm import prefix_counts as pc

from .conftest import AWKWARD
from .test_token_ops import random_texts

FILE = P.path("byte_bpe_50k.json")
ODD = ["", " ", "it's we're they'll I'd don't 've 'r 'v 'l 're", "a  b   c\n\n d \t\n e", "\n\n\n", "x\n", " \n a", "''re",
       "tail <|endoftext|> more <|endoftext|><|endoftext|>!", "<|endoftext|>", "<|endoftext", "  <|endoftext|>  x",
       "!!<|endoftext|>'re", "日本語  한국　 x", "été́ ①²", "the" * 200, " " * 300 + "x", "\r\n\r\n  y"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def counter():
    return pc.PrefixCounter(FILE)


def brute(library, text):
    got = library.encode_batch([text[:k] for k in range(len(text) + 1)], add_special_tokens=False)
    return [len(g.ids) for g in got]


def test_every_prefix_equals_the_library(counter, library):
    texts = ODD + random_texts(400, 11)
    rnd = random.Random(3)
    bits = ["'re", "'s", " ", "  ", "\n", "<|endoftext|>", "<|endo", "ab", "The", "\t", "9", "é", "?!", "\u0085", "\x1c"]
    texts += ["".join(rnd.choices(bits, k=12)) for _ in range(400)]
    for text, counts in zip(texts, counter.of_texts(texts)):
        assert counts.tolist() == brute(library, text), repr(text)


def test_whole_documents(counter, library, spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    texts += ["a" * 200_000, "ab" * 50_000, "é" * 20_000, " " * 50_000 + "x", "word " * 400_000]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [int(c[-1]) for c in counter.of_texts(texts)] == want


def test_memory_of_pieces_is_bounded(library, monkeypatch):
    monkeypatch.setattr(pc, "GENERATION", 20)
    monkeypatch.setattr(pc, "REMEMBER_PAIRS", 10)
    small = pc.PrefixCounter(FILE)
    for text in random_texts(100, 5):
        assert small.of_texts([text])[0].tolist() == brute(library, text)


def test_questions():
    counts = np.array([0, 1, 2, 1, 2, 3], np.int32)
    assert [pc.longest_prefix(counts, b) for b in (-1, 0, 1, 2, 9)] == [0, 0, 3, 4, 5]
    assert pc.count_at(counts, 3) == 1 and pc.count_at(counts, 99) == 3 and pc.tokens_between(counts, 1, 5) == 2


def test_rows(spark, awkward, library):
    table = pc.prefix_counts(awkward, FILE)
    got = sorted((r.doc_id or -1, np.frombuffer(r.counts, "<i4")[-1]) for r in table.collect())
    assert got == sorted((i or -1, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in AWKWARD)
    rows = pc.budget_answers(awkward, FILE, 3).collect()
    for r in rows:
        text = dict((i, t or "") for i, t in AWKWARD)[r.doc_id]
        own = text[:r.budget_chars]
        assert len(library.encode(own, add_special_tokens=False).ids) <= 3 and r.n_bytes == len(text.encode())
        assert all(len(library.encode(text[:k], add_special_tokens=False).ids) > 3
                   for k in range(r.budget_chars + 1, min(len(text), r.budget_chars + 40)))
    assert pc.budget_answers(awkward.limit(0), FILE, 3).count() == 0


def test_truncation_by_the_stored_table(spark, docs_of, library):
    docs = docs_of([(1, "one two three four five"), (2, None), (3, ""), (4, "it's 'really' good  <|endoftext|> x")])
    cut = pc.truncate_documents(docs, pc.prefix_counts(docs, FILE), 4)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    whole = {r.doc_id: r.text for r in docs.collect()}
    want = {i: t and max((t[:k] for k in range(len(t) + 1) if brute(library, t)[k] <= 4), key=len)
            for i, t in whole.items()}
    assert texts == want and texts[1] == "one two three four"


def test_query(spark, small, library):
    rows = pc.op12_token_counts(spark, small).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in rows:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 512)
    assert len(rows) == len(texts)
