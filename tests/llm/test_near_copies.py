"""Near copies whose parts are shifted against each other."""

import random

import pytest
import xxhash

from ledgerscope.llm import paragraphs

from .test_paragraphs import prose


@pytest.mark.parametrize("per_line, words, shifts", [(15, {30}, {0, 1}), (17, {52}, {0})])
def test_inserted_word_does_not_split_a_passage(docs_of, per_line, words, shifts):
    """Below 50 words common paragraphs add up over two shifts; from 50 words on the copy is found whole."""
    rnd = random.Random(8)
    plain = (w for w in (f"q{k}a" for k in range(10 ** 4)) if xxhash.xxh3_64_intdigest(w) % paragraphs.CUT)
    lines = [" ".join(next(plain) for _ in range(per_line)) + "." for _ in range(3)]
    middle = lines[1].split()
    edited = [lines[0], " ".join(middle[:8] + ["new"] + middle[8:]), lines[2]]
    docs = [(i, prose(rnd, 60, f"a{i}x") + "\n" + " ".join(body) + "\n" + prose(rnd, 60, f"b{i}x"))
            for i, body in ((1, lines), (2, edited))]
    rows = paragraphs.repeated_units(docs_of(docs)).collect()
    assert {(r.doc_id, r.keep_doc_id) for r in rows} == {(2, 1)}
    assert {r.passage_words for r in rows} == words and {r.shift for r in rows} == shifts
