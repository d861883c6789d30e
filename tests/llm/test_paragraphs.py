"""Copied passages: planted ones are found and removed, the rest is left alone."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerscope.llm import paragraphs, setlink

from .conftest import AWKWARD


def prose(rnd, n, tag):
    out = []
    for i in range(n):
        w = f"{tag}{rnd.randrange(10 ** 7)}"
        if rnd.random() < 0.09:
            w += "."
        out.append(w + ("\n" if rnd.random() < 0.02 else ""))
    return " ".join(out)


def planted(seed, n=60):
    rnd = random.Random(seed)
    common = "this work is licensed under the terms of a licence."
    docs = {i: prose(rnd, rnd.randint(80, 300), f"d{i}x") + "\n" + common for i in range(n)}
    passages = {}
    for p in range(8):
        text = prose(rnd, 70, f"p{p}x")
        own = rnd.sample(range(n), rnd.randint(2, 6))
        own = [i for i in own if not any(i in o for o in passages.values())]
        if len(own) < 2:
            continue
        passages[text] = own
        for i in own:
            words = docs[i].split(" ")
            at = rnd.randrange(len(words))
            docs[i] = " ".join(words[:at] + [text] + words[at:])
    return docs, passages


def test_units_cover_words_and_places():
    texts = [t for _, t in AWKWARD]
    together = paragraphs.Units(pa.array(texts, pa.string()))
    for d, t in enumerate(texts):
        own = np.flatnonzero(together.text == d)
        words = (t or "").replace("\t", " ").replace("\n", " ").split()
        assert together.count[own].sum() == len(words)
        for u in own:
            piece = t[together.start[u]:together.start[u] + together.length[u]]
            assert piece.split() == words[together.at[u]:together.at[u] + together.count[u]]
        alone = paragraphs.Units(pa.array([t], pa.string()))
        assert (alone.keys == together.keys[own]).all()


def test_planted_passages(docs_of):
    docs, passages = planted(5)
    units = paragraphs.repeated_units(docs_of(sorted(docs.items()))).collect()
    pairs = {(r.doc_id, r.keep_doc_id) for r in units}
    assert pairs >= {(i, min(own)) for own in passages.values() for i in own if i != min(own)}
    assert all(any({i, j} <= set(own) for own in passages.values()) for i, j in pairs)
    out = {r.doc_id: r.text for r in paragraphs.drop_passages(docs_of(sorted(docs.items()))).collect()}
    assert set(out) == set(docs)
    for text, own in passages.items():
        middle = " ".join(text.split()[25:45])
        holders = [i for i in own if middle in " ".join(out[i].split())]
        assert holders == [min(own)]
    touched = {i for own in passages.values() for i in own}
    assert all(out[i] == docs[i] for i in docs if i not in touched or any(i == min(o) for o in passages.values()))


@pytest.mark.parametrize("small", [256, 2])
def test_near_equal_paragraphs(docs_of, monkeypatch, small):
    monkeypatch.setattr(setlink, "SMALL", small)
    rnd = random.Random(3)
    line = [f"w{i}a" for i in range(90)]
    line = [w for w in line if __import__("xxhash").xxh3_64_intdigest(w) % paragraphs.CUT]
    docs = []
    for i in range(9):
        w = list(line)
        w[-1 - i % 2] = f"z{i}q"  # one word differs, near the end
        docs.append((i, prose(rnd, 60, f"n{i}x") + "\n" + " ".join(w) + "\n" + prose(rnd, 60, f"m{i}x")))
    rows = paragraphs.repeated_units(docs_of(docs)).collect()
    assert {r.doc_id for r in rows} == set(range(1, 9)) and {r.keep_doc_id for r in rows} == {0}


def test_awkward_rows(awkward, docs_of):
    out = paragraphs.drop_passages(awkward)
    assert out.columns == awkward.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in out.collect()) == sorted(
        (i or -1, t or "") for i, t in AWKWARD)
    assert paragraphs.repeated_units(docs_of([])).count() == 0
    assert paragraphs.drop_passages(docs_of([])).count() == 0
    same = " ".join(f"s{i}" for i in range(80))
    both = docs_of([(1, same), (2, same), (None, same), (2, same)])
    assert [(r.doc_id, r.text) for r in paragraphs.drop_passages(both).orderBy("doc_id").collect()] == [
        (None, same), (1, same)]
