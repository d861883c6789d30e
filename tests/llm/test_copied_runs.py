"""Exact copies: every word of a run of 50 words that a lower document has, and no other."""

import random

from ledgerscope.llm import paragraphs
from ledgerscope.llm.common import reliable_checkpoint
from ledgerscope.llm.frequent import texts_of

from .test_paragraphs import prose


def covered(rows):
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, set()).update(range(r.at, r.at + r.words))
    return out


def brute_cover(docs, size=50):
    """Words of each document in windows that a document of a lower identifier has."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        words = text.lower().split()
        windows = [" ".join(words[k:k + size]) for k in range(len(words) - size + 1)]
        for k, w in enumerate(windows):
            if w in seen:
                out.setdefault(i, set()).update(range(k, k + size))
        seen.update(windows)
    return out


def test_passage_of_lines_first_seen_elsewhere(docs_of):
    rnd = random.Random(1)
    lines = [" ".join(f"l{i}w{k}" for k in range(10)) + "." for i in range(8)]
    whole = "\n".join(lines)
    docs = [(i, prose(rnd, 90, f"d{i}x") + "\n" + line + "\n" + prose(rnd, 90, f"e{i}x")) for i, line in enumerate(lines)]
    docs += [(i, prose(rnd, 90, f"d{i}x") + "\n" + whole + "\n" + prose(rnd, 90, f"e{i}x")) for i in (10, 20)]
    docs.append((9, prose(rnd, 90, "d9x") + "\n" + "\n".join(lines[:4]) + "\n" + prose(rnd, 90, "e9x")))
    rows = [r for r in paragraphs.repeated_units(docs_of(docs)).collect() if r.doc_id == 20]
    assert {r.keep_doc_id for r in rows} == {10}
    assert covered(rows)[20] == set(range(90, 170))


def test_short_copies_at_random_places(docs_of):
    rnd = random.Random(2)
    docs = []
    for p in range(200):
        n = rnd.randint(50, 60)
        copy = prose(rnd, n, f"p{p}x")
        for i in (2 * p, 2 * p + 1):
            words = prose(rnd, 150, f"d{i}x").split(" ")
            at = rnd.randrange(len(words))
            docs.append((i, " ".join(words[:at] + [copy] + words[at:])))
    rows = paragraphs.repeated_units(docs_of(docs)).collect()
    found, wanted = covered(rows), brute_cover(docs)
    assert set(found) == set(wanted) == {i for i, _ in docs if i % 2}
    # a near-equal paragraph over the copy's end may add some words of its own
    assert all(found[i] >= w and len(found[i] - w) <= 8 for i, w in wanted.items())
    assert sum(found[i] == w for i, w in wanted.items()) >= 190


def test_copies_of_very_short_lines(docs_of):
    rnd = random.Random(3)
    for per_line in (1, 2, 3):
        words = [f"v{rnd.randrange(10 ** 7)}" for _ in range(200)]
        verse = "\n".join(" ".join(words[k:k + per_line]) for k in range(0, 200, per_line))
        docs = [(i, prose(rnd, 60, f"a{i}x") + "\n" + verse + "\n" + prose(rnd, 60, f"b{i}x")) for i in (1, 2)]
        assert covered(paragraphs.repeated_units(docs_of(docs)).collect()) == {2: set(range(60, 260))}


def test_overlapping_copies_against_brute_force(docs_of, monkeypatch):
    monkeypatch.setattr(paragraphs, "ROUNDS_FROM", 0)
    rnd = random.Random(4)
    source = [f"s{k}" for k in range(2000)]
    docs = []
    for i in range(120):
        text = []
        for k in range(rnd.randint(1, 4)):
            at = rnd.randrange(1900)
            text += source[at:at + rnd.randint(20, 90)] + [f"o{i}x{k}y{j}" for j in range(rnd.randint(0, 30))]
        docs.append((i, " ".join(text)))
    found, wanted = covered(paragraphs.repeated_units(docs_of(docs)).collect()), brute_cover(docs)
    assert all(found.get(i, set()) >= cover for i, cover in wanted.items())


def test_wanted_texts_as_by_a_join(spark):
    rows = [(i, f"text {i}", i % 3) for i in [*range(2000), 5, 5]] + [(None, "none", 1), (-7, None, 2)]
    texts = spark.createDataFrame(rows, "doc_id long, text string, other int")
    wanted = reliable_checkpoint(spark.createDataFrame([(i, i) for i in (5, 77, -7, 10 ** 12)], "doc_id long, mark long"))
    found = texts_of(texts, wanted)
    assert sorted(found.collect()) == sorted(texts.join(wanted, "doc_id").collect())
    held = [n for n in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "is_held" in n]
    assert held  # the other texts leave before the join
