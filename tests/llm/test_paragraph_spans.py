"""What goes from a text: exact copies to the word, and words between only within one passage."""

import random

from ledgerscope.llm import paragraphs

from .test_paragraphs import prose


def part(keeper, shift, at, words):
    return {"keep_doc_id": keeper, "shift": shift, "at": at, "words": words, "start": at * 10, "length": words * 10 - 1}


def gone(*parts):
    return {w for a, b in paragraphs.whole_spans(list(parts)) for w in range(a // 10, -(-b // 10))}


def test_words_between_go_only_within_a_near_copy():
    assert gone(part(1, 0, 0, 30), part(2, 0, 31, 30)) == {*range(30), *range(31, 61)}
    assert gone(part(1, 0, 0, 30), part(1, 5, 31, 30)) == {*range(30), *range(31, 61)}
    assert gone(part(1, 0, 0, 12), part(1, 0, 14, 12)) == {*range(12), *range(14, 26)}
    assert gone(part(1, 0, 0, 15), part(1, 0, 15, 15), part(1, 0, 31, 30)) == set(range(61))
    assert gone(part(1, 0, 0, 30), part(1, 0, 39, 30)) == {*range(30), *range(39, 69)}


def test_a_copy_goes_to_its_ends(docs_of):
    rnd = random.Random(6)
    docs, left = [], {}
    for p in range(60):
        copy = prose(rnd, rnd.randint(51, 60), f"p{p}x").split()
        for i in (2 * p, 2 * p + 1):
            words = prose(rnd, 150, f"d{i}x").split()
            at = rnd.randrange(len(words))
            docs.append((i, " ".join(words[:at] + copy + words[at:])))
            left[i] = words if i % 2 else words[:at] + copy + words[at:]
    out = {r.doc_id: r.text.split() for r in paragraphs.drop_passages(docs_of(docs)).collect()}
    copied = {i: [w for w in out[i] if w.startswith("p")] for i in out}
    assert not any(copied[i] for i in out if i % 2)
    assert all(out[i] == left[i] for i in out if i % 2 == 0)
    assert sum(out[i] == left[i] for i in out) >= 114
