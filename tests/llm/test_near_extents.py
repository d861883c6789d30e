"""Near copies of passages: recall, words removed, and no word of the document's own."""

import random

import numpy as np
import pytest

from ledgerscope.llm import near_copies, paragraphs

from .test_paragraphs import prose


def jaccard(a, b):
    one, two = ({tuple(x[k:k + 5]) for k in range(len(x) - 4)} for x in (a, b))
    return len(one & two) / len(one | two)


def edited(rnd, words, edits, tag):
    words = list(words)
    for k in range(edits):
        at = rnd.randrange(len(words))
        kind = rnd.choice(["change", "insert", "delete"])
        words[at:at + (kind != "insert")] = [] if kind == "delete" else [f"p{tag}e{k}"]
    return words


@pytest.mark.parametrize("in_lines", [False, True])
def test_near_copies_of_55_to_100_words(docs_of, in_lines):
    rnd = random.Random(11)
    docs, own, copied = [], {}, {}
    for p in range(300):
        source = prose(rnd, rnd.randint(55, 100), f"p{p}x").split()
        near = edited(rnd, source, 1 if len(source) < 95 else 2, p)
        if jaccard(source, near) < 0.8:
            continue
        for i, passage in ((2 * p, source), (2 * p + 1, near)):
            words = prose(rnd, 150, f"d{i}x").split()
            at = rnd.randrange(len(words))
            gap = "\n" if in_lines else " "
            docs.append((i, " ".join(words[:at]) + gap + " ".join(passage) + gap + " ".join(words[at:])))
            own[i] = words
        copied[2 * p + 1] = (source, near)
    rnd.shuffle(docs)
    out = {r.doc_id: r.text.split() for r in paragraphs.drop_passages(docs_of(docs)).collect()}
    left = {i: [w for w in out[i] if w.startswith("p")] for i in copied}
    assert len(copied) >= 200
    found = [i for i, (_, near) in copied.items() if len(left[i]) < len(near) / 2]
    assert len(found) >= 0.98 * len(copied)
    gone = sum(len(near) - len(left[i]) for i, (_, near) in copied.items())
    assert gone >= 0.95 * sum(len(near) for _, near in copied.values())
    # a paragraph that is equal but for its last words may take some of the document's own
    whole = sum([w for w in out[i] if not w.startswith("p")] == own[i] for i in own)
    assert whole >= 0.97 * len(own)
    assert all(out[i] == dict(docs)[i].split() for i in own if i % 2 == 0)


def test_seeds_of_every_run():
    rnd = np.random.default_rng(3)
    for n in (0, 11, 24, 25, 26, 60, 400):
        words = rnd.integers(0, 1 << 63, n, dtype=np.uint64)
        at, tokens = near_copies.seeds(words, np.array([0, n]))
        assert len(at) == len(tokens)
        starts = set(at.tolist())
        assert all(any(s in starts for s in range(k, k + near_copies.RUN - near_copies.SEED + 1))
                   for k in range(n - near_copies.RUN + 1))
    both = np.concatenate((words[:60], words[100:160], words[:60]))
    at, tokens = near_copies.seeds(both, np.array([0, 60, 60, 120, 180]))
    assert all(a % 60 <= 60 - near_copies.SEED for a in at.tolist())
    assert tokens[at < 60].tolist() == tokens[at >= 120].tolist()


def test_one_word_repeated_gives_few_seeds():
    at, _ = near_copies.seeds(np.full(6400, 7, np.uint64), np.array([0, 6400]))
    assert len(at) <= 101


def test_extent_ends_with_the_copy():
    a, b = list(range(1000, 1040)), list(range(2000, 2040))
    copy = list(range(60))
    changed = copy[:30] + [99] + copy[31:]
    assert near_copies.extent(a + copy + a, 45, b + changed + b, 45) == (40, 100, 40, 100)
    assert near_copies.extent(a + copy[:49] + a, 45, b + copy[:49] + b, 45) is None
    far = copy[:15] + [91] + copy[16:30] + [92] + copy[31:45] + [93] + copy[46:]
    assert near_copies.extent(a + copy + a, 57, b + far + b, 57) is None


def test_edge_texts(docs_of):
    word = "same " * 3000
    docs = [(1, None), (2, ""), (3, word), (4, word), (None, word), (5, "one"), (5, "one")]
    assert {(r.doc_id, r.keep_doc_id) for r in paragraphs.repeated_units(docs_of(docs)).collect()} == {(4, 3)}
    assert paragraphs.repeated_units(docs_of([])).count() == 0
