"""Set links and the n-gram join against brute force."""

import random
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ledgerscope.llm import ngram_join, setlink, shingles

from .conftest import AWKWARD


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def grams(t, size=3):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute_components(sets, factor):
    n = len(sets)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and factor * len(sets[i] ^ sets[j]) <= len(sets[i]) + len(sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(n):
        groups[root(i)].append(i)
    return sorted(sorted(g) for g in groups.values())


def edited_copies(rnd, words, copies, edits):
    out = []
    for _ in range(copies):
        w = list(words)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_codes_of_one_set_only_are_counted_not_held():
    rnd = random.Random(5)
    for factor in (9, 19):
        for _ in range(100):
            base = rnd.sample(range(1000), 40)
            sets = [sorted({*base[rnd.randint(0, 3):], *rnd.sample(range(1000, 1 << 60), rnd.randint(0, 6))})
                    for _ in range(6)] + [rnd.sample(range(1000, 1 << 60), 30)]
            sizes = [len(s) for s in sets]
            whole = setlink.tree_links(list(range(7)), sizes, sets, factor)
            raw = [np.array(sorted(s), "<u8").tobytes() for s in sets]
            shared, left = setlink.only_shared(raw, sizes, factor)
            found = setlink.tree_links(list(range(7)), left, shared, factor)
            assert sets[6] and not shared[6]
            assert len(found) == len(whole)
            assert all(factor * len({*sets[a]} ^ {*sets[b]}) <= sizes[a] + sizes[b] for a, b in found)


@pytest.mark.parametrize("factor", [9, 19])
def test_tree_links(factor):
    rnd = random.Random(factor)
    for _ in range(150):
        base = rnd.sample(range(1000), rnd.randint(3, 60))
        sets = []
        for _ in range(rnd.randint(2, 12)):
            s = set(base)
            for _ in range(rnd.randint(0, 6)):
                s.discard(rnd.choice(base)) if rnd.random() < 0.5 else s.add(rnd.randrange(1000, 1100))
            sets.append(sorted(s))
        sets = [s for s in sets if s]
        if len(sets) < 2:
            continue
        links = setlink.tree_links(list(range(len(sets))), [len(s) for s in sets], sets, factor)
        parent = list(range(len(sets)))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i
        for a, b in links:
            assert factor * len(set(sets[a]) ^ set(sets[b])) <= len(sets[a]) + len(sets[b])
            parent[root(a)] = root(b)
        groups = defaultdict(list)
        for i in range(len(sets)):
            groups[root(i)].append(i)
        assert sorted(sorted(g) for g in groups.values()) == brute_components([set(s) for s in sets], factor)


@pytest.mark.parametrize("small,chunk,with_base", [(96, 256, True), (4, 8, True), (4, 8, False), (2, 1000, False)])
def test_join_equals_brute_force(docs_of, monkeypatch, small, chunk, with_base):
    monkeypatch.setattr(setlink, "SMALL", small)
    monkeypatch.setattr(setlink, "CHUNK", chunk)
    rnd = random.Random(small * 7 + chunk + with_base)
    texts = []
    for g in range(4):
        words = [f"w{g}x{i}" for i in range(rnd.choice([40, 90, 150]))]
        copies = edited_copies(rnd, words, 35, 4)
        texts += ([" ".join(words)] if with_base else []) + [c for c in copies if with_base or c != " ".join(words)]
        texts += copies[:3]
    texts += [" ".join(rnd.choice("a b c d e f".split()) for _ in range(rnd.randint(1, 9))) for _ in range(40)]
    pairs = list(enumerate(texts, 1)) + [(1000 + (i or 500), t) for i, t in AWKWARD] + [(None, AWKWARD[3][1])]
    rnd.shuffle(pairs)
    sets = [grams(t) for _, t in pairs]
    want = {}
    for g in brute_components(sets, 19):
        if len(g) == 1:
            want[g[0]] = pairs[g[0]][0]
        else:
            least = min(pairs[i][0] for i in g if pairs[i][0] is not None)
            want.update({i: least for i in g})
    rows = ngram_join.similar_documents(docs_of(pairs)).collect()
    got = sorted(((r.doc_id or -1, r.n_shingles, r.component_id) for r in rows), key=str)
    assert got == sorted(((pairs[i][0] or -1, len(sets[i]), want[i]) for i in range(len(pairs))), key=str)


def test_nothing(docs_of):
    assert ngram_join.similar_documents(docs_of([])).count() == 0
    assert [tuple(r) for r in ngram_join.similar_documents(docs_of([(5, None)])).collect()] == [(5, 0, 5)]


def test_components(spark):
    rnd = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rnd.randrange(80), 100 + rnd.randrange(80)) for _ in range(60)]
    df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "a binary, b binary")
    got = {bytes(r.node)[0]: bytes(r.root)[0] for r in setlink.components(df).collect() if r.node != r.root}
    sets = defaultdict(set)
    for a, b in edges:
        sets[a].add(b)
        sets[b].add(a)
    for start in sets:
        seen, todo = {start}, [start]
        while todo:
            for x in sets[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got.get(start, start) == min(seen)


def test_rarest_first():
    texts = pa.array(["a b c d", "d c b a x", "", "q"])
    words, _ = shingles.word_hashes(pa.array(["b c d"]))
    ranks = shingles.WordRanks(words.view(np.int64).tolist())
    assert ranks.of(shingles.word_hashes(texts)[0]).tolist() == [0, 1, 2, 3, 3, 2, 1, 0, 0, 0]
    for (plain, ordered), own in zip(shingles.rarest_first(texts, 3, ranks), shingles.gram_sets(texts, 3)):
        assert plain.tolist() == own.tolist() and sorted(ordered.tolist()) == own.tolist()
    first = list(shingles.rarest_first(pa.array(["a b c d"]), 3, ranks))[0][1][0]
    assert first in shingles.gram_hashes(shingles.word_hashes(pa.array(["a b c"]))[0], 3)


def test_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small}/documents.parquet')")
    cur = con.execute(ngram_join.OP5_SQL)
    cols = [d[0] for d in cur.description]
    rows = ngram_join.op5_ngram_join(spark, small).select(*cols).collect()
    assert sorted(map(tuple, rows)) == sorted(cur.fetchall())


def test_sets_meet_sets_of_like_size_only(spark):
    """Copies of one text at all lengths: just those of which one has 90 % of the other are linked,
    and sets that share tokens, but differ in size, form no block."""
    pairs, want = [], {}
    for k, n in enumerate([*range(3, 40), 60, 99, 100, 101, 190, 200, 1000]):
        words = [f"w{k}x{i}" for i in range(n + 2)]
        for j, m in enumerate((n, -(-9 * n // 10), -(-9 * n // 10) - 1, n // 3)):
            pairs.append((4 * k + j, " ".join(words[:m + 2]) if m > 0 else None))
        for a, b in ((0, 1), (0, 2), (1, 2)):
            sizes = sorted(len(grams(pairs[4 * k + x][1])) for x in (a, b))
            want[4 * k + a, 4 * k + b] = sizes[0] > 0 and 100 * sizes[0] >= 90 * sizes[1]
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_documents(
        spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    for (a, b), linked in want.items():
        assert not linked or found[a] == found[b]
        assert linked or found[a] != found[b] or want.get((a, a + 1)) and want.get((a + 1, a + 2))

    records = spark.createDataFrame([(t, s, True) for t in range(10) for s in (1, 2, 3)], "token long, sid long, core boolean")
    needs = spark.createDataFrame([(1, 100, 2), (2, 1000, 2), (3, 105, 2)], "sid long, n long, need int")
    members = setlink.members_of(setlink.reliable_checkpoint(records), needs, 19).collect()
    assert sorted((r["pivot"], r["sid"]) for r in members) == [(1, 1), (1, 3)]
