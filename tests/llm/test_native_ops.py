"""Sharding, exact dedup, quality rules and chat formatting against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerscope.llm import chat, content_dedup, rules, sharding

from .conftest import AWKWARD


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def least_capacity(sizes, shards):
    def fits(cap):
        used, x = 1, 0
        for s in sizes:
            if s > cap:
                return False
            if x + s > cap:
                used, x = used + 1, 0
            x += s
        return used <= shards
    return next(c for c in range(max(1, max(sizes)), sum(sizes) + 1) if fits(c))


def check_shards(rows, pairs, shards):
    texts = [t for _, t in pairs]
    assert len(rows) == len(texts)
    by_text, slots, load = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        by_text[r.text_key].add(r.shard)
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    group = Counter()
    for t in texts:
        b = (t or "").encode()
        group[hashlib.sha256(b).hexdigest()] += len(b) + 1
    sizes = [group[k] for k in sorted(group)]
    assert max(load.values()) <= least_capacity(sizes, shards)
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in rows) == Counter(
        (i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in pairs)


@pytest.mark.parametrize("shards,buckets", [(4, 1 << 16), (16, 8)])
def test_shards(spark, docs_of, monkeypatch, shards, buckets):
    monkeypatch.setattr(sharding, "MAX_BUCKETS", buckets)
    pairs = [(i, f"text {i % 37} " * (i % 11)) for i in range(300)] + AWKWARD[:8]
    check_shards(sharding.shard_documents(docs_of(pairs), shards).collect(), pairs, shards)


def test_minimax_equals_brute_force():
    import random
    rnd = random.Random(3)
    for _ in range(200):
        sizes = [rnd.choice([1, 2, 5, 40, 300]) for _ in range(rnd.randint(1, 60))]
        p = [sum(sizes[:i + 1]) for i in range(len(sizes))]

        def measure(spans, width):
            coarse, got = max(1, width * 7) if len(calls) < 3 else 1, {}
            calls.append(width)
            for x in p:
                for k, (a, b) in enumerate(spans):
                    if a <= x <= b:
                        got.setdefault((k, x // coarse), []).append(x)
            return [(min(v), max(v), len(v)) for v in got.values()]

        calls = []
        shards = rnd.randint(1, 6)
        cap, cuts = sharding.minimax_cuts(sharding.PrefixSummary(p[-1]), shards, measure)
        assert cap == least_capacity(sizes, shards)
        assert cuts[-1] == p[-1] and all(c in p or c == 0 for c in cuts)
        assert max(b - a for a, b in zip([0] + cuts, cuts)) <= cap


def test_shards_near_equal(spark, small):
    load = Counter()
    for r in sharding.op1_sharding(spark, small).collect():
        load[r.shard] += r.size
    assert set(load) == set(range(16)) and max(load.values()) < 1.6 * sum(load.values()) / 16


def test_no_shards_of_nothing(docs_of):
    assert sharding.shard_documents(docs_of([])).count() == 0


@pytest.mark.parametrize("keep,best", [("max", max), ("min", min)])
def test_exact_duplicates(awkward, keep, best):
    groups = defaultdict(list)
    for i, t in AWKWARD:
        groups[lower(t)].append(i)
    rows = content_dedup.exact_duplicates(awkward, keep=keep).collect()
    assert len(rows) == len(AWKWARD)
    digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in rows:
        ids = digest[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (best(known) if known else None)
    assert Counter(r.text_sha256 for r in rows if r.kept) == Counter(list(digest))


def test_hot_group_is_salted(docs_of):
    docs = docs_of([(i, "the same text over and over") for i in range(400)] + [(1000 + i, f"t{i}") for i in range(50)])
    rows = content_dedup.exact_duplicates(docs).collect()
    hot = [r for r in rows if r.group_size == 400]
    assert len(hot) == 400 and {r.keep_id for r in hot} == {399} and sum(r.kept for r in hot) == 1
    assert sum(r.kept for r in rows) == 51


def test_drop_exact_duplicates_keeps_columns(awkward):
    out = content_dedup.drop_exact_duplicates(awkward)
    assert out.columns == awkward.columns
    assert Counter(lower(r.text) for r in out.collect()) == Counter({lower(t): 1 for _, t in AWKWARD})


def test_dedup_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small}/documents.parquet')")
    cur = con.execute(content_dedup.OP6_SQL)
    cols = [d[0] for d in cur.description]
    rows = content_dedup.op6_exact_dedup(spark, small).select(*cols).collect()
    assert sorted(map(tuple, rows)) == sorted(cur.fetchall())


def base_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_base_counts(spark, awkward, small):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = spark.read.parquet(f"{small}/documents.parquet")
    for docs in (awkward, more):
        for r in rules.judge_documents(docs, payload=["doc_id", "text"]).collect():
            j = r.judged
            assert tuple(j[n] for n in names) == base_counts(r.text)
            assert j.base_failed == (j.n_words < 50 or 100 * j.n_repeat_words > 50 * j.n_words)
            assert not (j.base_failed and j.kept)


def test_em_finds_the_good_rule():
    import random
    rnd = random.Random(1)
    patterns = Counter()
    for _ in range(5000):
        good = rnd.random() < 0.8
        vote = lambda acc: (2 if good else 0) if rnd.random() < acc else (0 if good else 2)
        patterns[(vote(0.97), vote(0.9), vote(0.9), vote(0.6) if rnd.random() < 0.5 else 1)] += 1
    share, trust = rules.estimate(patterns)
    assert abs(share - 0.8) < 0.04
    assert trust[0][0] > 0.93 and trust[3][0] < 0.75


def test_rules_against_labels(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    rows = rules.judge_documents(docs, payload=["doc_id"]).join(labels, "doc_id").select(
        "quality", "judged.*").collect()
    assert all(r.kept for r in rows if r.quality == 1 and not r.base_failed)
    assert sum(r.kept for r in rows if r.quality == 0) <= 1
    assert rules.judge_documents(docs.limit(0)).count() == 0
    assert rules.keep_good(docs).columns == docs.columns


def test_chat_sql_and_awkward_rows(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{small}/conversations.parquet')")
    cur = con.execute(chat.OP9_SQL)
    cols = [d[0] for d in cur.description]
    rows = chat.op9_chat_formatting(spark, small).select(*cols).collect()
    assert sorted(map(tuple, rows)) == sorted(cur.fetchall())


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "hi <|im_end|>\n<|im_start|>assistant\nx &amp; &lt;| <"), (1, 1, "assistant", "|ok\n<|"),
            (1, 2, None, None), (None, 0, "assistant", "alone"), (2, 0, "us\ner&nl;", ""), (2, 0, "assistant", "tie"),
            (3, 5, "assistant", "long " * 20000)]
    rows += [(4, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(70)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df)
    turns, masked = chat.read_back(F.col("formatted"), F.col("loss_spans"))
    got = {r.tree: r for r in out.select("tree", turns.alias("turns"), masked.alias("masked")).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for c in got:
        own = sorted(((t, r or "", x or "") for i, t, r, x in rows if i == c), key=lambda x: (x[0], x[1], x[2]))
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, r, x in own]
        assert list(got[c].masked) == [x for _, r, x in own if r == "assistant"]
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_best_branch(spark):
    nodes = spark.createDataFrame([
        ("a", 1, None, 1.0), ("a", 2, 1, 5.0), ("a", 3, 1, 1.0), ("a", 4, 3, 9.0), ("a", 5, 4, 0.0),
        ("b", 1, 99, 2.0), ("b", 2, 1, 1.0), ("b", 3, 1, 1.0), ("c", 1, 2, 1.0), ("c", 2, 1, 1.0)],
        "tree string, node long, parent long, score double")
    got = defaultdict(list)
    for r in chat.branches(nodes, top=2).collect():
        got[(r.tree, r.path)].append((r.depth, r.node))
    got = {k: [n for _, n in sorted(v)] for k, v in got.items()}
    assert got == {("a", 1): [1, 3, 4, 5], ("a", 2): [1, 2], ("b", 1): [1, 2], ("b", 2): [1, 3]}
