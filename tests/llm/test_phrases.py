"""Phrase mining against counting everything in memory, and against SQL."""

import random
import re
from collections import Counter, defaultdict

import pytest

from ledgerscope.llm import phrases
from tests.compare import duck, same


def brute(rows, min_count, top):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            words = [w for w in re.split(r"[\x20\x09]", piece) if w]
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    count[lang, tuple(words[i:i + m])] += 1
    often = {k: a for k, a in count.items() if a >= min_count and len(k[1]) > 1}
    gone = set()
    for (lang, longer), b in often.items():
        for m in range(2, len(longer)):
            for i in range(len(longer) - m + 1):
                part = (lang, longer[i:i + m])
                if 100 * b >= 80 * often[part]:
                    gone.add(part)
    found = defaultdict(list)
    for (lang, p), a in often.items():
        if (lang, p) not in gone:
            score, k = min((2_000_000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k) for k in range(1, len(p)))
            found[lang].append((-score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, own in found.items()
                  for i, (s, a, p, x, y) in enumerate(sorted(own)[:top]))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 5, 0.5) for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, a long, score double")


def random_rows(seed, n=60):
    rnd = random.Random(seed)
    bag = ["the"] * 30 + "of a in Of A new york city \x01x ab\x02 é ß straße İ x-y 12 日本".split()
    joins = [" "] * 12 + ["  ", "\t", ", ", ". ", "\n", "\x0b", "! ?"]
    return [(rnd.choice(["en", "en", "en", "de", "und", None]),
             "".join(rnd.choice(bag) + rnd.choice(joins) for _ in range(rnd.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("seed, bits, stream_rows", [(1, 27, 400_000), (2, 8, 7), (3, 10, 3)])
def test_equals_counting(spark, seed, bits, stream_rows):
    rows = random_rows(seed) + [("en", None), ("en", ""), ("fr", "one two"), (None, " \t\n")]
    rows += [("en", "copied passage that many rows hold, again and again")] * 40
    got = phrases.mine_phrases(frame(spark, rows), 3, 50, filter_bits=bits, stream_rows=stream_rows).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 50)


def test_frequent_first_word_over_many_partitions(spark):
    rows = [("en", " ".join(f"the w{i} the w{i + 1}" for i in range(400))), ("en", "the the the the the")] * 3
    got = phrases.mine_phrases(frame(spark, rows), 3, 2000, stream_rows=40).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 2000)


def test_ties_and_small_tables(spark):
    rows = [("en", "b a. a b. c d. D C")] * 3
    got = phrases.mine_phrases(frame(spark, rows), 3, 3).orderBy("rank").collect()
    assert [r.phrase for r in got] == ["a b", "b a", "c d"] and sorted(map(tuple, got)) == brute(rows, 3, 3)
    assert phrases.mine_phrases(frame(spark, rows).limit(0)).collect() == []
    assert phrases.mine_phrases(frame(spark, [("en", None)] * 3), 1).collect() == []


def test_long_text_and_slices(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_BYTES", 1000)
    rows = random_rows(9, 30) + [("en", "the new york city of " * 40_000)]
    got = phrases.mine_phrases(frame(spark, rows), 3, 50).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 50)


def test_counts_beyond_64_bits(spark):
    stream = spark.createDataFrame([(4 * 10 ** 13, 5 * 10 ** 13)], "a long, d long")
    row = stream.selectExpr(f"(cast(a as decimal(20,0)) * cast({phrases.SCORE_UNIT} as decimal(7,0))) div cast(d as decimal(20,0)) s")
    assert row.first().s == 1_600_000


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    same(phrases.op11_phrase_mining(spark, sf), duck(sf), phrases.OP11_SQL)
