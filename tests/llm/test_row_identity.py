"""Identifiers that several texts share, and input columns with the operators' own names."""

import random

import pytest

import corpus_pipeline
from ledgerscope.llm import content_dedup, ngram_join, paragraphs, rules

from .test_ngram_join import brute_components, grams


def words(seed, n):
    rnd = random.Random(seed)
    return [f"{rnd.choice('abcdefgh')}{rnd.randint(0, 9999)}" for _ in range(n)]


def text(seed, n, change=()):
    own = words(seed, n)
    for k in change:
        own[k] = "changed"
    return " ".join(own)


def test_near_copies_beside_other_texts(spark, docs_of):
    a, a2 = text(1, 200), text(1, 200, [50])
    b, b2 = text(2, 200), text(2, 200, [90])
    out = ngram_join.keep_one_of_each(docs_of([(1, a), (2, a2), (2, b), (3, b2)])).collect()
    assert sorted((r.doc_id, r.text) for r in out) == [(1, a), (2, b)]


def test_near_copies_with_one_identifier(docs_of):
    a, a2, other = text(1, 200), text(1, 200, [50]), text(5, 80)
    out = ngram_join.keep_one_of_each(docs_of([(7, a), (7, a2), (7, other), (7, other), (None, a), (8, None)])).collect()
    texts = sorted((str(r.doc_id), r.text or "") for r in out)
    assert [t for t in texts if t[1] not in (a, a2)] == sorted([("7", other), ("7", other), ("8", "")])
    assert len([t for t in texts if t[0] == "7" and t[1] in (a, a2)]) == 1 and ("None", a) in texts


@pytest.mark.parametrize("seed", [3, 4])
def test_near_dedup_equals_brute_force(spark, docs_of, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randint(1, 12), text(rnd.randint(1, 6), 120, rnd.sample(range(120), rnd.randint(0, 2)))) for _ in range(40)]
    rows = sorted(set(rows))
    hashes = {r.text: r.h for r in docs_of(rows).selectExpr("text", "xxhash64(text) h").collect()}
    order = sorted(rows, key=lambda r: (r[0], hashes[r[1]]))
    groups = brute_components([grams(t, 5) for _, t in order], 9)
    got = corpus_pipeline.near_dedup(spark, docs_of(rows), "").collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(order[min(g)] for g in groups)


def test_passages_beside_unrelated_texts(spark, docs_of):
    passage, own, foreign = text(1, 90), text(2, 30), text(3, 120)
    rows = [(1, passage), (2, own + " " + passage), (2, foreign), (3, foreign + " " + own)]
    out = corpus_pipeline.substring_dedup(spark, docs_of(rows), "").collect()
    assert sorted((r.doc_id, r.text.strip()) for r in out) == [(1, passage), (2, own), (2, foreign), (3, own)]


def test_passages_of_texts_with_one_identifier(docs_of):
    passage = text(1, 90)
    rows = [(2, text(2, 40) + " " + passage), (2, text(3, 40) + " " + passage)]
    out = [r.text for r in paragraphs.drop_passages(docs_of(rows)).collect()]
    assert sum(passage in t for t in out) == 1 and {" ".join(t.split()[:40]) for t in out} == {text(2, 40), text(3, 40)}


def test_query_names_documents(spark, docs_of, tmp_path):
    passage = text(1, 90)
    docs_of([(5, passage), (9, "own words " + passage), (9, text(4, 60))]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = paragraphs.op3_substring_dedup(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.keep_doc_id) for r in rows} == {(9, 5)} and max(r.end_word for r in rows) == 92


def test_columns_with_the_operators_names(spark, docs_of):
    good = " ".join(["Plain words about nothing in particular that a person may read."] * 1 + words(3, 90))
    docs = docs_of([(1, good), (2, good), (3, None)]).selectExpr(
        "*", "1 as judged", "2 as _code", "0.5 as _posterior", "'s' as _spans", "5 as _spans_of", "6 as key", "7 as sid",
        "8 as component_id", "9 as doc_key", "10 as large", "11 as at", "12 as run", "'g' as grp")
    for stage in (rules.keep_good, content_dedup.drop_exact_duplicates, ngram_join.keep_one_of_each, paragraphs.drop_passages):
        out = stage(docs)
        assert out.columns == docs.columns
        rows = out.collect()
        assert all((r.judged, r._code, r._spans, r["key"], r.grp) == (1, 2, "s", 6, "g") for r in rows)
    judged = rules.judge_documents(docs)
    assert judged.columns.count("judged") == 1 and judged.select("judged.kept").count() == 3


def test_verdicts_are_the_same_with_and_without_texts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    narrow = {r.doc_id: r.judged for r in rules.judge_documents(docs, payload=["doc_id"]).collect()}
    wide = {r.doc_id: r.judged for r in rules.judge_documents(docs).collect()}
    assert narrow == wide
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, small).collect()}
    assert kept == {i for i, j in narrow.items() if j.kept}
