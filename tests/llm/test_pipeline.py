"""Every stage of the corpus pipeline on what the stage before kept, against brute force."""

import pytest

import corpus_pipeline

from .conftest import AWKWARD
from .test_ngram_join import brute_components, grams, lower

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    ids = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == COLUMNS
        rows = {r.doc_id: r.text for r in out.collect()}
        assert out.count() == len(rows) and set(rows) <= set(ids)
        if name == "exact_dedup":
            last = {}
            for i, t in ids.items():
                last[lower(t)] = max(i, last.get(lower(t), -1))
            assert set(rows) == set(last.values())
        if name == "near_dedup":
            order = sorted(ids)
            groups = brute_components([grams(ids[i], 5) for i in order], 9)
            assert set(rows) == {order[g[0]] for g in groups}
        if name == "substring_dedup":
            assert all(len(rows[i]) <= len(ids[i]) for i in rows)
        else:
            assert all(rows[i] == ids[i] for i in rows)
        docs = spark.createDataFrame(out.collect(), docs.schema)
        ids = rows
    name, stage = corpus_pipeline.STAGES[-1]
    pieces = stage(spark, docs, small).collect()
    assert {r.doc_id for r in pieces} == set(ids)


def test_run_is_its_stages(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.count() > 0 and "sequence_id" in rows.columns
    per_doc = {}
    for r in rows.collect():
        per_doc.setdefault(r.doc_id, [0, r.doc_tokens])[0] += r.length
    assert all(a == b for a, b in per_doc.values())


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_awkward_tables(spark, docs_of, small, rows):
    docs = docs_of(rows)
    for name, stage in corpus_pipeline.STAGES[1:]:  # the rules leave none of these short texts
        out = stage(spark, docs, small)
        if name != "packing":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
        else:
            assert (out.count() > 0) == bool(rows)
    assert corpus_pipeline.STAGES[0][1](spark, docs_of(rows), small).columns == docs.columns
