"""The pipeline's passage stage against a brute-force finder of common runs of 50 words."""

import corpus_pipeline

from .test_copied_runs import brute_cover


def test_common_runs_are_removed(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect() if r.text}
    out = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["substring_dedup"](spark, docs, small).collect()}
    cover = brute_cover(texts.items())
    assert cover
    for i, words in cover.items():
        assert len((out.get(i) or "").split()) <= len(texts[i].split()) - len(words)
    assert all(i in cover for i in texts if i not in out and len(texts[i].split()) >= 50)
