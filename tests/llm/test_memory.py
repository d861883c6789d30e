"""What operators send to Python workers at once, hold there, and write."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ledgerscope.llm import common, ngram_join, paragraphs


class Steps:
    """Stands for a frame and keeps the step it is given."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self


@pytest.mark.parametrize("step", [paragraphs._anchors, paragraphs._units, paragraphs._bands,
                                  lambda docs: ngram_join._classes(docs, 3)])
def test_a_batch_is_held_in_slices(step):
    rng, words = random.Random(5), [f"w{k}" for k in range(5000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    frame = Steps()
    step(frame)
    tracemalloc.start()
    for _ in frame.run(iter([batch])):
        pass
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 6 * batch.nbytes


def test_words_are_counted_over_a_whole_task(monkeypatch):
    words = np.random.default_rng(1).integers(0, 300, 20_000).astype(np.uint64)
    monkeypatch.setattr(ngram_join, "COUNTED", 700)
    counts = ngram_join.WordCounts()
    for part in np.array_split(words, 50):
        counts.add(part)
    counts.merge()
    found, times = np.unique(words, return_counts=True)
    assert counts.words.tolist() == found.tolist() and counts.times.tolist() == times.tolist()


def test_batches_and_files_of_an_operator(spark):
    docs = spark.range(0, 4000, 1, 40).selectExpr("id", "repeat('abcdefgh ', 300) AS text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    @common.in_small_batches
    def operator(docs, total):
        common.files_for(spark, total)
        most = max(r["n"] for r in docs.coalesce(1).mapInArrow(sizes, "n long").collect())
        return most, common.reliable_checkpoint(docs.select("id"))

    before = spark.conf.get(common.BATCH_KEY)
    most, few = operator(docs, 9 << 20)
    assert most < 2 * common.BATCH_BYTES
    assert few.rdd.getNumPartitions() == 2 and few.count() == 4000
    assert operator(docs, 1 << 30)[1].rdd.getNumPartitions() == 40  # as many as there are partitions
    assert spark.conf.get(common.BATCH_KEY) == before
    assert common.reliable_checkpoint(docs.select("id")).rdd.getNumPartitions() == 40


def test_setting_returns_after_a_failure(spark):
    @common.in_small_batches
    def operator(docs):
        common.files_for(spark, 0)
        raise ValueError

    before = spark.conf.get(common.BATCH_KEY)
    with pytest.raises(ValueError):
        operator(spark.range(1))
    assert spark.conf.get(common.BATCH_KEY) == before and spark.conf.get(common.FILES_KEY, None) is None
