"""The factorisation machine: the pair identity, held-out accuracy, odd inputs."""

import zlib

import numpy as np
import pyarrow as pa

from ledgerscope.llm import fm

from .conftest import AWKWARD


def test_margin_is_the_sum_over_pairs():
    rnd = np.random.default_rng(2)
    model = fm.FactorisationMachine(0, 1, 0.3, rnd.normal(size=50), rnd.normal(size=(50, 4)))
    idx, val, ends = rnd.integers(0, 50, 12), rnd.normal(size=12), np.array([5, 5, 12])
    got, _ = model.margin(idx, val, ends)
    for d, (a, b) in enumerate(zip([0, 5, 5], ends)):
        i, x = idx[a:b], val[a:b]
        want = 0.3 + (model.linear[i] * x).sum()
        for p in range(len(i)):
            for q in range(p):
                want += model.factors[i[p]] @ model.factors[i[q]] * x[p] * x[q]
        assert abs(want - got[d]) < 1e-9


def test_features_do_not_depend_on_neighbours():
    texts = [t for _, t in AWKWARD]
    together = fm.featurize(pa.array(texts, pa.string()), np.zeros(len(texts)))
    begins = np.concatenate(([0], together[2][:-1]))
    for k, t in enumerate(texts):
        alone = fm.featurize(pa.array([t], pa.string()), np.zeros(1))
        assert (alone[0] == together[0][begins[k]:together[2][k]]).all()
        assert np.allclose(alone[3][0], together[3][k])


def test_held_out_rows(spark):
    rows = fm.op4_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    auc = np.mean([[g > b for b in bad] for g in good])
    assert auc > 0.97 and np.mean([p == y for y, _, p in held]) > 0.93


def test_odd_inputs(spark, awkward, docs_of):
    labels = spark.createDataFrame([(4, 1), (10, 0), (9, 0), (None, 1), (2, None)], "doc_id long, quality int")
    model = fm.fit_quality(awkward, labels)
    rows = fm.score_documents(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 9}) == 1
    assert fm.score_documents(docs_of([]), model).count() == 0
    none = fm.fit_quality(awkward, labels.limit(0))
    assert none is None and {r.score for r in fm.score_documents(awkward, none).collect()} == {0.5}
    ones = fm.fit_quality(awkward, spark.createDataFrame([(4, 1), (5, 1)], "doc_id long, quality int"))
    assert all(r.score > 0.5 for r in fm.score_documents(awkward, ones).collect())
    bare = awkward.drop("n_chars")
    assert fm.score_documents(bare, model).count() == len(AWKWARD)
