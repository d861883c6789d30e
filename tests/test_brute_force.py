"""Scale-oriented operators against brute force on small inputs."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerscope.functions.keys import dense_surrogate_key
from ledgerscope.functions.selection import portable_hash, smallest_k
from ledgerscope.ml.smote import _ask, exact_knn, smote, synthetic_rows
from ledgerscope.operators import metrics
from ledgerscope.plans.ml_plans import stratified_split, split_test_counts


def test_dense_key_equals_row_number(spark):
    df = spark.range(0, 5000).select(F.concat(F.lit("R"), F.xxhash64("id").cast("string"))
                                     .alias("ref"))
    got = dense_surrogate_key(df, ["ref"], "rid", start=11, num_partitions=7)
    want = df.select("ref", (F.row_number().over(Window.orderBy("ref")) + 10).alias("rid"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_smallest_k_equals_sorted_hash(spark):
    df = spark.range(1, 3001).withColumnRenamed("id", "tid").withColumn("g", F.col("tid") % 3)
    got = smallest_k(df, {0: 17, 1: 400, 2: 5000}, "tid", 7, group="g")
    ranked = df.withColumn("_h", portable_hash("tid", 7)).withColumn(
        "rn", F.row_number().over(Window.partitionBy("g").orderBy("_h", "tid")))
    want = ranked.where(((F.col("g") == 0) & (F.col("rn") <= 17))
                        | ((F.col("g") == 1) & (F.col("rn") <= 400)) | (F.col("g") == 2))
    assert sorted(r.tid for r in got.collect()) == sorted(r.tid for r in want.collect())


def test_stratified_split_counts(spark):
    df = spark.range(1, 1001).select(F.col("id").alias("transaction_id"),
                                     (F.col("id") % 50 == 0).cast("int").alias("label"))
    out = stratified_split(df)
    got = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count()
           .collect()}
    assert split_test_counts({0: 980, 1: 20}) == {0: 196, 1: 4}
    assert got[(0, "test")] == 196 and got[(1, "test")] == 4


def _points(spark, n=300, d=4, dup=40, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1, 10, 100, 0.1]
    x[:dup] = x[0]  # a hot group of identical rows
    cols = [f"f{i}" for i in range(d)]
    rows = [(i + 1, *map(float, x[i]), 1) for i in range(n)]
    df = spark.createDataFrame(rows, ["transaction_id", *cols, "label"])
    return df, x, cols


def test_exact_knn_equals_brute_force(spark):
    df, x, cols = _points(spark)
    got = exact_knn(df, cols, "transaction_id", 5, 42, block_rows=32)
    nb = {}
    for r in got.collect():
        nb.setdefault(r.transaction_id, {})[r.nrank] = r.dist
    d2 = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    np.fill_diagonal(d2, np.inf)
    want = np.sort(d2, axis=1)[:, :5]
    for i in range(len(x)):
        assert np.allclose([nb[i + 1][k] for k in range(1, 6)], want[i], atol=1e-9)
    # equal distances go by id, as one sort of all pairs would have it
    order = {i: [j + 1 for j in np.lexsort((np.arange(len(x)), d2[i]))[:5]] for i in range(len(x))}
    rows = {}
    for r in got.collect():
        rows.setdefault(r.transaction_id, {})[r.nrank] = r.nbr
    assert all([rows[i + 1][k] for k in range(1, 6)] == order[i] for i in range(len(x)))


def test_few_groups_are_asked(spark):
    """50,000 rows: a row asks under one in twenty groups, and the answers are exact."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(60, 6)) * 40
    x = centres[rng.integers(0, 60, 50_000)] + rng.normal(size=(50_000, 6))
    cols = [f"f{i}" for i in range(6)]
    frame = spark.createDataFrame(pd.DataFrame(x, columns=cols).assign(transaction_id=np.arange(50_000)))
    stage, member, groups = _ask(frame, cols, "transaction_id", 5, 42, 1024)
    asked = stage.where("grp >= 0").count()
    assert groups > 40 and asked < 0.05 * groups * 50_000
    assert member.groupBy("grp").count().agg({"count": "max"}).first()[0] <= 3 * 1024
    got = exact_knn(frame, cols, "transaction_id", 5, 42).where("transaction_id % 1000 = 7").collect()
    by = {}
    for r in got:
        by.setdefault(r.transaction_id, {})[r.nrank] = (r.nbr, r.dist)
    assert len(by) == 50
    for i, own in by.items():
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        best = np.lexsort((np.arange(50_000), d))[:5]
        assert [own[k][0] for k in range(1, 6)] == best.tolist()


def test_smote_balances_and_interpolates(spark):
    df, x, cols = _points(spark, n=60, dup=5)
    legit = spark.createDataFrame([(1000 + i, 0.0, 0.0, 0.0, 0.0, 0) for i in range(200)],
                                  ["transaction_id", *cols, "label"])
    train = df.unionByName(legit)
    syn = synthetic_rows(train, cols, "label", "transaction_id", 5, 42, block_rows=16)
    assert syn.count() == 200 - 60
    whole = smote(train.withColumn("other", F.lit("o")), cols, "label", "transaction_id", 5, 42, block_rows=16)
    counts = {(r.label, r.synthetic): r["count"] for r in whole.groupBy("label", "synthetic").count().collect()}
    assert counts == {(0, False): 200, (1, False): 60, (1, True): 140}
    added = whole.where("synthetic")
    assert sorted(map(tuple, added.select("transaction_id", *cols).collect())) == sorted(
        map(tuple, syn.select("transaction_id", *cols).collect()))
    assert added.where("other IS NULL AND transaction_id < 0").count() == 140
    assert whole.select("transaction_id").distinct().count() == 400
    knn = {(r.transaction_id, r.nbr) for r in
           exact_knn(df, cols, "transaction_id", 5, 42, block_rows=16).collect()}
    for r in syn.collect():
        assert r.transaction_id < 0 and (r.src, r.nbr) in knn and 0.0 <= r._u < 1.0
        a, b = x[r.src - 1], x[r.nbr - 1]
        assert np.allclose([r[c] for c in cols], a + r._u * (b - a))


def test_average_precision_matches_step_sum(spark):
    rng = np.random.default_rng(0)
    y = (rng.random(400) < 0.2).astype(int)
    s = np.round(rng.random(400) * 0.5 + y * 0.3, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    order = np.argsort(-s, kind="stable")
    ap, tp, fp, prev_r = 0.0, 0, 0, 0.0
    for t in sorted(set(s), reverse=True):
        m = s == t
        tp += int(y[m].sum())
        fp += int((1 - y[m]).sum())
        r = tp / y.sum()
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    assert abs(metrics.average_precision(df).first()[0] - ap) < 1e-9
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (
        len(pos) * len(neg))
    assert abs(metrics.roc_auc(df).first()[0] - auc) < 1e-9
    assert order is not None
