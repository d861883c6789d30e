"""Scaling, both models, scoring, artifacts and importances against their definitions."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerscope.functions.permute import permuted, round_keys, sides
from ledgerscope.ml import models
from ledgerscope.operators import metrics

COLS = ["a", "b", "c"]


def data(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 50.0, 0.01] + [0, 100, 5]
    y = (x[:, 0] + (x[:, 1] - 100) / 50 + rng.normal(size=n) > 0.5).astype(int)
    return x, y


@pytest.fixture(scope="module")
def frame(spark):
    x, y = data()
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))],
                                 "transaction_id long, a double, b double, c double, label int").repartition(4).cache()


@pytest.fixture(scope="module")
def lr(frame):
    return models.lr_pipeline(COLS, frame.count()).pipeline.fit(frame)


@pytest.fixture(scope="module")
def rf(frame):
    return models.rf_pipeline(COLS, 12, 4).pipeline.fit(frame)


def test_scaling_is_by_the_population(frame, lr):
    x, _ = data()
    out = {r.transaction_id: r.v for r in lr.transform(frame).select(
        "transaction_id", vector_to_array(models.SCALED).alias("v")).collect()}
    got = np.array([out[i] for i in range(len(x))])
    assert np.allclose(got, (x - x.mean(0)) / x.std(0), atol=1e-9)
    assert models.standard_scale(2, 1)[1].getScalingVec().toArray().tolist() == [1.0, 1.0]


def test_logistic_regression_is_the_least_regularised_loss(frame, lr):
    """scikit-learn's objective, C * sum(loss) + |w|^2 / 2, by Newton's method."""
    x, y = data()
    z = (x - x.mean(0)) / x.std(0)
    w, b, c = np.zeros(3), 0.0, 0.1
    for _ in range(50):
        p = 1 / (1 + np.exp(-(z @ w + b)))
        grad = np.append(c * z.T @ (p - y) + w, c * (p - y).sum())
        h = np.zeros((4, 4))
        zz = np.column_stack((z, np.ones(len(z))))
        h[:] = c * (zz * (p * (1 - p))[:, None]).T @ zz
        h[:3, :3] += np.eye(3)
        step = np.linalg.solve(h, grad)
        w, b = w - step[:3], b - step[3]
    fitted = lr.stages[-1]
    assert np.allclose(fitted.coefficients.toArray(), w, atol=1e-3) and fitted.intercept == pytest.approx(b, abs=1e-3)
    got = {r.transaction_id: r for r in models.score(frame, lr, COLS, 0.4, keep=["transaction_id"]).collect()}
    p = 1 / (1 + np.exp(-(z @ fitted.coefficients.toArray() + fitted.intercept)))
    for i, r in got.items():
        assert r.fraud_probability == pytest.approx(p[i], abs=1e-9) and r.prediction == int(r.fraud_probability >= 0.4)


def test_forest_learns_and_ranks_features(frame, rf):
    scored = models.score(frame, rf, COLS, keep=["label"]).withColumnRenamed("fraud_probability", "score")
    assert metrics.roc_auc(scored).first()[0] > 0.9
    last = rf.stages[-1]
    assert last.getNumTrees == 12 and max(t.depth for t in last.trees) <= 4
    top = models.top_features(rf, COLS, 2).collect()
    values = dict(zip(COLS, last.featureImportances.toArray()))
    assert [r.feature for r in top] == sorted(COLS, key=lambda c: -values[c])[:2] and top[0].kind == "gini"
    assert sum(values.values()) == pytest.approx(1.0)


def test_importances_of_the_regression(lr):
    top = models.top_features(lr, COLS).collect()
    w = dict(zip(COLS, np.abs(lr.stages[-1].coefficients.toArray())))
    assert [(r.feature, r.kind) for r in top] == [(c, "abs_coef") for c in sorted(COLS, key=lambda c: -w[c])]


def test_artifact_round_trip(spark, frame, lr, tmp_path):
    results = {"Logistic Regression": models.evaluate(lr, frame, COLS)}
    models.save_artifact(lr, f"{tmp_path}/m", "Logistic Regression", COLS, results)
    again, meta = models.load_artifact(f"{tmp_path}/m")
    assert meta["feature_names"] == COLS and meta["metrics"] == results and meta["model_name"] == "Logistic Regression"
    one = models.score(frame, lr, COLS, keep=["transaction_id"]).collect()
    two = models.score(frame, again, COLS, keep=["transaction_id"]).collect()
    assert sorted(one) == sorted(two)


def test_missing_and_null_features_are_zero(spark, lr):
    rows = spark.createDataFrame([(1, 1.0, None)], "transaction_id long, a double, b double")
    full = spark.createDataFrame([(1, 1.0, 0.0, 0.0)], "transaction_id long, a double, b double, c double")
    assert models.score(rows, lr, COLS).collect() == models.score(full, lr, COLS).collect()


def test_reports_of_every_model(frame, lr, rf):
    fitted = {"lr": lr, "rf": rf}
    for name, model in fitted.items():
        scored = models.score(frame, model, COLS, keep=["label"]).withColumnRenamed("fraud_probability", "score")
        for kind, want in (("report", metrics.classification_report(scored, "label", "prediction")),
                           ("roc", metrics.roc_curve(scored)), ("pr", metrics.pr_curve(scored))):
            got = models.model_reports(fitted, frame, COLS, kind).where(F.col("model") == name).drop("model")
            assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 16, 17, 1000, 5000])
def test_permutations_are_bijections(spark, n):
    a, b = sides(n)
    assert n <= a * b and a * b - n < a
    seen = set()
    for which in (0, 1):
        keys = [F.lit(k).cast("long") for k in round_keys(42, which)]
        got = [r.p for r in spark.range(n).orderBy("id").select(permuted(F.col("id"), n, keys).alias("p")).collect()]
        assert sorted(got) == list(range(n))
        seen.add(tuple(got))
    if n >= 1000:
        assert len(seen) == 2
        moved = np.array(got)
        assert abs(np.corrcoef(np.arange(n), moved)[0, 1]) < 0.1 and (moved == np.arange(n)).mean() < 0.02


def test_permutation_importance_by_hand(spark):
    rnd = random.Random(5)
    rows = [(i, float(rnd.random()), float(rnd.random()), int(rnd.random() < 0.3)) for i in range(500)]
    rows = [(i, a + 0.5 * y, b, y) for i, a, b, y in rows]
    df = spark.createDataFrame(rows, "transaction_id long, a double, b double, label int")

    def score(d):
        return d.withColumn("score", F.col("a") + 0.1 * F.col("b"))

    def precision(pairs):
        tp = n = total = 0
        for s in sorted({s for s, _ in pairs}, reverse=True):
            here = [y for t, y in pairs if t == s]
            tp, n = tp + sum(here), n + len(here)
            total += sum(here) * tp / n
        return total / tp

    got = {(r.fi, r.rep): r.average_precision for r in models.permuted_precision(df, ["a", "b"], score, 2, 9).collect()}
    for f in (0, 1):
        for rep in (0, 1):
            keys = [F.lit(k).cast("long") for k in round_keys(9, f * 2 + rep)]
            to = [r.p for r in spark.range(500).orderBy("id").select(permuted(F.col("id"), 500, keys).alias("p")).collect()]
            new = [list(r[1:3]) for r in rows]
            for i, j in enumerate(to):
                new[j][f] = rows[i][1 + f]
            want = precision([(v[0] + 0.1 * v[1], r[3]) for v, r in zip(new, rows)])
            assert got[f, rep] == pytest.approx(want, abs=1e-9)
    base = metrics.average_precision(score(df)).first()[0]
    table = models.importance_table(models.permuted_precision(df, ["a", "b"], score, 2, 9), base, ["a", "b"]).collect()
    assert [r.feature for r in table] == ["a", "b"] and table[0].importance_mean > table[1].importance_mean
    assert math.isclose(table[0].importance_mean, base - (got[0, 0] + got[0, 1]) / 2)


def test_importance_of_a_fitted_model(frame, lr):
    out = {r.feature: r.importance_mean for r in models.permutation_importance(lr, frame, COLS, 3).collect()}
    assert out["a"] > 0.05 and out["b"] > 0.05 and abs(out["c"]) < 0.05


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_moved_values_are_merged_not_broadcast(spark, frame):
    plan = _plan(models.permuted_precision(frame, COLS, lambda d: d.withColumn("score", F.col("a") + F.col("b")), 2))
    assert "strategy=merge" in plan and "collect_list" not in plan


def test_plan_does_not_grow_with_the_permutations(spark, frame):
    plans = [_plan(models.permuted_precision(frame, COLS, lambda d: d.withColumn("score", F.col("a") + F.col("b")), r))
             for r in (1, 8)]
    assert plans[0].count("aggregate(") == plans[1].count("aggregate(") > 0
