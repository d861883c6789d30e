"""Classifier workflow on Spark ML: pipelines (M6-M8), evaluation (M10-M13),
model choice (M17), artifacts (M18), scoring (D7), feature ranking (D9)
and permutation importance (M16)."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import dense_surrogate_key
from ..functions.permute import ROUNDS, permuted, round_keys
from ..operators import dashboard as dash
from ..operators import metrics
from ..session import reliable_checkpoint

VEC = "features_vec"
SCALED = "features_scaled"
SAMPLE_SCALED = "features_sample_scaled"


@dataclass
class ModelSpec:
    name: str
    pipeline: Pipeline


def standard_scale(d: int, n_rows: int) -> list:
    """M6: stages that take the mean off and divide by the population deviation, as
    scikit-learn does. Spark divides by the sample deviation, larger by one factor for all
    features, which a last stage takes back; a feature without spread becomes 0."""
    factor = math.sqrt(n_rows / (n_rows - 1)) if n_rows > 1 else 1.0
    return [StandardScaler(inputCol=VEC, outputCol=SAMPLE_SCALED, withMean=True, withStd=True),
            ElementwiseProduct(inputCol=SAMPLE_SCALED, outputCol=SCALED, scalingVec=Vectors.dense([factor] * d))]


def lr_pipeline(features: list[str], n_rows: int, C: float = 0.1,
                weight_col: str | None = None) -> ModelSpec:
    """M6 + M7: standardize (fitted on training rows only), then L2 logistic
    regression. scikit-learn minimizes C * sum(loss) + |w|^2 / 2; Spark
    minimizes mean(loss) + regParam * |w|^2 / 2, so regParam = 1 / (C * n)."""
    lr = LogisticRegression(featuresCol=SCALED, labelCol="label", maxIter=1000,
                            regParam=1.0 / (C * max(n_rows, 1)), elasticNetParam=0.0,
                            standardization=False, family="binomial")
    if weight_col:
        lr.setWeightCol(weight_col)
    stages = [VectorAssembler(inputCols=features, outputCol=VEC, handleInvalid="keep"),
              *standard_scale(len(features), n_rows), lr]
    return ModelSpec("Logistic Regression", Pipeline(stages=stages))


def rf_pipeline(features: list[str], num_trees: int = 200, max_depth: int = 12,
                min_leaf: int = 5, seed: int = 42, weight_col: str | None = None) -> ModelSpec:
    """M8: random forest, no scaling; sqrt(#features) per split."""
    rf = RandomForestClassifier(featuresCol=VEC, labelCol="label", numTrees=num_trees,
                                maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=seed,
                                featureSubsetStrategy="sqrt")
    if weight_col:
        rf.setWeightCol(weight_col)
    stages = [VectorAssembler(inputCols=features, outputCol=VEC, handleInvalid="keep"), rf]
    return ModelSpec("Random Forest", Pipeline(stages=stages))


def probability(df: DataFrame) -> F.Column:
    return vector_to_array(F.col("probability"))[1]


def score(df: DataFrame, model: PipelineModel, features: list[str], threshold: float = 0.5,
          keep: list[str] | None = None) -> DataFrame:
    """Align the input to the model's features (D5), then fraud
    probability and the label ``probability >= threshold``. Works on batch
    and streaming DataFrames alike (all stages are row-wise)."""
    aligned = dash.align_features(df, features, keep=keep or [])
    out = model.transform(aligned)
    return out.select(*(keep or []), probability(out).alias("fraud_probability"),
                      (probability(out) >= threshold).cast("int").alias("prediction"))


def evaluate(model: PipelineModel, test: DataFrame, features: list[str]) -> dict:
    """ROC-AUC, PR-AUC (step-sum average precision), confusion cells."""
    scored = score(test, model, features, keep=["label"]).select(
        "label", F.col("fraud_probability").alias("score"), "prediction")
    scored = reliable_checkpoint(scored)
    auc = metrics.roc_auc(scored).first()[0]
    ap = metrics.average_precision(scored).first()[0]
    cm = {(r["actual"], r["predicted"]): r["count"] for r in
          metrics.confusion_matrix(scored, "label", "prediction").collect()}
    return {"roc_auc": auc, "pr_auc": ap,
            "tn": cm.get((0, 0), 0), "fp": cm.get((0, 1), 0),
            "fn": cm.get((1, 0), 0), "tp": cm.get((1, 1), 0)}


def metrics_table(spark: SparkSession, results: dict) -> DataFrame:
    rows = [(name, float(m["roc_auc"] or 0.0), float(m["pr_auc"] or 0.0),
             int(m["tn"]), int(m["fp"]), int(m["fn"]), int(m["tp"]))
            for name, m in results.items()]
    return spark.createDataFrame(rows, "model string, roc_auc double, pr_auc double, "
                                       "tn long, fp long, fn long, tp long")


def top_features(model: PipelineModel, names: list[str], n: int = 15) -> DataFrame:
    """Gini importances (forest) or |coefficients| (logistic regression),
    largest first. The model holds one number per feature."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values, kind = last.featureImportances.toArray().tolist(), "gini"
    else:
        values, kind = [abs(v) for v in last.coefficients.toArray().tolist()], "abs_coef"
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(nm, float(v), kind) for nm, v in zip(names, values)],
                               "feature string, importance double, kind string")
    return df.orderBy(F.desc("importance"), "feature").limit(n)


def save_artifact(model: PipelineModel, path: str, name: str, features: list[str],
                  results: dict) -> None:
    """Spark ML persistence for the pipeline, metadata as one JSON row
    written by Spark (works on shared storage, not a local file)."""
    model.write().overwrite().save(f"{path}/pipeline")
    spark = SparkSession.getActiveSession()
    meta = json.dumps({"model_name": name, "feature_names": features,
                       "metrics": {k: {m: v for m, v in r.items()} for k, r in results.items()}})
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(
        f"{path}/meta")


def load_artifact(path: str) -> tuple[PipelineModel, dict]:
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return PipelineModel.load(f"{path}/pipeline"), meta


def permuted_precision(test: DataFrame, features: list[str], score, n_repeats: int = 10, seed: int = 42,
                       key: str = "transaction_id") -> DataFrame:
    """(fi, rep, ap): the average precision after the values of feature ``fi`` went to other
    rows by permutation ``rep``. ``score`` makes a column ``score`` from the features.

    Rows are numbered densely, and a keyed bijection of the numbers (functions.permute)
    is the permutation, one over all rows at every size. A row emits each of its values
    with the number of the row it goes to; these narrow rows are exchanged and merged with
    the receiving rows in sorted order, so that no side is ever held whole. The round keys
    are data of the rows emitted: the plan is the same for any number of permutations."""
    numbered = reliable_checkpoint(dense_surrogate_key(
        test.select(key, "label", *features), [key], "_row", start=0))
    n = numbered.count()
    rounds = F.array(*[F.struct(
        F.lit(i // n_repeats).alias("fi"), F.lit(i % n_repeats).alias("rep"),
        *[F.lit(k).cast("long").alias(f"k{j}") for j, k in enumerate(round_keys(seed, i))])
        for i in range(len(features) * n_repeats)])
    emitted = numbered.select("_row", F.array(*features).alias("_x"), F.explode(rounds).alias("_m")).select("_row", "_x", "_m.*")
    sent = emitted.select(
        permuted(F.col("_row"), n, [F.col(f"k{j}") for j in range(ROUNDS)]).alias("_to"),
        "fi", "rep", F.get("_x", F.col("fi")).alias("_value"))
    rows = sent.hint("merge").join(numbered, sent["_to"] == numbered["_row"])
    changed = rows.select("fi", "rep", "label", *[
        F.when(F.col("fi") == i, F.col("_value")).otherwise(F.col(f)).alias(f) for i, f in enumerate(features)])
    counts = score(changed).groupBy("fi", "rep", "score").agg(
        F.count(F.when(F.col("label") == 1, 1)).alias("pos"), F.count(F.when(F.col("label") == 0, 1)).alias("neg"))
    return metrics.average_precision_by(counts, ["fi", "rep"])


def importance_table(ap: DataFrame, base_ap: float, features: list[str]) -> DataFrame:
    """Mean and deviation of the drop of average precision per feature, largest first."""
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("fi") + 1)
    drop = F.lit(base_ap) - F.col("average_precision")
    return (ap.groupBy("fi").agg(F.mean(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std"))
            .select(names.alias("feature"), "importance_mean", "importance_std")
            .orderBy(F.desc("importance_mean"), "feature"))


def permutation_importance(model: PipelineModel, test: DataFrame, features: list[str],
                           n_repeats: int = 10, seed: int = 42) -> DataFrame:
    """Mean drop of a model's average precision when one feature's values are
    permuted across rows, over ``n_repeats`` permutations."""
    def by_model(rows):
        return model.transform(rows).select("fi", "rep", "label", probability(rows).alias("score"))

    base = metrics.average_precision(score(test, model, features, keep=["label"]).select(
        "label", F.col("fraud_probability").alias("score"))).first()[0] or 0.0
    return importance_table(permuted_precision(test, features, by_model, n_repeats, seed), base, features)


def model_reports(fitted: dict[str, PipelineModel], test: DataFrame, features: list[str], kind: str,
                  threshold: float = 0.5) -> DataFrame:
    """M12, M14 or M15 of every model: ``kind`` is report, roc or pr."""
    out = None
    for name, model in sorted(fitted.items()):
        scored = score(test, model, features, threshold, keep=["label"]).withColumnRenamed("fraud_probability", "score")
        one = {"report": lambda s: metrics.classification_report(s, "label", "prediction"),
               "roc": metrics.roc_curve, "pr": metrics.pr_curve}[kind](scored)
        one = one.select(F.lit(name).alias("model"), *one.columns)
        out = one if out is None else out.unionByName(one)
    return out
