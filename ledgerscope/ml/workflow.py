"""End-to-end training run (the reference's ``main``): case-control sample
-> feature matrix -> stratified split -> SMOTE (or class weights) -> logistic
regression and random forest -> evaluation -> best by PR-AUC -> artifacts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ml_plans import (N_LEGIT, case_control_sample, feature_matrix, stratified_split,
                              with_class_weights)
from ..schemas import FEATURE_COLS, TYPE_DUMMIES
from ..session import reliable_checkpoint
from . import models
from .smote import smote

MODEL_FEATURES = FEATURE_COLS + TYPE_DUMMIES


@dataclass
class TrainResult:
    split: DataFrame
    train: DataFrame
    test: DataFrame
    fitted: dict
    results: dict
    best_name: str
    artifact_path: str

    @property
    def best(self) -> PipelineModel:
        return self.fitted[self.best_name]


def train_models(ml_features: DataFrame, artifact_path: str, n_legit: int = N_LEGIT,
                 use_smote: bool = True, rf_trees: int = 200, rf_depth: int = 12,
                 seed: int = 42) -> TrainResult:
    """Fit both models and keep the one with the larger PR-AUC.

    The split feature matrix (all fraud + n_legit rows: bounded by the
    sample) is checkpointed once, since every later step reads it.
    """
    split = reliable_checkpoint(stratified_split(
        feature_matrix(case_control_sample(ml_features, n_legit, seed)), seed=seed))
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    weight = None
    if use_smote:
        train = smote(train, MODEL_FEATURES, "label", "transaction_id", 5, seed)
    else:
        train, weight = with_class_weights(train), "weight"
    train = reliable_checkpoint(train)
    n = train.count()
    specs = [models.lr_pipeline(MODEL_FEATURES, n, 0.1, weight),
             models.rf_pipeline(MODEL_FEATURES, rf_trees, rf_depth, 5, seed, weight)]
    fitted, results = {}, {}
    for spec in specs:
        fitted[spec.name] = spec.pipeline.fit(train)
        results[spec.name] = models.evaluate(fitted[spec.name], test, MODEL_FEATURES)
    best = max(results, key=lambda k: (results[k]["pr_auc"] or 0.0, k))
    models.save_artifact(fitted[best], f"{artifact_path}/fraud_model", best, MODEL_FEATURES,
                         results)
    for name, model in fitted.items():
        model.write().overwrite().save(f"{artifact_path}/{name.lower().replace(' ', '_')}")
    return TrainResult(split, train, test, fitted, results, best, artifact_path)
