"""Registry entries of the model workflow.

Training runs once per (application, input) and is reused by the entries.
SMOTE's class counts and exact neighbours have SQL oracles (brute force);
fitted-model outputs are checked by rows and by pytest.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..functions.permute import A, P, round_keys
from ..ml import models
from ..ml.smote import exact_knn, smote
from ..ml.workflow import MODEL_FEATURES, train_models
from ..schemas import FEATURE_COLS, SEED_TYPE_NAMES
from .layers import fixture_layers, layer_path
from .ml_plans import (_MATRIX_CTE, _SPLIT_CTE, _sample_sql, case_control_sample, feature_matrix,
                       training_frames)

_TRAINED: dict = {}


def trained(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _TRAINED:
        layers = fixture_layers(spark, sf_dir)
        _TRAINED[key] = train_models(layers.ml_features,
                                     layer_path(spark, sf_dir, "clean", "artifacts"))
    return _TRAINED[key]


_VEC_DIST = " + ".join(
    [f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATURE_COLS]
    + [f"(a.type_{n} - b.type_{n}) * (a.type_{n} - b.type_{n})" for n in SEED_TYPE_NAMES])

_TRAIN_CTES = _sample_sql() + ",\n" + _MATRIX_CTE + ",\n" + _SPLIT_CTE


#: Features that the signal score looks at, and permutations of each.
SIGNAL_FEATURES = ["amount", "dest_balance_mismatch", "sender_drained", "dest_was_empty", "sender_txns_same_step",
                   "sender_amount_zscore"]
SIGNAL_REPEATS = 3


def signal_scores(rows):
    """The share of raised signals as a score; amounts are doubles here."""
    raised = ((F.col("sender_drained") == 1).cast("int") + (F.col("dest_was_empty") == 1).cast("int")
              + (F.col("dest_balance_mismatch") > F.col("amount") * 0.05).cast("int")
              + (F.col("sender_txns_same_step") > 3).cast("int") + (F.col("sender_amount_zscore") > 2.5).cast("int"))
    return rows.withColumn("score", raised.cast("double") / 5)


_SIGNAL_SQL = """CAST(CAST(sender_drained = 1 AS INTEGER) + CAST(dest_was_empty = 1 AS INTEGER)
  + CAST(dest_balance_mismatch > amount * 0.05 AS INTEGER) + CAST(sender_txns_same_step > 3 AS INTEGER)
  + CAST(sender_amount_zscore > 2.5 AS INTEGER) AS DOUBLE) / 5"""


def _permuted_ctes() -> str:
    """SQL of all permutations: the side lengths come from the row count, a round adds a
    function of one half to the other, and four more passes walk on what lies beyond n."""
    keys = ", ".join(f"({i}, {', '.join(map(str, round_keys(42, i)))})"
                     for i in range(len(SIGNAL_FEATURES) * SIGNAL_REPEATS))

    def mixed(value, key, size):
        return f"((((({value} + {key}) % {P}) * {A} % {P}) + {key}) * {A} % {P}) % {size}"

    walk = []
    for step in range(5):
        src = "start" if step == 0 else f"walk{step - 1}"
        walk.append(f"""walk{step} AS (SELECT * EXCLUDE (l, r), CASE WHEN {step} > 0 AND x < n THEN x ELSE l + a * r END AS x FROM (
  SELECT * REPLACE ((r + {mixed('l', 'k3', 'b')}) % b AS r) FROM (
  SELECT * REPLACE ((l + {mixed('r', 'k2', 'a')}) % a AS l) FROM (
  SELECT * REPLACE ((r + {mixed('l', 'k1', 'b')}) % b AS r) FROM (
  SELECT * REPLACE ((l + {mixed('r', 'k0', 'a')}) % a AS l) FROM (
  SELECT *, x % a AS l, x // a AS r FROM {src}))))))""".replace(
            "SELECT * EXCLUDE (l, r), CASE", "SELECT * EXCLUDE (l, r, x), CASE"))
    values = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in SIGNAL_FEATURES)
    swapped = ", ".join(f"CASE WHEN m.fi = {i} THEN s.{c} ELSE t.{c} END AS {c}" for i, c in enumerate(SIGNAL_FEATURES))

    def cumulative(name, src, keys):
        by, over = (f"{keys}, ", f"PARTITION BY {keys} ") if keys else ("", "")
        return f"""{name} AS (SELECT *, SUM(pos) OVER ({over}) AS p,
  SUM(pos) OVER ({over}ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
  SUM(neg) OVER ({over}ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
  FROM (SELECT {by}score, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label = 0) AS neg
        FROM {src} GROUP BY {by}score) c)"""

    return ",\n".join([
        f"""numbered AS (SELECT row_number() OVER (ORDER BY transaction_id) - 1 AS row, CAST(is_fraud AS INTEGER) AS label,
  {values} FROM ml_features)""",
        f"keys AS (SELECT * FROM (VALUES {keys}) v(which, k0, k1, k2, k3))",
        """size AS (SELECT n, CAST(ceil(sqrt(n)) AS BIGINT) AS a,
  CAST(ceil(n / ceil(sqrt(n))) AS BIGINT) AS b FROM (SELECT COUNT(*) AS n FROM numbered))""",
        "start AS (SELECT row, which, k0, k1, k2, k3, n, a, b, row AS x FROM numbered, keys, size)",
        *walk,
        f"""scored_perm AS (SELECT fi, rep, label, {_SIGNAL_SQL} AS score FROM (
  SELECT m.fi, m.rep, t.label, {swapped} FROM (
    SELECT row AS src, x AS dest, which // {SIGNAL_REPEATS} AS fi, which % {SIGNAL_REPEATS} AS rep FROM walk4) m
  JOIN numbered s ON s.row = m.src JOIN numbered t ON t.row = m.dest) z)""",
        f"scored_base AS (SELECT label, {_SIGNAL_SQL} AS score FROM numbered)",
        cumulative("pcum", "scored_perm", "fi, rep"), cumulative("bcum", "scored_base", "")])


_PERMUTED = _permuted_ctes()
_SPREAD_SQL = ", ".join(f"AVG({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in FEATURE_COLS)
_SCALED_SQL = ", ".join(
    f"ROUND(CASE WHEN d_{c} > 0 THEN ({c} - m_{c}) / d_{c} ELSE 0.0 END + 0.0, 6) AS {c}" for c in FEATURE_COLS)


def register_models(register) -> None:
    @register("smote_class_counts", "M5", raw=True, bench=False, extra_ctes=_TRAIN_CTES, sql="""
SELECT label, MAX(COUNT(*)) OVER () AS count FROM split WHERE split = 'train' GROUP BY label""")
    def _m5_counts(spark, sf_dir):
        train = training_frames(fixture_layers(spark, sf_dir)).where(
            F.col("split") == "train").drop("split")
        return (smote(train, MODEL_FEATURES).groupBy("label")
                .agg(F.count(F.lit(1)).alias("count")))

    @register("smote_neighbors", "M5", raw=True, bench=False, extra_ctes=_TRAIN_CTES + """,
mino AS (SELECT * FROM split WHERE split = 'train' AND label = 1)""", sql=f"""
SELECT transaction_id, nbr, CAST(nrank AS INTEGER) AS nrank FROM (
  SELECT a.transaction_id, b.transaction_id AS nbr,
         row_number() OVER (PARTITION BY a.transaction_id
                            ORDER BY sqrt({_VEC_DIST}), b.transaction_id) AS nrank
  FROM mino a JOIN mino b ON a.transaction_id <> b.transaction_id) x
WHERE nrank <= 5""")
    def _m5_knn(spark, sf_dir):
        split = training_frames(fixture_layers(spark, sf_dir))
        mino = split.where((F.col("split") == "train") & (F.col("label") == 1))
        return exact_knn(mino, MODEL_FEATURES, "transaction_id", 5, 42).select(
            "transaction_id", "nbr", "nrank")

    @register("train_evaluate", "M6-M8/M10-M13", raw=True, bench=False)
    def _train(spark, sf_dir):
        r = trained(spark, sf_dir)
        return models.metrics_table(spark, r.results)

    @register("select_best_model", "M17", raw=True, bench=False)
    def _best(spark, sf_dir):
        r = trained(spark, sf_dir)
        return models.metrics_table(spark, r.results).orderBy(F.desc("pr_auc"), "model").limit(1)

    @register("score_test", "D7/M18", raw=True, bench=False)
    def _score(spark, sf_dir):
        r = trained(spark, sf_dir)
        model, meta = models.load_artifact(f"{r.artifact_path}/fraud_model")
        return models.score(r.test, model, meta["feature_names"], 0.5,
                            keep=["transaction_id", "label"])

    @register("top_features", "D9", raw=True, bench=False)
    def _top(spark, sf_dir):
        r = trained(spark, sf_dir)
        return models.top_features(r.best, MODEL_FEATURES, 15)

    @register("permutation_importance", "M16", raw=True, bench=False)
    def _perm(spark, sf_dir):
        r = trained(spark, sf_dir)
        return models.permutation_importance(r.fitted["Logistic Regression"], r.test,
                                             MODEL_FEATURES, 10, 42)

    @register("signal_importance", "M16", bench=False, extra_ctes=_PERMUTED, sql=f"""
SELECT feature, ROUND(AVG(base - ap), 9) AS importance_mean, ROUND(stddev_pop(base - ap), 9) AS importance_std
FROM (SELECT fi, rep, ROUND(SUM(CAST(pos AS DOUBLE) / p * (CAST(tp AS DOUBLE) / (tp + fp))), 12) AS ap
      FROM pcum GROUP BY fi, rep) a
JOIN (SELECT unnest(range(0, {len(SIGNAL_FEATURES)})) AS fi, unnest({SIGNAL_FEATURES}) AS feature) f USING (fi)
CROSS JOIN (SELECT ROUND(SUM(CAST(pos AS DOUBLE) / p * (CAST(tp AS DOUBLE) / (tp + fp))), 12) AS base FROM bcum) b
GROUP BY feature""")
    def _signal_perm(L):
        """M16 of the model-free signal score, so that SQL can follow every permutation."""
        rows = L.ml_features.select("transaction_id", F.col("is_fraud").cast("int").alias("label"), *[
            F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in SIGNAL_FEATURES])
        base = models.metrics.average_precision(signal_scores(rows)).first()[0]
        ap = models.permuted_precision(rows, SIGNAL_FEATURES, signal_scores, SIGNAL_REPEATS, 42)
        out = models.importance_table(ap, base, SIGNAL_FEATURES)
        return out.select("feature", F.round("importance_mean", 9).alias("importance_mean"),
                          F.round("importance_std", 9).alias("importance_std"))

    @register("standard_scale", "M6", bench=False, extra_ctes=_sample_sql() + ",\n" + _MATRIX_CTE, sql=f"""
SELECT transaction_id, {_SCALED_SQL} FROM matrix,
       (SELECT {_SPREAD_SQL} FROM matrix) s""")
    def _scale(L):
        matrix = feature_matrix(case_control_sample(L.ml_features))
        fitted = Pipeline(stages=[VectorAssembler(inputCols=FEATURE_COLS, outputCol=models.VEC),
                                  *models.standard_scale(len(FEATURE_COLS), matrix.count())]).fit(matrix)
        x = models.vector_to_array(models.SCALED)
        return fitted.transform(matrix).select("transaction_id", *[
            F.round(x[i], 6).alias(c) for i, c in enumerate(FEATURE_COLS)])

    for kind, sid in (("report", "M12"), ("roc", "M14"), ("pr", "M15")):
        @register(f"model_{kind}", f"{sid}/models", raw=True, bench=False)
        def _report(spark, sf_dir, kind=kind):
            r = trained(spark, sf_dir)
            return models.model_reports(r.fitted, r.test, MODEL_FEATURES, kind)
