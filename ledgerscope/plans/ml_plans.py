"""Training-data operators of the classifier workflow (M1-M4, M9, S2) and
their registry entries. Model fitting lives in ``ledgerscope.ml``."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.selection import (portable_hash_sql, smallest_k, smallest_k_condition,
                                   stratum_sizes)
from ..operators import dashboard as dash
from ..schemas import FEATURE_COLS, SEED_TYPE_NAMES, TYPE_DUMMIES

SAMPLE_COLS = ["transaction_id", "type_name", *FEATURE_COLS, "is_fraud"]
N_LEGIT = 500_000
TEST_SIZE = "0.2"
SEED = 42


def sample_exact(df: DataFrame, n: int, key: str = "transaction_id", seed: int = SEED) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, reproducible
    (smallest portable hash of ``key``)."""
    return smallest_k(df, {None: n}, key, seed)


def case_control_sample(features: DataFrame, n_legit: int = N_LEGIT,
                        seed: int = SEED) -> DataFrame:
    """M1: every fraud row plus ``n_legit`` legitimate rows drawn without
    replacement, pruned to the training columns."""
    cols = features.select(*SAMPLE_COLS)
    fraud = cols.where(F.col("is_fraud"))
    legit = smallest_k(cols.where(~F.col("is_fraud")), {None: n_legit}, "transaction_id", seed)
    return fraud.unionByName(legit)


def feature_matrix(sample: DataFrame) -> DataFrame:
    """M2/M3: fifteen features and five type dummies as DOUBLE with NULL ->
    0, and the integer label."""
    labelled = sample.withColumn("label", F.col("is_fraud").cast("int"))
    return dash.align_features(labelled, FEATURE_COLS + TYPE_DUMMIES, keep=["transaction_id", "label"])


def split_test_counts(sizes: dict, test_size: str = TEST_SIZE) -> dict:
    """ceil(test_size * n) per label, in exact arithmetic."""
    frac = Fraction(test_size)
    return {g: -((-n * frac.numerator) // frac.denominator) for g, n in sizes.items()}


def stratified_split(df: DataFrame, label: str = "label", test_size: str = TEST_SIZE,
                     seed: int = SEED, key: str = "transaction_id") -> DataFrame:
    """M4: add ``split`` = 'test' for the ceil(test_size * n_label) rows of
    each label with the smallest portable hash, else 'train'. Exact
    per-label counts; no per-label window (labels are two huge groups)."""
    k = split_test_counts(stratum_sizes(df, label), test_size)
    hashed, cond = smallest_k_condition(df, k, key, seed, group=label)
    return hashed.select(*df.columns, F.when(cond, "test").otherwise("train").alias("split"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """M9: scikit-learn's balanced weights n / (2 * n_label)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    from pyspark.sql import Window
    total = F.sum("count").over(Window.partitionBy())
    return counts.select(label, "count",
                         (total.cast("double") / (F.col("count") * 2)).alias("weight"))


def with_class_weights(df: DataFrame, label: str = "label", col: str = "weight") -> DataFrame:
    """Attach M9 weights as a column (two-row table, broadcast)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(col))
    return df.join(F.broadcast(w), label)


# ── registry entries ────────────────────────────────────────────────────────
def _sample_sql(n_legit: int = N_LEGIT) -> str:
    cols = ", ".join(SAMPLE_COLS)
    h = portable_hash_sql("transaction_id", SEED)
    return f"""sample AS (
  SELECT {cols} FROM ml_features WHERE is_fraud
  UNION ALL
  SELECT {cols} FROM (
    SELECT {cols}, row_number() OVER (ORDER BY {h}, transaction_id) AS rn
    FROM ml_features WHERE NOT is_fraud) l
  WHERE rn <= {n_legit}
)"""


_MATRIX_SQL = ",\n".join(
    [f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in FEATURE_COLS]
    + [f"CASE WHEN type_name = '{n}' THEN 1.0 ELSE 0.0 END AS type_{n}" for n in SEED_TYPE_NAMES])

_MATRIX_CTE = f"""matrix AS (
  SELECT transaction_id, {_MATRIX_SQL}, CAST(is_fraud AS INTEGER) AS label FROM sample
)"""

_SPLIT_CTE = f"""split AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY label
                      ORDER BY {portable_hash_sql('transaction_id', SEED)}, transaction_id)
                   <= CEIL(0.2 * COUNT(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split
  FROM matrix
)"""


def training_frames(L):
    """(feature matrix with split column) for the fixture layers."""
    return stratified_split(feature_matrix(case_control_sample(L.ml_features)))


def register_all(register, pct_sql) -> None:
    @register("case_control_sample", "M1", extra_ctes=_sample_sql(), sql="SELECT * FROM sample")
    def _m1(L):
        return case_control_sample(L.ml_features)

    @register("case_control_1000", "M1", extra_ctes=_sample_sql(1000), sql="SELECT * FROM sample")
    def _m1_drawn(L):
        return case_control_sample(L.ml_features, 1000)

    @register("case_control_counts", "M1", extra_ctes=_sample_sql(), sql=f"""
SELECT is_fraud, COUNT(*) AS rows, {pct_sql('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 4)} AS pct
FROM sample GROUP BY is_fraud""")
    def _m1c(L):
        s = case_control_sample(L.ml_features)
        from pyspark.sql import Window
        c = s.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("rows"))
        from ..functions.exprs import pct
        return c.select("is_fraud", "rows",
                        pct("rows", F.sum("rows").over(Window.partitionBy()), 4).alias("pct"))

    @register("feature_matrix", "M2/M3", extra_ctes=_sample_sql() + ",\n" + _MATRIX_CTE,
              sql="SELECT * FROM matrix")
    def _m2(L):
        return feature_matrix(case_control_sample(L.ml_features))

    @register("stratified_split", "M4",
              extra_ctes=_sample_sql() + ",\n" + _MATRIX_CTE + ",\n" + _SPLIT_CTE,
              sql="SELECT transaction_id, label, split FROM split")
    def _m4(L):
        return training_frames(L).select("transaction_id", "label", "split")

    @register("class_weights", "M9",
              extra_ctes=_sample_sql() + ",\n" + _MATRIX_CTE + ",\n" + _SPLIT_CTE, sql="""
SELECT label, COUNT(*) AS count, CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / (COUNT(*) * 2) AS weight
FROM split WHERE split = 'train' GROUP BY label""")
    def _m9(L):
        return class_weights(training_frames(L).where(F.col("split") == "train"))
