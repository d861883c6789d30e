"""Classifier metrics as DataFrame jobs.

Rows are first reduced to one row per distinct score (positives and
negatives per score, partial aggregation map-side). Curves and areas are
cumulative sums over that reduced table, ordered by score descending.
``average_precision`` is the step sum of scikit-learn (not Spark's
trapezoid ``areaUnderPR``); ``roc_auc`` is the Mann-Whitney statistic with
ties counted one half, which equals the trapezoidal ROC area.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import count_if, safe_div
from ..functions.scans import prefix_scan, score_digits

# Metric values are sums of non-integer terms; round away summation-order noise.
METRIC_DIGITS = 12


def score_counts(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row per distinct score: positives and negatives at that score."""
    return scored.groupBy(F.col(score).alias("score")).agg(
        count_if(F.col(label) == 1).alias("pos"),
        count_if(F.col(label) == 0).alias("neg"),
    )


def _cumulative(counts: DataFrame) -> DataFrame:
    """Cumulative tp/fp at each threshold (score >= t), plus totals.

    A model's scores are nearly all distinct, so the per-score table grows with the scored
    rows; the running sums are a scan over digits of the score (functions.scans) instead
    of one un-partitioned window. The totals are one row, joined by broadcast."""
    cum = prefix_scan(counts, [], score_digits("score"), ["score"], {"pos": "tp", "neg": "fp"}, descending=True)
    tot = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return cum.join(F.broadcast(tot)).select("score", "pos", "neg", "tp", "fp", "P", "N")


def roc_auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """M10. Terms are half-integers, so the sum is exact in any order."""
    cum = _cumulative(score_counts(scored, score, label))
    term = F.col("pos") * (F.col("N") - F.col("fp") + F.col("neg") * 0.5)
    return cum.agg(F.round(safe_div(F.sum(term), F.max("P") * F.max("N")),
                           METRIC_DIGITS).alias("roc_auc"))


def average_precision(scored: DataFrame, score: str = "score",
                      label: str = "label") -> DataFrame:
    """Sum over thresholds of (R_i - R_{i-1}) * P_i."""
    cum = _cumulative(score_counts(scored, score, label))
    term = safe_div("pos", "P") * safe_div("tp", F.col("tp") + F.col("fp"))
    return cum.agg(F.round(F.sum(term), METRIC_DIGITS).alias("average_precision"))


def average_precision_by(counts: DataFrame, keys: list[str]) -> DataFrame:
    """M11 per group, from counts (keys, score, pos, neg): one scan for all groups."""
    cum = prefix_scan(counts, keys, score_digits("score"), ["score"], {"pos": "tp", "neg": "fp"}, descending=True)
    term = F.col("pos").cast("double") * safe_div("tp", F.col("tp") + F.col("fp"))
    return cum.groupBy(*keys).agg(F.round(safe_div(F.sum(term), F.sum("pos")), METRIC_DIGITS).alias("average_precision"))


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, and the start point
    (0, 0), whose threshold is above all scores and given as null."""
    cum = _cumulative(score_counts(scored, score, label))
    curve = cum.select(F.col("score").alias("threshold"),
                       safe_div("fp", "N").alias("fpr"),
                       safe_div("tp", "P").alias("tpr"))
    return curve.unionByName(_end_point(curve, fpr=0.0, tpr=0.0)).orderBy(F.desc_nulls_first("threshold"))


def _end_point(curve: DataFrame, **values: float) -> DataFrame:
    types = dict(curve.dtypes)
    return curve.sparkSession.range(1).select(
        F.lit(None).cast(types["threshold"]).alias("threshold"),
        *[F.lit(v).cast(types[k]).alias(k) for k, v in values.items()])


def pr_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, recall, precision) at every distinct score, and the end
    point (0, 1), whose threshold is above all scores and given as null."""
    cum = _cumulative(score_counts(scored, score, label))
    curve = cum.select(F.col("score").alias("threshold"),
                       safe_div("tp", "P").alias("recall"),
                       safe_div("tp", F.col("tp") + F.col("fp")).alias("precision"))
    return curve.unionByName(_end_point(curve, recall=0.0, precision=1.0)).orderBy(F.desc_nulls_first("threshold"))


def _cells(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    a, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return pred.agg(
        count_if((a == 0) & (p == 0)).alias("tn"), count_if((a == 0) & (p == 1)).alias("fp"),
        count_if((a == 1) & (p == 0)).alias("fn"), count_if((a == 1) & (p == 1)).alias("tp"))


def confusion_matrix(pred: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """All four (actual, predicted) cells, zeros included (one
    aggregate, then ``stack``; no grid join)."""
    return _cells(pred, label, prediction).select(F.expr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, count)"))


def classification_report(pred: DataFrame, label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Precision / recall / F1 / support per class ('Legit', 'Fraud'),
    accuracy, macro and weighted averages; 0 where a ratio is undefined."""
    cells = _cells(pred, label, prediction)

    def z(x):
        return F.coalesce(x, F.lit(0.0))

    p1, r1 = z(safe_div("tp", F.col("tp") + F.col("fp"))), z(safe_div("tp", F.col("tp") + F.col("fn")))
    p0, r0 = z(safe_div("tn", F.col("tn") + F.col("fn"))), z(safe_div("tn", F.col("tn") + F.col("fp")))
    f1 = z(safe_div(p1 * r1 * 2, p1 + r1))
    f0 = z(safe_div(p0 * r0 * 2, p0 + r0))
    s1, s0 = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    n = s0 + s1
    m = cells.select(
        p0.alias("p0"), r0.alias("r0"), f0.alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1.alias("f1"), s1.alias("s1"),
        z(safe_div(F.col("tp") + F.col("tn"), n)).alias("acc"), n.alias("n"))
    wavg = "(({a} * s0 + {b} * s1) / CAST(n AS DOUBLE))"
    return m.select(F.expr(
        "stack(5, "
        "'Legit', p0, r0, f0, s0, "
        "'Fraud', p1, r1, f1, s1, "
        "'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n, "
        "'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n, "
        f"'weighted avg', {wavg.format(a='p0', b='p1')}, {wavg.format(a='r0', b='r1')}, "
        f"{wavg.format(a='f0', b='f1')}, n"
        ") AS (class, precision, recall, f1_score, support)"))


def threshold_grid_bucket(score: str = "score") -> F.Column:
    """Largest i in [-1, 100] with i/100 <= score (exact, despite
    binary fractions)."""
    s = F.col(score)
    i = F.floor(s * 100)
    i = F.when((i + 1).cast("double") / 100 <= s, i + 1).otherwise(i)
    i = F.when(i.cast("double") / 100 > s, i - 1).otherwise(i)
    return F.greatest(F.least(i, F.lit(100)), F.lit(-1)).cast("int")


def threshold_sweep(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Confusion counts, precision and recall at thresholds 0.01..0.99
    (prediction = score >= threshold). Rows are bucketed to the grid first
    (at most 102 groups), so the sweep never pairs rows with thresholds."""
    spark: SparkSession = scored.sparkSession
    counts = scored.groupBy(threshold_grid_bucket(score).alias("i")).agg(
        count_if(F.col(label) == 1).alias("pos"), count_if(F.col(label) == 0).alias("neg"))
    grid = spark.range(-1, 101).select(F.col("id").cast("int").alias("i"))
    desc = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    g = grid.join(F.broadcast(counts), "i", "left").na.fill(0, ["pos", "neg"])
    g = g.select(
        "i", F.sum("pos").over(desc).alias("tp"), F.sum("neg").over(desc).alias("fp"),
        F.sum("pos").over(whole).alias("P"), F.sum("neg").over(whole).alias("N"))
    out = g.where((F.col("i") >= 1) & (F.col("i") <= 99)).select(
        (F.col("i").cast("double") / 100).alias("threshold"),
        F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
        (F.col("P") - F.col("tp")).cast("long").alias("fn"),
        (F.col("N") - F.col("fp")).cast("long").alias("tn"),
        F.coalesce(safe_div("tp", F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"),
        F.coalesce(safe_div("tp", "P"), F.lit(0.0)).alias("recall"))
    return out.orderBy("threshold")


def select_best(metrics: DataFrame, by: str = "pr_auc") -> DataFrame:
    """The model row with the largest ``by`` (ties by model name)."""
    return metrics.orderBy(F.desc(by), "model").limit(1)
