"""Data behind the dashboard pages (D1-D6, D8); the UI itself is not built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import pct
from ..functions.selection import smallest_k
from ..schemas import FEATURE_COLS, SEED_TYPE_NAMES, SUM_MONEY

HIGH_RATE_PCT = 5.0


def kpi_summary(by_type: DataFrame) -> DataFrame:
    """Totals over the fraud-by-type rows; fraud volume NULL -> 0; rate
    in percent (3 dp) with a zero-total guard."""
    agg = by_type.agg(
        F.sum("total_transactions").cast("long").alias("total_txns"),
        F.sum("fraud_count").cast("long").alias("total_fraud"),
        F.sum("total_volume").cast(SUM_MONEY).alias("total_volume"),
        F.coalesce(F.sum("fraud_volume"), F.lit(0)).cast(SUM_MONEY).alias("fraud_volume"),
    )
    return agg.select("*", F.coalesce(pct("total_fraud", "total_txns", 3), F.lit(0.0))
                      .alias("fraud_rate_pct"))


def high_rate_types(by_type: DataFrame, threshold_pct: float = HIGH_RATE_PCT) -> DataFrame:
    """Flag types whose fraud rate exceeds ``threshold_pct``."""
    return by_type.select("type_name", "fraud_rate_pct",
                          (F.col("fraud_rate_pct") > threshold_pct).alias("is_high_rate"))


def type_table(by_type: DataFrame) -> DataFrame:
    """D3: the per-type table as displayed."""
    return by_type.select(F.col("type_name").alias("Type"),
                          F.col("total_transactions").alias("Total"),
                          F.col("fraud_count").alias("Fraud"),
                          F.col("fraud_rate_pct").alias("Fraud %"))


def risky_table(risky: DataFrame) -> DataFrame:
    """D3: risky senders as displayed: rate as 'x.y%', volume as '$1,234'."""
    return risky.select(
        F.col("account_ref").alias("Account"),
        F.col("total_txn_count").alias("Total Txns"),
        F.col("fraud_count").alias("Fraud Txns"),
        F.concat(F.round(F.col("fraud_rate") * 100, 2).cast("string"), F.lit("%"))
        .alias("Fraud Rate"),
        F.concat(F.lit("$"), F.format_number(F.col("total_amount").cast("double"), 0))
        .alias("Total Volume"),
        F.col("unique_recipients").alias("Unique Recipients"),
    )


def balanced_sample(features: DataFrame, n: int = 5000, seed: int = 42) -> DataFrame:
    """N // 2 fraud rows and n // 2 legitimate rows, each the first by
    a portable hash of the transaction id (a reproducible LIMIT), selected
    by radix cutoff rather than a single-task top-k."""
    half = n // 2
    return smallest_k(features, {True: half, False: half}, "transaction_id", seed,
                      group="is_fraud")


def derive_request_features(req: DataFrame) -> DataFrame:
    """The five derived features from raw request fields."""
    pre_s, post_s = F.col("sender_balance_pre"), F.col("sender_balance_post")
    pre_r, post_r = F.col("recip_balance_pre"), F.col("recip_balance_post")
    return req.select(
        "*",
        (pre_s - post_s).alias("sender_balance_drop"),
        (post_r - pre_r).alias("recipient_balance_gain"),
        F.abs(F.col("amount") - (post_r - pre_r)).alias("dest_balance_mismatch"),
        F.when(post_s == 0, 1).otherwise(0).alias("sender_drained"),
        F.when(pre_r == 0, 1).otherwise(0).alias("dest_was_empty"),
    )


def one_hot_type(df: DataFrame, type_col: str = "type_name",
                 names: list[str] = SEED_TYPE_NAMES) -> DataFrame:
    """M3: ``type_<NAME>`` 0/1 columns for a fixed list of names; an unknown
    type gives all zeros."""
    return df.select("*", *[F.when(F.col(type_col) == n, 1.0).otherwise(0.0).alias(f"type_{n}")
                            for n in names])


def align_features(df: DataFrame, names: list[str], type_col: str | None = "type_name",
                   keep: list[str] | None = None) -> DataFrame:
    """Exactly the model's feature columns as DOUBLE: present ones with
    NULL -> 0, missing ones 0, type dummies only for types the model knows."""
    known_types = [n[len("type_"):] for n in names if n.startswith("type_")]
    if type_col and known_types and type_col in df.columns:
        df = one_hot_type(df, type_col, known_types)
    cols = []
    for name in names:
        if name in df.columns:
            cols.append(F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name))
        else:
            cols.append(F.lit(0.0).alias(name))
    return df.select(*(keep or []), *cols)


def signal_columns() -> list:
    """The five rule signals of the scoring page; an unknown value raises none."""
    return [
        F.coalesce(F.col("sender_drained") == 1, F.lit(False)).alias("sig_drained"),
        F.coalesce(F.col("dest_was_empty") == 1, F.lit(False)).alias("sig_empty_dest"),
        F.coalesce(F.col("dest_balance_mismatch") > F.col("amount") * F.lit(0.05).cast("decimal(3,2)"),
                   F.lit(False)).alias("sig_mismatch"),
        F.coalesce(F.col("sender_txns_same_step") > 3, F.lit(False)).alias("sig_velocity"),
        F.coalesce(F.col("sender_amount_zscore") > 2.5, F.lit(False)).alias("sig_anomalous"),
    ]


def risk_signals(features: DataFrame) -> DataFrame:
    """The five rule signals, per transaction."""
    return features.select("transaction_id", "is_fraud", *signal_columns())


SIGNALS = ["sig_drained", "sig_empty_dest", "sig_mismatch", "sig_velocity", "sig_anomalous"]


def signal_score(features: DataFrame) -> DataFrame:
    """A model-free score in [0, 1]: the share of the five signals raised.
    Used to exercise the metric operators without a trained model."""
    sig = risk_signals(features)
    raised = sum(F.col(s).cast("int") for s in SIGNALS)
    return sig.select("transaction_id", F.col("is_fraud").cast("int").alias("label"),
                      (raised.cast("double") / len(SIGNALS)).alias("score"))


__all__ = [
    "kpi_summary", "high_rate_types", "type_table", "risky_table", "balanced_sample",
    "derive_request_features", "one_hot_type", "align_features", "risk_signals",
    "signal_score", "FEATURE_COLS",
]
