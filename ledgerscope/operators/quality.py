"""Integrity and feature checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import count_if, pct


def _orphans(fact: DataFrame, fk: str, dim: DataFrame, pk: str, name: str) -> DataFrame:
    keys = dim.select(F.col(pk).alias(fk))
    return fact.select(fk).join(keys, fk, "left_anti").agg(F.count(F.lit(1)).alias(name))


def orphaned_type_refs(transactions: DataFrame, types: DataFrame) -> DataFrame:
    """V1: transactions whose type_id is not in the type table (expect 0)."""
    return _orphans(transactions, "type_id", types, "type_id", "orphaned_type_refs")


def orphaned_senders(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """V2."""
    return _orphans(transactions, "sender_id", accounts, "account_id", "orphaned_senders")


def orphaned_recipients(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """V3."""
    return _orphans(transactions, "recipient_id", accounts, "account_id", "orphaned_recipients")


def negative_amounts(transactions: DataFrame) -> DataFrame:
    """V4."""
    return transactions.where(F.col("amount") < 0).agg(
        F.count(F.lit(1)).alias("negative_amounts"))


def row_reconciliation(staging: DataFrame, transactions: DataFrame) -> DataFrame:
    """V5: staging rows, core rows and their difference, as one aggregate
    over a tagged union (no join of the two counts)."""
    tagged = staging.select(F.lit(1).alias("_s"), F.lit(0).alias("_c")).unionByName(
        transactions.select(F.lit(0).alias("_s"), F.lit(1).alias("_c")))
    agg = tagged.agg(F.sum("_s").cast("long").alias("staging_rows"),
                     F.sum("_c").cast("long").alias("core_rows"))
    return agg.select("*", (F.col("staging_rows") - F.col("core_rows")).alias("discrepancy"))


def label_distribution(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """V6 / F2: count and percent of all rows per label. The window runs
    over the aggregated rows (one per label value)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select(label, "count", pct(F.col("count"), total, 3).alias("pct"))


def duplicate_combos(transactions: DataFrame, limit: int | None = 10) -> DataFrame:
    """V7: (step, amount, sender, recipient) combinations seen more than
    once; the report shows the ``limit`` largest (ties by key)."""
    dup = (transactions.groupBy("step", "amount", "sender_id", "recipient_id")
           .agg(F.count(F.lit(1)).alias("dupes")).where(F.col("dupes") > 1))
    dup = dup.orderBy(F.desc("dupes"), "step", "sender_id", "recipient_id", "amount")
    return dup.limit(limit) if limit else dup


def feature_completeness(features: DataFrame) -> DataFrame:
    """NULL counts of the history features."""
    return features.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_if(F.col("sender_amount_zscore").isNull()).alias("null_zscores"),
        count_if(F.col("sender_prev_amount").isNull()).alias("null_lag_amount"),
        count_if(F.col("sender_total_txns").isNull()).alias("null_sender_stats"),
    )


def fraud_by_flag(features: DataFrame, flag_col: str) -> DataFrame:
    """Fraud rate split by a 0/1 feature."""
    return (features.groupBy(flag_col).agg(
        F.count(F.lit(1)).alias("count"),
        count_if("is_fraud").alias("fraud_count"),
        pct(count_if("is_fraud"), F.count(F.lit(1)), 2).alias("fraud_rate_pct"),
    ).orderBy(flag_col))
