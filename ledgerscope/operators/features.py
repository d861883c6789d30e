"""Analytics layer: enriched view (A1), sender features (A2) and the
per-transaction ML feature table (A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import count_if, double_avg, flag, money_sum, rate
from ..functions.scans import amount_digits, id_digit, prefix_scan
from ..schemas import SUM_MONEY
from ..session import broadcast_if_small

#: Rows of a sender whose history one task computes; larger senders are spread.
WINDOW_ROWS = 200_000


def v_transactions(transactions: DataFrame, types: DataFrame, accounts: DataFrame) -> DataFrame:
    """A1: fact joined with its type (broadcast, size-checked) and with the
    accounts table twice (sender, recipient)."""
    t = broadcast_if_small(types)
    s = accounts.select(F.col("account_id").alias("sender_id"),
                        F.col("account_ref").alias("sender_ref"),
                        F.col("account_type").alias("sender_type"))
    r = accounts.select(F.col("account_id").alias("recipient_id"),
                        F.col("account_ref").alias("recipient_ref"),
                        F.col("account_type").alias("recipient_type"))
    df = transactions.join(t, "type_id").join(s, "sender_id").join(r, "recipient_id")
    return df.select(
        "transaction_id", "step", "type_name", "amount", "sender_ref", "sender_type",
        "sender_balance_pre", "sender_balance_post", "recipient_ref", "recipient_type",
        "recip_balance_pre", "recip_balance_post", "is_fraud", "is_flagged_fraud",
    )


def sender_stats(transactions: DataFrame) -> DataFrame:
    """Per-sender aggregates of A2 (without the account ref). Partial
    aggregation runs map-side, so a hot sender costs one row per task."""
    return transactions.groupBy("sender_id").agg(
        F.count(F.lit(1)).alias("total_txn_count"),
        money_sum("amount").alias("total_amount"),
        double_avg("amount").alias("avg_amount"),
        F.stddev_samp(F.col("amount").cast("double")).alias("stddev_amount"),
        F.max("amount").alias("max_amount"),
        F.min("amount").alias("min_amount"),
        count_if("is_fraud").alias("fraud_count"),
        rate(count_if("is_fraud"), F.count(F.lit(1)), 4).alias("fraud_rate"),
        F.countDistinct("recipient_id").alias("unique_recipients"),
        (F.max("step") - F.min("step")).alias("active_duration_steps"),
    )


def sender_features(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """A2: ``mv_sender_features`` = sender_stats joined with the account ref."""
    refs = accounts.select(F.col("account_id").alias("sender_id"), "account_ref")
    return sender_stats(transactions).join(refs, "sender_id")


def point_in_time_features(transactions: DataFrame) -> DataFrame:
    """Leak-free variant of the sender history: only steps strictly before
    the row's step (RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)."""
    past = (Window.partitionBy("sender_id").orderBy("step")
            .rangeBetween(Window.unboundedPreceding, -1))
    return transactions.select(
        "transaction_id", "sender_id", "step",
        F.count(F.lit(1)).over(past).alias("past_txns"),
        count_if("is_fraud").over(past).alias("past_fraud"),
        F.sum("amount").over(past).cast(SUM_MONEY).alias("past_amount"),
    )


def balance_features() -> list:
    """A3a-e, from a row's amounts and balances."""
    return [
        (F.col("sender_balance_pre") - F.col("sender_balance_post")).cast(SUM_MONEY)
        .alias("sender_balance_drop"),
        (F.col("recip_balance_post") - F.col("recip_balance_pre")).cast(SUM_MONEY)
        .alias("recipient_balance_gain"),
        F.abs(F.col("amount") - (F.col("recip_balance_post") - F.col("recip_balance_pre")))
        .cast(SUM_MONEY).alias("dest_balance_mismatch"),
        flag(F.col("sender_balance_post") == 0).alias("sender_drained"),
        flag(F.col("recip_balance_pre") == 0).alias("dest_was_empty"),
    ]


def amount_ranks(transactions: DataFrame) -> DataFrame:
    """A3f: RANK of every (sender, amount) by amount, descending: one more than the rows
    with larger amounts. Counted per distinct amount, so equal amounts are one row however
    many there are."""
    counts = transactions.groupBy("sender_id", "amount").agg(F.count(F.lit(1)).alias("_c"))
    upto = prefix_scan(counts, ["sender_id"], amount_digits("amount"), ["amount"], {"_c": "_upto"}, descending=True)
    return upto.select("sender_id", "amount", (F.col("_upto") - F.col("_c") + 1).alias("sender_amount_rank"))


def _history_scan(rows: DataFrame) -> DataFrame:
    """Running sum, previous amount, same-step count and amount rank of senders of any
    size, whose rows are spread over many tasks by scans (:mod:`..functions.scans`)."""
    scanned = prefix_scan(
        rows, ["sender_id"], [F.col("step"), id_digit("transaction_id")], ["transaction_id"],
        sums={"amount": "sender_cumulative_amount"}, lags={"amount": "sender_prev_amount"},
        group_count="sender_txns_same_step")
    return scanned.join(amount_ranks(rows), ["sender_id", "amount"])


def _history_windows(rows: DataFrame) -> DataFrame:
    """The same of senders with a bounded number of rows: windows after one exchange."""
    own = Window.partitionBy("sender_id")
    along = own.orderBy("step", "transaction_id")
    return rows.where(F.col("sender_id").isNotNull()).select(
        "*", F.sum("amount").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("sender_cumulative_amount"),
        F.lag("amount").over(along).alias("sender_prev_amount"),
        F.count(F.lit(1)).over(Window.partitionBy("sender_id", "step")).alias("sender_txns_same_step"),
        F.rank().over(own.orderBy(F.desc("amount"))).cast("long").alias("sender_amount_rank")).where(
        F.col("amount").isNotNull())


def ml_features(transactions: DataFrame, types: DataFrame, sender_feats: DataFrame,
                window_rows: int = WINDOW_ROWS) -> DataFrame:
    """A3: ``mv_ml_features``, one row per transaction.

    The history of senders with at most ``window_rows`` transactions comes from windows: one
    exchange of the rows by sender, which the join with the sender totals (A2) shares.
    Larger senders, of which there are few, go through scans of (sender, step, id) and
    (sender, amount) segments, so that one with a third of all rows is spread over many
    tasks. Ties within a step are ordered by transaction_id.
    """
    rows = transactions.select("transaction_id", "step", "type_id", "amount", "sender_id", "sender_balance_pre",
                               "sender_balance_post", "recip_balance_pre", "recip_balance_post", "is_fraud")
    totals = sender_feats.select(
        "sender_id",
        F.col("total_txn_count").alias("sender_total_txns"),
        F.col("avg_amount").alias("sender_avg_amount"),
        F.col("fraud_rate").alias("sender_historical_fraud_rate"),
        F.col("unique_recipients").alias("sender_unique_recipients"),
        F.col("stddev_amount").alias("_std"),
    )
    large = transactions.groupBy("sender_id").agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") > window_rows).select("sender_id")  # at most rows / window_rows senders
    if large.limit(1).count():
        known = _history_windows(rows.join(F.broadcast(large), "sender_id", "left_anti")).unionByName(
            _history_scan(rows.join(F.broadcast(large), "sender_id", "left_semi")))
    else:
        known = _history_windows(rows)
    out = known.join(totals, "sender_id").join(broadcast_if_small(types), "type_id")
    z = F.when(F.col("_std") == 0, F.lit(0.0)).otherwise(
        (F.col("amount").cast("double") - F.col("sender_avg_amount")) / F.col("_std"))
    return out.select(
        "transaction_id", "step", "type_name", "amount", "sender_id", "sender_balance_pre", "sender_balance_post",
        "recip_balance_pre", "recip_balance_post", "is_fraud", *balance_features(), "sender_amount_rank",
        F.col("sender_cumulative_amount").cast(SUM_MONEY).alias("sender_cumulative_amount"),
        "sender_txns_same_step", z.alias("sender_amount_zscore"), "sender_prev_amount", "sender_total_txns",
        "sender_avg_amount", "sender_historical_fraud_rate", "sender_unique_recipients")
