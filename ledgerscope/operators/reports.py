"""Fraud reports: dashboard views (A4-A6) and analysis queries (Q1-Q8).

Pattern used throughout: aggregate the fact table on its integer keys first
(map-side partial aggregation), cut to the top-k where the report is a
top-k, and only then join the (large) accounts table or the (tiny,
size-checked, broadcast) types table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import count_if, money_sum, pct, safe_div, sum_if
from ..functions.scans import id_digit, prefix_scan
from ..schemas import MONEY, SUM_MONEY
from ..session import broadcast_if_small


def _refs(accounts: DataFrame, id_col: str) -> DataFrame:
    return accounts.select(F.col("account_id").alias(id_col), "account_ref")


def _attach_refs(small: DataFrame, accounts: DataFrame, id_col: str,
                 bound: int | None = None) -> DataFrame:
    """Join account refs onto an already-reduced frame. ``bound`` is the
    proven row bound of ``small`` (a top-k), which makes it safe to
    broadcast; otherwise Spark chooses (AQE switches to broadcast by
    measured size)."""
    side = F.broadcast(small) if bound is not None else small
    return side.join(_refs(accounts, id_col), id_col)


def fraud_by_type(transactions: DataFrame, types: DataFrame) -> DataFrame:
    """A4 ``v_fraud_by_type``: count, fraud count, rate (2 dp), volume and
    fraud volume per type, by rate descending."""
    per_type = transactions.groupBy("type_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        count_if("is_fraud").alias("fraud_count"),
        money_sum("amount").alias("total_volume"),
        sum_if("amount", "is_fraud").cast(SUM_MONEY).alias("fraud_volume"),
    )
    out = per_type.join(broadcast_if_small(types), "type_id").select(
        "type_name", "total_transactions", "fraud_count",
        pct("fraud_count", "total_transactions", 2).alias("fraud_rate_pct"),
        "total_volume", "fraud_volume",
    )
    return out.orderBy(F.desc("fraud_rate_pct"), "type_name")


def fraud_trend(transactions: DataFrame) -> DataFrame:
    """A5 ``v_fraud_trend``: the same per step (rate 3 dp), by step."""
    return transactions.groupBy("step").agg(
        F.count(F.lit(1)).alias("total_txns"),
        count_if("is_fraud").alias("fraud_txns"),
        money_sum("amount").alias("total_volume"),
        sum_if("amount", "is_fraud").cast(SUM_MONEY).alias("fraud_volume"),
        pct(count_if("is_fraud"), F.count(F.lit(1)), 3).alias("fraud_rate_pct"),
    ).orderBy("step")


def risky_senders(sender_feats: DataFrame, limit: int | None = None) -> DataFrame:
    """A6 ``v_risky_senders``: senders with fraud, by rate then fraud count
    (ties by sender_id); ``limit`` is the dashboard's top-k."""
    df = sender_feats.where(F.col("fraud_count") > 0).orderBy(
        F.desc("fraud_rate"), F.desc("fraud_count"), "sender_id")
    if limit:
        df = df.limit(limit)
    return df.select("account_ref", "total_txn_count", "fraud_count", "fraud_rate",
                     "total_amount", "avg_amount", "unique_recipients")


def fraud_rate_rank_by_type(transactions: DataFrame, types: DataFrame) -> DataFrame:
    """Q1: rate (3 dp) per type and RANK by the unrounded rate. The rank
    window runs over the aggregated rows (one per type)."""
    per_type = transactions.groupBy("type_id").agg(
        F.count(F.lit(1)).alias("total_txns"),
        count_if("is_fraud").alias("fraud_txns"),
    ).withColumn("_rate", safe_div("fraud_txns", "total_txns"))
    out = per_type.join(broadcast_if_small(types), "type_id").select(
        "type_name", "total_txns", "fraud_txns",
        F.round(F.col("_rate") * 100, 3).alias("fraud_rate_pct"),
        F.rank().over(Window.orderBy(F.desc("_rate"))).cast("long").alias("fraud_rank"),
    )
    return out.orderBy(F.desc("fraud_rate_pct"), "type_name")


def rolling_fraud_rate(transactions: DataFrame, k: int = 10) -> DataFrame:
    """Q2: per-step fraud rate and its mean over the last ``k`` steps
    present. Aggregate first; the moving window then covers one row per
    step (bounded by the number of distinct steps)."""
    hourly = transactions.groupBy("step").agg(
        safe_div(count_if("is_fraud"), F.count(F.lit(1))).alias("step_fraud_rate"))
    w = Window.orderBy("step").rowsBetween(-(k - 1), Window.currentRow)
    return hourly.select("step", "step_fraud_rate",
                         F.avg("step_fraud_rate").over(w).alias(f"rolling_{k}_fraud_rate")
                         ).orderBy("step")


def top_risky_senders(transactions: DataFrame, accounts: DataFrame, n: int = 20) -> DataFrame:
    """Q3: senders with fraud by fraud count (ties by sender_id), with
    DENSE_RANK on fraud count. Cut to the top n first: the dense rank of a
    kept row depends only on rows above it, all of which are kept."""
    per_sender = transactions.groupBy("sender_id").agg(
        F.count(F.lit(1)).alias("total_txns"),
        count_if("is_fraud").alias("fraud_txns"),
        sum_if("amount", "is_fraud").cast(SUM_MONEY).alias("fraud_volume"),
    ).where(F.col("fraud_txns") > 0)
    top = per_sender.orderBy(F.desc("fraud_txns"), "sender_id").limit(n)
    ranked = top.select(
        "*",
        pct("fraud_txns", "total_txns", 2).alias("fraud_rate_pct"),
        F.dense_rank().over(Window.orderBy(F.desc("fraud_txns"))).cast("long").alias("rank"),
    )
    return _attach_refs(ranked, accounts, "sender_id", bound=n).select(
        "account_ref", "total_txns", "fraud_txns", "fraud_volume", "fraud_rate_pct", "rank",
    ).orderBy(F.desc("fraud_txns"), "rank", "account_ref")


def _with_sender_moments(transactions: DataFrame) -> DataFrame:
    """Join each transaction with its sender's mean and sample stddev. The
    moments are an aggregate (partial map-side); the join back is on
    sender_id, where AQE splits a hot sender's partition."""
    stats = transactions.groupBy("sender_id").agg(
        (F.sum("amount").cast("double") / F.count("amount")).alias("mean_amt"),
        F.stddev_samp(F.col("amount").cast("double")).alias("std_amt"),
    )
    return transactions.join(stats, "sender_id")


def sender_anomalies(transactions: DataFrame, accounts: DataFrame, z: float = 3.0,
                     n: int | None = 50) -> DataFrame:
    """Q4: transactions more than ``z`` sample stddevs above their sender's
    mean (stddev > 0), z rounded to 2 dp, top ``n`` by z (ties by id)."""
    df = _with_sender_moments(transactions)
    zexpr = (F.col("amount").cast("double") - F.col("mean_amt")) / F.col("std_amt")
    df = df.where((F.col("std_amt") > 0) & (zexpr > z)).select(
        "transaction_id", "sender_id", "amount", "mean_amt", "std_amt",
        F.round(zexpr, 2).alias("z_score"), "is_fraud")
    if n:
        df = df.orderBy(F.desc("z_score"), "transaction_id").limit(n)
    out = _attach_refs(df, accounts, "sender_id", bound=n)
    return out.select("transaction_id", "account_ref", "amount", "mean_amt", "std_amt",
                      "z_score", "is_fraud").orderBy(F.desc("z_score"), "transaction_id")


def sender_anomalies_all(transactions: DataFrame, accounts: DataFrame,
                         z: float = 3.0) -> DataFrame:
    """The README variant, every row with z > 3 via NULLIF(std, 0)."""
    df = _with_sender_moments(transactions)
    zexpr = safe_div(F.col("amount").cast("double") - F.col("mean_amt"), "std_amt")
    df = df.where(zexpr > z).select("transaction_id", "sender_id", "amount",
                                    F.round(zexpr, 2).alias("z_score"), "is_fraud")
    out = _attach_refs(df, accounts, "sender_id")
    return out.select("transaction_id", "account_ref", "amount", "z_score", "is_fraud"
                      ).orderBy(F.desc("z_score"), "transaction_id")


def receive_only_accounts(transactions: DataFrame, accounts: DataFrame,
                          min_received: int = 5, n: int | None = 20) -> DataFrame:
    """Q5: accounts that received more than ``min_received`` times and never
    sent (anti join on the sender key set), by received total."""
    recv = transactions.groupBy("recipient_id").agg(
        F.count(F.lit(1)).alias("recv_count"),
        money_sum("amount").alias("recv_total"),
    ).where(F.col("recv_count") > min_received)
    senders = transactions.select(F.col("sender_id").alias("recipient_id")).distinct()
    only = recv.join(senders, "recipient_id", "left_anti")
    if n:
        only = only.orderBy(F.desc("recv_total"), "recipient_id").limit(n)
    out = _attach_refs(only, accounts, "recipient_id", bound=n)
    return out.select("account_ref", "recv_count", "recv_total",
                      F.lit(0).cast("long").alias("sent_count")
                      ).orderBy(F.desc("recv_total"), "account_ref")


# The reported amount percentiles.
PERCENTILES = [0.25, 0.50, 0.75, 0.90, 0.99]


#: Buckets of one selection pass, as bits; cents of a NUMERIC(18,2) have fewer bits than this.
SELECT_BITS, MONEY_BITS = 14, 61


def _select_positions(values: DataFrame, wanted: Column) -> DataFrame:
    """(type_id, _n, _found: position -> cents): the values at 0-based positions of each
    type's sorted cents (``wanted``: an array of positions from the type's count ``_n``),
    from counts (type_id, cents, _c).

    Values are narrowed down digit by digit, from the highest: a pass counts the rows of
    each type by the next bits of their cents, for the wanted prefixes only, and picks
    the digit in which each wanted position lies. No value is sorted or collected; a pass
    leaves at most 2^SELECT_BITS counts per wanted prefix."""
    shift = MONEY_BITS + 1
    values = values.withColumn("_value", F.col("cents") + F.lit(1 << MONEY_BITS))  # no negative digits
    base = values.groupBy("type_id").agg(F.sum("_c").alias("_n"))
    # of each wanted position: the cents' digits so far, and the position among the rows that share them
    targets = base.select("type_id", "_n", F.explode(F.array_distinct(wanted)).alias("_pos")).select(
        "*", F.lit(0).cast("long").alias("_prefix"), F.col("_pos").alias("_rest"))
    while shift > 0:
        step = min(SELECT_BITS, shift)
        shift -= step
        prefixes = targets.select("type_id", "_prefix").distinct()
        digit = F.shiftright("_value", shift)
        counted = (values.withColumn("_digit", digit).withColumn("_prefix", F.shiftright(digit, step))
                   .join(F.broadcast(prefixes), ["type_id", "_prefix"])
                   .groupBy("type_id", "_prefix", "_digit").agg(F.sum("_c").alias("_c")))
        rows = counted.groupBy("type_id", "_prefix").agg(
            F.array_sort(F.collect_list(F.struct("_digit", "_c"))).alias("_counts"))
        start = F.struct(F.lit(None).cast("long").alias("digit"), F.col("_rest").alias("rest"))
        # walk up the digits until the position is used up
        found = F.aggregate("_counts", start, lambda acc, x: F.when(acc["digit"].isNotNull(), acc).otherwise(F.struct(
            F.when(acc["rest"] < x["_c"], x["_digit"]).alias("digit"),
            F.when(acc["rest"] < x["_c"], acc["rest"]).otherwise(acc["rest"] - x["_c"]).alias("rest"))))
        targets = (targets.join(rows, ["type_id", "_prefix"]).withColumn("_f", found)
                   .select("type_id", "_n", "_pos", F.col("_f.digit").alias("_prefix"), F.col("_f.rest").alias("_rest")))
    return targets.groupBy("type_id").agg(F.max("_n").alias("_n"), F.map_from_entries(F.collect_list(
        F.struct("_pos", (F.col("_prefix") - F.lit(1 << MONEY_BITS)).alias("cents")))).alias("_found"))


def amount_percentiles(transactions: DataFrame, types: DataFrame) -> DataFrame:
    """Q6: PERCENTILE_CONT at 25/50/75/90/99 % and the maximum per type, exact.

    The two order statistics around position p * (n - 1) are selected by histograms of the
    amounts' digits (:func:`_select_positions`) and interpolated as PostgreSQL does: lo +
    (hi - lo) * frac. The rows are read and exchanged once, as counts per amount; no group
    holds its values and nothing is sorted.
    """
    values = transactions.where(F.col("amount").isNotNull()).groupBy(
        "type_id", (F.col("amount") * 100).cast("long").alias("cents")).agg(F.count(F.lit(1)).alias("_c"))
    at = [(F.col("_n") - 1).cast("double") * p for p in PERCENTILES]
    wanted = F.array(*[f(x).cast("long") for x in at for f in (F.floor, F.ceil)])
    found = _select_positions(values, wanted)
    names = ["p25", "p50", "p75", "p90", "p99"]

    def value(position):
        return F.element_at("_found", position.cast("long")).cast("double") / 100

    interp = [(value(F.floor(x)) + (value(F.ceil(x)) - value(F.floor(x))) * (x - F.floor(x))).alias(n)
              for x, n in zip(at, names)]
    top = values.groupBy("type_id").agg(
        (F.max("cents").cast("decimal(20,0)") / 100).cast(MONEY).alias("max_amount"))
    return (found.join(top, "type_id").join(broadcast_if_small(types), "type_id")
            .select("type_name", *interp, "max_amount"))


def burst_senders(transactions: DataFrame, accounts: DataFrame, min_count: int = 5) -> DataFrame:
    """Q7: (sender, step) groups with more than ``min_count`` rows."""
    bursts = transactions.groupBy("sender_id", "step").agg(
        F.count(F.lit(1)).alias("txn_count"),
        money_sum("amount").alias("step_volume"),
    ).where(F.col("txn_count") > min_count)
    return _attach_refs(bursts, accounts, "sender_id").select(
        "account_ref", "step", "txn_count", "step_volume"
    ).orderBy(F.desc("txn_count"), "account_ref", "step")


def _balance_gaps(transactions: DataFrame, tol: float) -> DataFrame:
    rows = transactions.select("transaction_id", "sender_id", "step", "sender_balance_pre", "sender_balance_post")
    df = prefix_scan(rows, ["sender_id"], [F.col("step"), id_digit("transaction_id")], ["transaction_id"],
                     lags={"sender_balance_post": "prev_balance_post"}).drop("sender_balance_post")
    gap = F.abs(F.col("sender_balance_pre") - F.col("prev_balance_post"))
    return df.where(F.col("prev_balance_post").isNotNull() & (gap > tol)).withColumn(
        "inconsistency", gap.cast(SUM_MONEY))


def balance_inconsistency(transactions: DataFrame, tol: float = 0.01,
                          n: int | None = 20) -> DataFrame:
    """Q8: a sender's pre-balance differs from the post-balance of their
    previous transaction (by step, id) by more than ``tol``."""
    df = _balance_gaps(transactions, tol).orderBy(F.desc("inconsistency"), "transaction_id")
    return df.limit(n) if n else df
