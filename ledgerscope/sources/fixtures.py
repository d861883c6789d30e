"""Raw transaction staging derived from the driver's ``events`` table.

The driver tables carry no payment data, so this module maps each event to
one raw transaction (the mapping is documented in FIXTURES.md §2). Labels and
balances are invented by the mapping; they exercise the operators, they do
not describe real fraud. Everything here is column arithmetic on a scan, so
it stays a narrow, pushdown-friendly projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_DECIMAL

EPOCH = "2024-01-01 00:00:00"

# Event type -> transaction type (anything else is DEBIT).
EVENT_TYPE_MAP = {
    "view": "PAYMENT",
    "purchase": "TRANSFER",
    "click": "CASH_OUT",
    "signup": "CASH_IN",
}

BURST_COPIES = 6
BURST_ID_STRIDE = 10_000_000
BURST_MODULUS = 500
DIRTY_MODULUS = 101


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _mapped_type() -> Column:
    ty = F.lit("DEBIT")
    for ev, name in reversed(list(EVENT_TYPE_MAP.items())):
        ty = F.when(F.col("event_type") == ev, F.lit(name)).otherwise(ty)
    return ty


def staging_from_events(events: DataFrame, variant: str = "clean",
                        extra_cols: list[str] | None = None) -> DataFrame:
    """Map events to ``staging.raw_transactions`` rows plus a
    ``transaction_id`` column (event_id + 1).

    variant: ``clean``; ``burst`` (six extra copies of every 500th row, so
    duplicate combinations and >5-per-step bursts exist); ``dirty`` (one in
    101 rows broken in one of six ways, to exercise validation).
    """
    k = F.col("_k")
    amt = F.col("_amt")
    ty = F.col("_ty")
    extra = list(extra_cols or [])
    base = events.select(
        "event_id", "ts", "user_id", *extra,
        F.regexp_extract("props", "[0-9]+", 0).try_cast("int").alias("_k"),
        F.col("value").cast("decimal(18,2)").alias("_amt"),
        _mapped_type().alias("_ty"),
    )
    dest = (
        F.when(ty == "PAYMENT", F.concat(F.lit("M"), k.cast("string")))
        .when(ty == "DEBIT", F.concat(F.lit("C"), (F.lit(9_000_000) + k).cast("string")))
        .otherwise(F.concat(F.lit("C"), ((F.col("user_id") * 7 + k) % 200).cast("string")))
    )
    old_dest = (k % 4) * 250
    fraud = ty.isin("TRANSFER", "CASH_OUT") & (k % 25 == 0)
    staging = base.select(
        (F.col("event_id") + 1).alias("transaction_id"),
        F.expr(f"timestampdiff(HOUR, TIMESTAMP_NTZ'{EPOCH}', ts)").cast("int").alias("step"),
        F.when(F.col("event_id") % 11 == 0, F.concat(F.lit(" "), F.lower(ty), F.lit(" ")))
        .otherwise(ty).alias("type"),
        amt.cast(RAW_DECIMAL).alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("name_orig"),
        (amt + (k % 5) * 100).cast(RAW_DECIMAL).alias("old_balance_orig"),
        ((k % 5) * 100).cast(RAW_DECIMAL).alias("new_balance_orig"),
        dest.alias("name_dest"),
        old_dest.cast(RAW_DECIMAL).alias("old_balance_dest"),
        F.when(k % 10 == 0, old_dest).otherwise(old_dest + amt).cast(RAW_DECIMAL)
        .alias("new_balance_dest"),
        F.when(fraud, 1).otherwise(0).alias("is_fraud"),
        F.when((ty == "TRANSFER") & (k % 25 == 0) & (amt > 100), 1).otherwise(0)
        .alias("is_flagged_fraud"),
        *extra,
    )
    if variant == "clean":
        return staging
    if variant == "burst":
        return burst_variant(staging)
    if variant == "dirty":
        return dirty_variant(staging)
    raise ValueError(f"unknown staging variant {variant!r}")


def burst_variant(staging: DataFrame) -> DataFrame:
    """Add six copies of every row with transaction_id % 500 = 1, with ids
    shifted by 10,000,000 per copy. A generator (explode), not a join."""
    cols = [c for c in staging.columns if c != "transaction_id"]
    copies = (
        staging.filter(F.col("transaction_id") % BURST_MODULUS == 1)
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(BURST_COPIES))).alias("_i"))
        .select(
            (F.col("transaction_id") + F.col("_i").cast("long") * BURST_ID_STRIDE)
            .alias("transaction_id"),
            *cols,
        )
    )
    return staging.unionByName(copies)


def dirty_variant(staging: DataFrame) -> DataFrame:
    """Break rows by transaction_id % 101: 1 NULL type, 2 unknown type
    'REFUND', 3 negative amount, 4 negative sender balance, 5 NULL recipient,
    6 NULL fraud label."""
    m = F.col("transaction_id") % DIRTY_MODULUS

    def patch(col: str, case: int, value) -> Column:
        return F.when(m == case, value).otherwise(F.col(col)).alias(col)

    rest = [c for c in staging.columns if c not in DIRTY_COLS]
    return staging.select(
        "transaction_id", "step",
        F.when(m == 1, F.lit(None).cast("string"))
        .when(m == 2, F.lit("REFUND")).otherwise(F.col("type")).alias("type"),
        patch("amount", 3, -F.col("amount")),
        "name_orig",
        patch("old_balance_orig", 4, F.lit(-1).cast(RAW_DECIMAL)),
        "new_balance_orig",
        patch("name_dest", 5, F.lit(None).cast("string")),
        "old_balance_dest", "new_balance_dest",
        patch("is_fraud", 6, F.lit(None).cast("int")),
        "is_flagged_fraud",
        *rest,
    )


DIRTY_COLS = ["transaction_id", "step", "type", "amount", "name_orig", "old_balance_orig",
              "new_balance_orig", "name_dest", "old_balance_dest", "new_balance_dest",
              "is_fraud", "is_flagged_fraud"]
