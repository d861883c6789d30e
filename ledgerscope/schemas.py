"""Explicit schemas of the three layers (staging, core, analytics)."""

from pyspark.sql import types as T

RAW_DECIMAL = T.DecimalType(38, 6)   # unbounded NUMERIC of the raw table
MONEY = T.DecimalType(18, 2)          # NUMERIC(18,2) of the core table
SUM_MONEY = T.DecimalType(38, 2)      # sums of money

# The CSV header order of the raw transaction file.
CSV_COLUMNS = [
    "step", "type", "amount", "name_orig", "old_balance_orig", "new_balance_orig",
    "name_dest", "old_balance_dest", "new_balance_dest", "is_fraud", "is_flagged_fraud",
]

RAW_CSV = T.StructType([
    T.StructField("step", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", RAW_DECIMAL),
    T.StructField("name_orig", T.StringType()),
    T.StructField("old_balance_orig", RAW_DECIMAL),
    T.StructField("new_balance_orig", RAW_DECIMAL),
    T.StructField("name_dest", T.StringType()),
    T.StructField("old_balance_dest", RAW_DECIMAL),
    T.StructField("new_balance_dest", RAW_DECIMAL),
    T.StructField("is_fraud", T.IntegerType()),
    T.StructField("is_flagged_fraud", T.IntegerType()),
])

TYPES = T.StructType([
    T.StructField("type_id", T.LongType(), False),
    T.StructField("type_name", T.StringType(), False),
])

ACCOUNTS = T.StructType([
    T.StructField("account_id", T.LongType(), False),
    T.StructField("account_ref", T.StringType(), False),
    T.StructField("account_type", T.StringType(), False),
    T.StructField("first_seen", T.TimestampNTZType()),
    T.StructField("last_seen", T.TimestampNTZType()),
])

# The five seeded transaction type names, ids by position.
SEED_TYPE_NAMES = ["PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT"]

# The fifteen model features, in training order.
FEATURE_COLS = [
    "amount",
    "sender_balance_pre",
    "sender_balance_post",
    "recip_balance_pre",
    "recip_balance_post",
    "sender_balance_drop",
    "recipient_balance_gain",
    "dest_balance_mismatch",
    "sender_drained",
    "dest_was_empty",
    "sender_txns_same_step",
    "sender_amount_zscore",
    "sender_total_txns",
    "sender_avg_amount",
    "sender_unique_recipients",
]

# One-hot columns, one per seeded type (fixed list so train and score agree).
TYPE_DUMMIES = [f"type_{n}" for n in SEED_TYPE_NAMES]

# Raw request fields a scorer receives (features minus the derived five).
REQUEST_COLS = [
    "amount", "sender_balance_pre", "sender_balance_post",
    "recip_balance_pre", "recip_balance_post",
    "sender_txns_same_step", "sender_amount_zscore",
    "sender_total_txns", "sender_avg_amount", "sender_unique_recipients",
]

# Raw text of a CSV line that does not fit the schema; null for lines that do.
MALFORMED = "_malformed"
