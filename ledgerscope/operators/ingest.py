"""Ingest: staging -> core (types, accounts, transactions).

Each operator is a function from DataFrames to a DataFrame; nothing is
collected except single scalars (the largest existing id).
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import account_type, normalize_type
from ..functions.keys import dense_surrogate_key
from ..schemas import MALFORMED, MONEY, SEED_TYPE_NAMES, TYPES
from ..session import broadcast_if_small, reliable_checkpoint
from ..sources.files import as_of_lit

BALANCE_COLS = ["old_balance_orig", "new_balance_orig", "old_balance_dest", "new_balance_dest"]


# ── C1, C2, C9: load checks ──────────────────────────────────────────────────
def staged_count(staging: DataFrame) -> DataFrame:
    return staging.agg(F.count(F.lit(1)).alias("staged_rows"))


def type_histogram(staging: DataFrame) -> DataFrame:
    return (staging.groupBy("type").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_last("type")))


def loaded_count(transactions: DataFrame) -> DataFrame:
    return transactions.agg(F.count(F.lit(1)).alias("loaded_transactions"))


# ── C3, C4: transaction types ────────────────────────────────────────────────
def seed_types(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, name) for i, name in enumerate(SEED_TYPE_NAMES)]
    return spark.createDataFrame(rows, TYPES)


def _next_id(dim: DataFrame, id_col: str) -> int:
    """1 + the largest id of a dimension (one scalar to the driver)."""
    top = dim.agg(F.max(id_col)).first()[0]
    return 1 if top is None else int(top) + 1


def upsert_types(staging: DataFrame, types: DataFrame) -> DataFrame:
    """INSERT DISTINCT UPPER(TRIM(type)) ... ON CONFLICT DO NOTHING.

    The distinct runs with a map-side partial aggregate, so the shuffle
    carries at most (#types x #partitions) rows. New names get ids after the
    current maximum, in name order.
    """
    names = (staging.select(normalize_type("type").alias("type_name"))
             .where(F.col("type_name").isNotNull()).distinct())
    new = names.join(broadcast_if_small(types.select("type_name")), "type_name", "left_anti")
    new = dense_surrogate_key(new, ["type_name"], "type_id", start=_next_id(types, "type_id"))
    return types.unionByName(new.select("type_id", "type_name"))


# ── C5, C6, C7: accounts ─────────────────────────────────────────────────────
def account_refs(staging: DataFrame) -> DataFrame:
    """Distinct non-NULL senders and recipients (UNION, not UNION ALL), in one scan."""
    refs = staging.select(F.explode(F.array("name_orig", "name_dest")).alias("account_ref"))
    return refs.where(F.col("account_ref").isNotNull()).distinct()


def merge_accounts(staging: DataFrame, accounts: DataFrame | None = None,
                   as_of: datetime | None = None) -> DataFrame:
    """C5 and C6 of one load: new refs get ids after the largest one, known ones are
    touched. Staging is read once: one outer join of its refs with the table tells both."""
    if accounts is None:
        return upsert_accounts(staging, None, as_of)
    ts = as_of_lit(as_of)
    both = reliable_checkpoint(account_refs(staging).withColumn("_seen", F.lit(True))
                               .join(accounts, "account_ref", "full_outer"))
    known = both.where(F.col("account_id").isNotNull()).select(
        "account_id", "account_ref", "account_type", "first_seen",
        F.when(F.col("_seen"), ts).otherwise(F.col("last_seen")).alias("last_seen"))
    fresh = both.where(F.col("account_id").isNull()).select("account_ref")
    return known.unionByName(_numbered_accounts(fresh, _next_id(both, "account_id"), ts))


def _numbered_accounts(refs: DataFrame, start: int, ts) -> DataFrame:
    return dense_surrogate_key(refs, ["account_ref"], "account_id", start=start).select(
        "account_id", "account_ref", account_type("account_ref").alias("account_type"),
        ts.alias("first_seen"), ts.alias("last_seen"))


def upsert_accounts(staging: DataFrame, accounts: DataFrame | None = None,
                    as_of: datetime | None = None) -> DataFrame:
    """INSERT new refs (prefix M -> 'M', else 'C') ON CONFLICT DO NOTHING.

    Ids are dense in account_ref order after the current maximum; the
    numbering is range-partitioned (see functions.keys), never one task.
    """
    refs = account_refs(staging)
    start = 1
    if accounts is not None:
        refs = refs.join(accounts.select("account_ref"), "account_ref", "left_anti")
        start = _next_id(accounts, "account_id")
    new = _numbered_accounts(refs, start, as_of_lit(as_of))
    return new if accounts is None else accounts.unionByName(new)


def touch_last_seen(accounts: DataFrame, staging: DataFrame,
                    as_of: datetime | None = None) -> DataFrame:
    """UPDATE accounts SET last_seen = as_of WHERE the ref occurs in staging
    on either side. Written as a left join with the distinct key set (the
    literal EXISTS ... OR ... form plans a nested-loop join)."""
    seen = account_refs(staging).withColumn("_seen", F.lit(True))
    out = accounts.join(seen, "account_ref", "left")
    return out.select(
        "account_id", "account_ref", "account_type", "first_seen",
        F.when(F.col("_seen"), as_of_lit(as_of)).otherwise(F.col("last_seen")).alias("last_seen"),
    )


def account_total(accounts: DataFrame) -> DataFrame:
    return accounts.agg(F.count(F.lit(1)).alias("total_accounts"))


def account_counts(accounts: DataFrame) -> DataFrame:
    return accounts.groupBy("account_type").agg(F.count(F.lit(1)).alias("count"))


# ── C10: constraint validation with quarantine ──────────────────────────────
#: Amounts are NUMERIC(18,2), sixteen digits before the point; from here on rounding to
#: two places needs a seventeenth.
MONEY_LIMIT = Decimal("9999999999999999.995")


def _reason_array(staging: DataFrame, types: DataFrame | None):
    checks = [
        ("step_null", F.col("step").isNull()),
        ("step_negative", F.col("step") < 0),
        ("type_null", normalize_type("type").isNull()),
        ("amount_null", F.col("amount").isNull()),
        ("amount_negative", F.col("amount") < 0),
        ("balance_negative", F.greatest(*[F.col(b) < 0 for b in BALANCE_COLS])),
        ("amount_out_of_range", F.abs("amount") >= F.lit(MONEY_LIMIT)),
        ("balance_out_of_range", F.greatest(*[F.abs(b) >= F.lit(MONEY_LIMIT) for b in BALANCE_COLS])),
        ("sender_null", F.col("name_orig").isNull()),
        ("recipient_null", F.col("name_dest").isNull()),
        ("label_null", F.col("is_fraud").isNull() | F.col("is_flagged_fraud").isNull()),
    ]
    if MALFORMED in staging.columns:
        checks.append(("malformed", F.col(MALFORMED).isNotNull()))
    if types is not None:
        checks.append(("unknown_type", F.col("_known").isNull()
                       & normalize_type("type").isNotNull()))
    return F.array_compact(F.array(*[F.when(cond, F.lit(r)) for r, cond in checks]))


def validate_constraints(staging: DataFrame, types: DataFrame | None = None
                         ) -> tuple[DataFrame, DataFrame]:
    """Split staging into (valid rows, quarantined rows + ``reasons``).

    The database rejects a whole INSERT on the first violation; we keep the
    good rows and park the bad ones with every rule they break. When a types
    table is given (types not upserted), unknown names are an FK violation.
    """
    df = staging
    if types is not None:
        known = broadcast_if_small(types.select(F.col("type_name").alias("_tn"),
                                                F.lit(True).alias("_known")))
        df = df.join(known, normalize_type("type") == F.col("_tn"), "left")
    df = df.withColumn("reasons", _reason_array(staging, types))
    cols = [c for c in staging.columns if c != MALFORMED]
    valid = df.where(F.size("reasons") == 0).select(*cols)
    quarantined = df.where(F.size("reasons") > 0).select(*staging.columns, "reasons")
    return valid, quarantined


def quarantine_report(quarantined: DataFrame) -> DataFrame:
    """Rows per broken rule."""
    return (quarantined.select(F.explode("reasons").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rows")))


# ── C8: promote staging rows to core.transactions ───────────────────────────
def promote_transactions(staging: DataFrame, types: DataFrame, accounts: DataFrame,
                         as_of: datetime | None = None,
                         existing: DataFrame | None = None) -> DataFrame:
    """Resolve type and both account ids by inner equi-joins.

    The type lookup is broadcast after a size check. The two account
    lookups are shuffle joins on the account ref (accounts grow with the
    data); AQE splits a hot sender's partition (skew join). Staging rows
    carry a ``transaction_id``; when ``existing`` is given, ids already
    loaded are skipped (idempotent re-runs). Staging without ids gets ids
    in input order.
    """
    if "transaction_id" not in staging.columns:
        staging = sequential_ids(staging, "transaction_id", start=1 if existing is None
                                 else _next_id(existing, "transaction_id"))
    if existing is not None:
        staging = staging.join(existing.select("transaction_id"), "transaction_id", "left_anti")
    t = broadcast_if_small(types.select(F.col("type_id"), F.col("type_name").alias("_tn")))
    s = accounts.select(F.col("account_id").alias("sender_id"), F.col("account_ref").alias("_s"))
    r = accounts.select(F.col("account_id").alias("recipient_id"),
                        F.col("account_ref").alias("_r"))
    df = (staging.withColumn("_type", normalize_type("type"))
          .join(t, F.col("_type") == F.col("_tn"))
          .join(s, F.col("name_orig") == F.col("_s"))
          .join(r, F.col("name_dest") == F.col("_r")))
    return df.select(
        F.col("transaction_id").cast("long").alias("transaction_id"),
        F.col("step").cast("int").alias("step"),
        "type_id",
        F.col("amount").cast(MONEY).alias("amount"),
        "sender_id",
        F.col("old_balance_orig").cast(MONEY).alias("sender_balance_pre"),
        F.col("new_balance_orig").cast(MONEY).alias("sender_balance_post"),
        "recipient_id",
        F.col("old_balance_dest").cast(MONEY).alias("recip_balance_pre"),
        F.col("new_balance_dest").cast(MONEY).alias("recip_balance_post"),
        (F.col("is_fraud") == 1).alias("is_fraud"),
        (F.col("is_flagged_fraud") == 1).alias("is_flagged_fraud"),
        as_of_lit(as_of).alias("created_at"),
    )


def sequential_ids(df: DataFrame, id_col: str, start: int = 1) -> DataFrame:
    """BIGSERIAL for rows without a natural key: number rows in input order
    (file split, then position), with per-partition offsets instead of a
    global window."""
    from pyspark.sql import Window

    tagged = reliable_checkpoint(df.withColumn("_mid", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("_part", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part"))
                                      - F.col("_n")).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_part").withColumn(
        id_col, (F.lit(start) + F.col("_off") + F.col("_pos")).cast("long"))
    return out.drop("_mid", "_part", "_pos", "_off")
