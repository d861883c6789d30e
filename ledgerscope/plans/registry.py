"""

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with the
DuckDB statement that computes the same rows from the same parquet tables
(``None`` for operators SQL cannot express; those are checked by pytest).
Column names match one for one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.selection import portable_hash_sql
from ..operators import dashboard as dash
from ..operators import ingest, metrics, quality, reports
from ..schemas import (CSV_COLUMNS, FEATURE_COLS, MALFORMED, RAW_DECIMAL, SEED_TYPE_NAMES, SUM_MONEY,
                       TYPE_DUMMIES)
from ..sources.files import csv_load, write_csv
from . import ml_plans
from .layers import Layers, fixture_layers, layer_path, refresh_features
from .oracle import oracle
from .warehouse import Warehouse


@dataclass
class Entry:
    key: str
    sid: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    bench: bool = True


REGISTRY: dict[str, Entry] = {}


def register(key: str, sid: str, sql: str | None = None, variant: str = "clean",
             bench: bool = True, raw: bool = False, extra_ctes: str = ""):
    """Decorator. The function receives the layers of ``variant`` (or
    ``(spark, sf_dir)`` when ``raw``)."""
    def deco(fn):
        if raw:
            call = fn
        else:
            def call(spark: SparkSession, sf_dir: str, _fn=fn) -> DataFrame:
                return _fn(fixture_layers(spark, sf_dir, variant))
        REGISTRY[key] = Entry(key, sid, call,
                              oracle(sql, variant, extra_ctes) if sql else None, bench)
        return fn
    return deco


def pct_sql(k: str, n: str, d: int) -> str:
    return f"ROUND(CAST({k} AS DOUBLE) / NULLIF({n}, 0) * 100, {d})"


FRAUD = "COUNT(*) FILTER (WHERE is_fraud)"

# ── 2.1 ingest, normalize, validate ─────────────────────────────────────────
AS_OF_2 = datetime(2024, 3, 1)
SPLIT_STEP = 360


@register("csv_load", "S1", raw=True, sql="""
SELECT step, type, amount, name_orig, old_balance_orig, new_balance_orig, name_dest,
       old_balance_dest, new_balance_dest, is_fraud, is_flagged_fraud,
       TIMESTAMP '2024-02-01 00:00:00' AS loaded_at
FROM staging""")
def _csv_load(spark, sf_dir):
    """Staging written as the raw CSV file, read back by the CSV source."""
    path = layer_path(spark, sf_dir, "clean", f"raw_csv-{uuid.uuid4().hex}")
    write_csv(fixture_layers(spark, sf_dir).staging, path)
    return csv_load(spark, path).drop(MALFORMED)


@register("csv_malformed", "S1/C10/C12", raw=True, sql="""
SELECT line, CASE WHEN line % 40 = 1 THEN 'few' WHEN line % 40 = 2 THEN 'word' ELSE 'many' END AS defect
FROM (SELECT row_number() OVER (ORDER BY transaction_id) AS line FROM staging) s WHERE line % 40 IN (1, 2, 3)""")
def _csv_malformed(spark, sf_dir):
    """Raw CSV of which some lines have too few fields, a word for a number or one field
    too many: they are quarantined, and their ids are their places in the files."""
    path = layer_path(spark, sf_dir, "clean", f"broken_csv-{uuid.uuid4().hex}")
    staged = fixture_layers(spark, sf_dir).staging
    numbered = staged.repartitionByRange(3, "transaction_id").sortWithinPartitions("transaction_id")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CSV_COLUMNS]
    case = F.col("transaction_id") % 40
    lines = numbered.select(
        F.when(case == 1, F.concat_ws(",", *fields[:8], F.lit("few")))
        .when(case == 2, F.concat_ws(",", F.lit("word"), *fields[1:]))
        .when(case == 3, F.concat_ws(",", *fields, F.lit("many"))).otherwise(F.concat_ws(",", *fields)).alias("value"))
    lines.write.text(path)
    _, parked = ingest.validate_constraints(csv_load(spark, path, header=False, number_from=1, id_col="line"))
    return parked.select("line", F.when(F.col(MALFORMED).endswith("few"), "few")
                         .when(F.col(MALFORMED).startswith("word"), "word")
                         .when(F.col(MALFORMED).endswith("many"), "many").alias("defect"))


@register("sample_exact", "S2", sql=f"""
SELECT * FROM staging ORDER BY {portable_hash_sql('transaction_id')}, transaction_id
LIMIT 2000""")
def _sample_exact(L: Layers):
    return ml_plans.sample_exact(L.staging, 2_000, key="transaction_id", seed=42)


@register("refresh_features", "C11/S3/S4", raw=True, sql="SELECT * FROM ml_features", bench=False)
def _refresh(spark, sf_dir):
    layers = fixture_layers(spark, sf_dir)
    _, ml = refresh_features(layers, layer_path(spark, sf_dir, "clean", f"refresh-{uuid.uuid4().hex}"))
    return ml


@register("staged_count", "C1", sql="SELECT COUNT(*) AS staged_rows FROM staging")
def _staged_count(L):
    return ingest.staged_count(L.staging)


@register("type_histogram", "C2", sql="""
SELECT type, COUNT(*) AS count FROM staging GROUP BY type ORDER BY count DESC""")
def _type_histogram(L):
    return ingest.type_histogram(L.staging)


@register("transaction_types", "C3/C4", sql="SELECT type_id, type_name FROM types")
def _types(L):
    return L.types


@register("upsert_types", "C4", variant="dirty", sql="SELECT type_id, type_name FROM types")
def _types_dirty(L):
    return L.types


@register("upsert_accounts", "C5/C12", sql="SELECT * FROM accounts")
def _accounts(L):
    return L.accounts


@register("touch_last_seen", "C5/C6", extra_ctes=f"""
refs1 AS (SELECT account_ref FROM (SELECT name_orig AS account_ref FROM valid WHERE step < {SPLIT_STEP}
          UNION SELECT name_dest FROM valid WHERE step < {SPLIT_STEP}) x WHERE account_ref IS NOT NULL),
refs2 AS (SELECT account_ref FROM (SELECT name_orig AS account_ref FROM valid WHERE step >= {SPLIT_STEP}
          UNION SELECT name_dest FROM valid WHERE step >= {SPLIT_STEP}) x WHERE account_ref IS NOT NULL),
acc1 AS (SELECT row_number() OVER (ORDER BY account_ref) AS account_id, account_ref FROM refs1),
new2 AS (SELECT (SELECT MAX(account_id) FROM acc1) + row_number() OVER (ORDER BY account_ref) AS account_id,
                account_ref FROM refs2 WHERE account_ref NOT IN (SELECT account_ref FROM refs1))
""", sql="""
SELECT CAST(account_id AS BIGINT) AS account_id, account_ref,
       CASE WHEN account_ref LIKE 'M%' THEN 'M' ELSE 'C' END AS account_type, first_seen, last_seen
FROM (
  SELECT account_id, account_ref, TIMESTAMP '2024-02-01 00:00:00' AS first_seen,
         CASE WHEN account_ref IN (SELECT account_ref FROM refs2) THEN TIMESTAMP '2024-03-01 00:00:00'
              ELSE TIMESTAMP '2024-02-01 00:00:00' END AS last_seen
  FROM acc1
  UNION ALL
  SELECT account_id, account_ref, TIMESTAMP '2024-03-01 00:00:00', TIMESTAMP '2024-03-01 00:00:00'
  FROM new2) u""")
def _incremental_accounts(L):
    """Two loads (steps before / from SPLIT_STEP): the second upserts new
    accounts after the current maximum id and touches last_seen."""
    first = ingest.merge_accounts(L.valid.where(F.col("step") < SPLIT_STEP), None)
    return ingest.merge_accounts(L.valid.where(F.col("step") >= SPLIT_STEP), first, AS_OF_2)


#: The second load starts before the first one ends: transactions of both are loaded once.
OVERLAP_STEP = 300

_TWO_LOADS = f"""
refs1 AS (SELECT account_ref FROM (SELECT name_orig AS account_ref FROM valid WHERE step < {SPLIT_STEP}
          UNION SELECT name_dest FROM valid WHERE step < {SPLIT_STEP}) x),
refs2 AS (SELECT account_ref FROM (SELECT name_orig AS account_ref FROM valid WHERE step >= {OVERLAP_STEP}
          UNION SELECT name_dest FROM valid WHERE step >= {OVERLAP_STEP}) x),
two_loads AS (
  SELECT row_number() OVER (ORDER BY later, account_ref) AS account_id, account_ref
  FROM (SELECT account_ref, 0 AS later FROM refs1
        UNION ALL SELECT account_ref, 1 FROM refs2 WHERE account_ref NOT IN (SELECT account_ref FROM refs1)) u)
"""


def _two_loads(spark, sf_dir) -> Warehouse:
    staging = fixture_layers(spark, sf_dir).staging
    w = Warehouse(spark, layer_path(spark, sf_dir, "clean", f"loads-{uuid.uuid4().hex}"))
    w.load(staging.where(F.col("step") < SPLIT_STEP))
    w.refresh()
    w.load(staging.where(F.col("step") >= OVERLAP_STEP), AS_OF_2)
    w.refresh()
    return w


@register("second_load", "S4/C4-C8/C12", raw=True, bench=False, extra_ctes=_TWO_LOADS, sql=f"""
SELECT t.transaction_id, t.step, t.type_id, t.amount, s.account_id AS sender_id, r.account_id AS recipient_id,
       v.name_orig AS sender_ref, v.name_dest AS recipient_ref, t.is_fraud,
       CASE WHEN t.step < {SPLIT_STEP} THEN TIMESTAMP '2024-02-01 00:00:00'
            ELSE TIMESTAMP '2024-03-01 00:00:00' END AS created_at
FROM transactions t JOIN valid v ON v.transaction_id = t.transaction_id
JOIN two_loads s ON s.account_ref = v.name_orig JOIN two_loads r ON r.account_ref = v.name_dest""")
def _second_load(spark, sf_dir):
    """Transactions after two loads that overlap, with the refs of their accounts."""
    return _two_loads(spark, sf_dir).with_refs().select(
        "transaction_id", "step", "type_id", "amount", "sender_id", "recipient_id", "sender_ref", "recipient_ref",
        "is_fraud", "created_at")


_A2_COLS = ("account_ref", "total_txn_count", "total_amount", "avg_amount", "stddev_amount", "max_amount", "min_amount",
            "fraud_count", "fraud_rate", "unique_recipients", "active_duration_steps")


@register("incremental_sender_features", "C11/A2", raw=True, bench=False,
          sql=f"SELECT {', '.join(_A2_COLS)} FROM sender_features")
def _incremental_features(spark, sf_dir):
    """A2 refreshed after each of two loads from the new transactions only."""
    return _two_loads(spark, sf_dir).sender_features().select(*_A2_COLS)


@register("account_total", "C7", sql="SELECT COUNT(*) AS total_accounts FROM accounts")
def _account_total(L):
    return ingest.account_total(L.accounts)


@register("account_counts", "C7", sql="""
SELECT account_type, COUNT(*) AS count FROM accounts GROUP BY account_type""")
def _account_counts(L):
    return ingest.account_counts(L.accounts)


@register("promote_transactions", "C8", sql="SELECT * FROM transactions")
def _transactions(L):
    return L.transactions


@register("loaded_count", "C9", sql="SELECT COUNT(*) AS loaded_transactions FROM transactions")
def _loaded_count(L):
    return ingest.loaded_count(L.transactions)


@register("quarantine_report", "C10", variant="dirty", sql="""
SELECT reason, COUNT(*) AS rows FROM (SELECT unnest(reasons) AS reason FROM quarantined) q
GROUP BY reason""")
def _quarantine_report(L):
    return ingest.quarantine_report(L.quarantined)


@register("quarantine_rows", "C10", variant="dirty", sql="""
SELECT transaction_id, array_to_string(reasons, ',') AS reasons FROM quarantined""")
def _quarantine_rows(L):
    return L.quarantined.select("transaction_id", F.array_join("reasons", ",").alias("reasons"))


_RANGE = """
SELECT transaction_id, CASE transaction_id % 4 WHEN 0 THEN 'amount_out_of_range'
                            WHEN 1 THEN 'balance_out_of_range' END AS reasons
FROM staging WHERE transaction_id % 4 < 2"""


@register("quarantine_out_of_range", "C10", sql=_RANGE)
def _quarantine_range(L):
    """Amounts and balances at both sides of NUMERIC(18,2)'s limit: 9,999,999,999,999,999.99
    fits, half a cent more is rounded beyond it."""
    m, beyond, fits = F.col("transaction_id") % 4, "9999999999999999.995", "9999999999999999.99"

    def edge(case):
        return F.when(m == case, F.lit(beyond)).when(m == case + 2, F.lit(fits)).cast(RAW_DECIMAL)

    rows = L.staging.withColumn("amount", F.coalesce(edge(0), F.col("amount"))).withColumn(
        "new_balance_dest", F.coalesce(edge(1), F.col("new_balance_dest")))
    _, parked = ingest.validate_constraints(rows)
    return parked.select("transaction_id", F.array_join("reasons", ",").alias("reasons"))


@register("quarantine_unknown_type", "C10", variant="dirty", sql="""
SELECT transaction_id, array_to_string(list_concat(reasons, CASE WHEN upper(trim(type)) = 'REFUND'
       THEN ['unknown_type'] ELSE [] END), ',') AS reasons
FROM checked WHERE len(reasons) > 0 OR upper(trim(type)) = 'REFUND'""")
def _quarantine_type(L):
    """The foreign key on the type, where the types are not extended by the load."""
    _, parked = ingest.validate_constraints(L.staging, ingest.seed_types(L.staging.sparkSession))
    return parked.select("transaction_id", F.array_join("reasons", ",").alias("reasons"))


@register("orphaned_type_refs", "V1", sql="""
SELECT COUNT(*) AS orphaned_type_refs FROM transactions t
WHERE NOT EXISTS (SELECT 1 FROM types tt WHERE tt.type_id = t.type_id)""")
def _v1(L):
    return quality.orphaned_type_refs(L.transactions, L.types)


@register("orphaned_senders", "V2", sql="""
SELECT COUNT(*) AS orphaned_senders FROM transactions t
WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account_id = t.sender_id)""")
def _v2(L):
    return quality.orphaned_senders(L.transactions, L.accounts)


@register("orphaned_recipients", "V3", sql="""
SELECT COUNT(*) AS orphaned_recipients FROM transactions t
WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account_id = t.recipient_id)""")
def _v3(L):
    return quality.orphaned_recipients(L.transactions, L.accounts)


@register("negative_amounts", "V4", sql="""
SELECT COUNT(*) AS negative_amounts FROM transactions WHERE amount < 0""")
def _v4(L):
    return quality.negative_amounts(L.transactions)


_V5 = """
SELECT (SELECT COUNT(*) FROM staging) AS staging_rows,
       (SELECT COUNT(*) FROM transactions) AS core_rows,
       (SELECT COUNT(*) FROM staging) - (SELECT COUNT(*) FROM transactions) AS discrepancy"""


@register("row_reconciliation", "V5", sql=_V5)
def _v5(L):
    return quality.row_reconciliation(L.staging, L.transactions)


@register("row_reconciliation_dirty", "V5", variant="dirty", sql=_V5)
def _v5_dirty(L):
    return quality.row_reconciliation(L.staging, L.transactions)


_V6 = """
SELECT is_fraud, COUNT(*) AS count,
       ROUND(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () * 100, 3) AS pct
FROM {t} GROUP BY is_fraud"""


@register("label_distribution", "V6", sql=_V6.format(t="transactions"))
def _v6(L):
    return quality.label_distribution(L.transactions)


_V7 = """
SELECT step, amount, sender_id, recipient_id, COUNT(*) AS dupes FROM transactions
GROUP BY step, amount, sender_id, recipient_id HAVING COUNT(*) > 1
ORDER BY dupes DESC, step, sender_id, recipient_id, amount"""


@register("duplicate_combos", "V7", variant="burst", sql=_V7 + " LIMIT 10")
def _v7(L):
    return quality.duplicate_combos(L.transactions, 10)


@register("duplicate_combos_all", "V7", variant="burst", sql=_V7)
def _v7_all(L):
    return quality.duplicate_combos(L.transactions, None)


# ── 2.2 analytics views and queries ─────────────────────────────────────────
@register("v_transactions", "A1", sql="""
SELECT t.transaction_id, t.step, tt.type_name, t.amount, s.account_ref AS sender_ref,
       s.account_type AS sender_type, t.sender_balance_pre, t.sender_balance_post,
       r.account_ref AS recipient_ref, r.account_type AS recipient_type,
       t.recip_balance_pre, t.recip_balance_post, t.is_fraud, t.is_flagged_fraud
FROM transactions t JOIN types tt ON t.type_id = tt.type_id
JOIN accounts s ON t.sender_id = s.account_id JOIN accounts r ON t.recipient_id = r.account_id""")
def _a1(L):
    return L.v_transactions()


@register("sender_features", "A2", sql="SELECT * FROM sender_features")
def _a2(L):
    return L.compute_sender_features()


@register("ml_features", "A3", sql="SELECT * FROM ml_features")
def _a3(L):
    return L.compute_ml_features()


_A4 = f"""
SELECT tt.type_name, COUNT(*) AS total_transactions, {FRAUD} AS fraud_count,
       {pct_sql(FRAUD, 'COUNT(*)', 2)} AS fraud_rate_pct,
       CAST(SUM(amount) AS DECIMAL(38,2)) AS total_volume,
       CAST(SUM(amount) FILTER (WHERE is_fraud) AS DECIMAL(38,2)) AS fraud_volume
FROM transactions t JOIN types tt ON t.type_id = tt.type_id
GROUP BY tt.type_name"""


@register("fraud_by_type", "A4", sql=_A4 + " ORDER BY fraud_rate_pct DESC")
def _a4(L):
    return reports.fraud_by_type(L.transactions, L.types)


_A5 = f"""
SELECT step, COUNT(*) AS total_txns, {FRAUD} AS fraud_txns,
       CAST(SUM(amount) AS DECIMAL(38,2)) AS total_volume,
       CAST(SUM(amount) FILTER (WHERE is_fraud) AS DECIMAL(38,2)) AS fraud_volume,
       {pct_sql(FRAUD, 'COUNT(*)', 3)} AS fraud_rate_pct
FROM transactions GROUP BY step"""


@register("fraud_trend", "A5", sql=_A5 + " ORDER BY step")
def _a5(L):
    return reports.fraud_trend(L.transactions)


_A6 = """
SELECT account_ref, total_txn_count, fraud_count, fraud_rate, total_amount, avg_amount,
       unique_recipients
FROM sender_features WHERE fraud_count > 0
ORDER BY fraud_rate DESC, fraud_count DESC, sender_id"""


@register("risky_senders", "A6", sql=_A6)
def _a6(L):
    return reports.risky_senders(L.sender_features)


@register("fraud_rate_rank_by_type", "Q1", extra_ctes="""
per_type AS (
  SELECT type_id, COUNT(*) AS n, COALESCE(SUM(CAST(is_fraud AS INTEGER)), 0) AS hits FROM transactions GROUP BY type_id),
shares AS (SELECT type_id, n, hits, CAST(hits AS DOUBLE) / n AS share FROM per_type)""", sql="""
SELECT types.type_name, x.n AS total_txns, CAST(x.hits AS BIGINT) AS fraud_txns,
       ROUND(x.share * 100, 3) AS fraud_rate_pct,
       1 + (SELECT COUNT(*) FROM shares y WHERE y.share > x.share) AS fraud_rank
FROM shares x JOIN types USING (type_id)""")
def _q1(L):
    return reports.fraud_rate_rank_by_type(L.transactions, L.types)


@register("rolling_fraud_rate", "Q2", sql=f"""
SELECT step, step_fraud_rate,
       AVG(step_fraud_rate) OVER (ORDER BY step ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
         AS rolling_10_fraud_rate
FROM (SELECT step, CAST({FRAUD} AS DOUBLE) / NULLIF(COUNT(*), 0) AS step_fraud_rate
      FROM transactions GROUP BY step) h
ORDER BY step""")
def _q2(L):
    return reports.rolling_fraud_rate(L.transactions, 10)


@register("top_risky_senders", "Q3", sql=f"""
SELECT a.account_ref, x.total_txns, x.fraud_txns, x.fraud_volume, x.fraud_rate_pct, x."rank"
FROM (
  SELECT sender_id, COUNT(*) AS total_txns, {FRAUD} AS fraud_txns,
         CAST(SUM(amount) FILTER (WHERE is_fraud) AS DECIMAL(38,2)) AS fraud_volume,
         {pct_sql(FRAUD, 'COUNT(*)', 2)} AS fraud_rate_pct,
         CAST(DENSE_RANK() OVER (ORDER BY {FRAUD} DESC) AS BIGINT) AS "rank"
  FROM transactions GROUP BY sender_id HAVING {FRAUD} > 0
  ORDER BY fraud_txns DESC, sender_id LIMIT 20) x
JOIN accounts a ON a.account_id = x.sender_id
ORDER BY x.fraud_txns DESC""")
def _q3(L):
    return reports.top_risky_senders(L.transactions, L.accounts, 20)


_MOMENTS = """(SELECT sender_id, CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS mean_amt,
         stddev_samp(CAST(amount AS DOUBLE)) AS std_amt FROM transactions GROUP BY sender_id)"""


@register("sender_anomalies", "Q4", sql=f"""
SELECT x.transaction_id, a.account_ref, x.amount, x.mean_amt, x.std_amt, x.z_score, x.is_fraud
FROM (
  SELECT t.transaction_id, t.sender_id, t.amount, ss.mean_amt, ss.std_amt,
         ROUND((CAST(t.amount AS DOUBLE) - ss.mean_amt) / ss.std_amt, 2) AS z_score, t.is_fraud
  FROM transactions t JOIN {_MOMENTS} ss ON t.sender_id = ss.sender_id
  WHERE ss.std_amt > 0 AND (CAST(t.amount AS DOUBLE) - ss.mean_amt) / ss.std_amt > 3
  ORDER BY z_score DESC, t.transaction_id LIMIT 50) x
JOIN accounts a ON a.account_id = x.sender_id
ORDER BY x.z_score DESC""")
def _q4(L):
    return reports.sender_anomalies(L.transactions, L.accounts, 3.0, 50)


@register("sender_anomalies_all", "Q4b", sql=f"""
SELECT t.transaction_id, a.account_ref, t.amount,
       ROUND((CAST(t.amount AS DOUBLE) - ss.mean_amt) / NULLIF(ss.std_amt, 0), 2) AS z_score,
       t.is_fraud
FROM transactions t JOIN {_MOMENTS} ss ON t.sender_id = ss.sender_id
JOIN accounts a ON t.sender_id = a.account_id
WHERE (CAST(t.amount AS DOUBLE) - ss.mean_amt) / NULLIF(ss.std_amt, 0) > 3
ORDER BY z_score DESC""")
def _q4b(L):
    return reports.sender_anomalies_all(L.transactions, L.accounts, 3.0)


@register("receive_only_accounts", "Q5", sql="""
SELECT a.account_ref, x.recv_count, x.recv_total, CAST(0 AS BIGINT) AS sent_count
FROM (
  SELECT recipient_id, COUNT(*) AS recv_count, CAST(SUM(amount) AS DECIMAL(38,2)) AS recv_total
  FROM transactions t
  WHERE NOT EXISTS (SELECT 1 FROM transactions s WHERE s.sender_id = t.recipient_id)
  GROUP BY recipient_id HAVING COUNT(*) > 5
  ORDER BY recv_total DESC, recipient_id LIMIT 20) x
JOIN accounts a ON a.account_id = x.recipient_id
ORDER BY x.recv_total DESC""")
def _q5(L):
    return reports.receive_only_accounts(L.transactions, L.accounts, 5, 20)


@register("amount_percentiles", "Q6", sql="""
SELECT tt.type_name,
       quantile_cont(CAST(amount AS DOUBLE), 0.25) AS p25,
       quantile_cont(CAST(amount AS DOUBLE), 0.50) AS p50,
       quantile_cont(CAST(amount AS DOUBLE), 0.75) AS p75,
       quantile_cont(CAST(amount AS DOUBLE), 0.90) AS p90,
       quantile_cont(CAST(amount AS DOUBLE), 0.99) AS p99,
       MAX(amount) AS max_amount
FROM transactions t JOIN types tt ON t.type_id = tt.type_id GROUP BY tt.type_name""")
def _q6(L):
    return reports.amount_percentiles(L.transactions, L.types)


_Q7 = """
SELECT a.account_ref, t.step, COUNT(*) AS txn_count, CAST(SUM(t.amount) AS DECIMAL(38,2)) AS step_volume
FROM transactions t JOIN accounts a ON t.sender_id = a.account_id
GROUP BY a.account_ref, t.step HAVING COUNT(*) > 5"""


@register("burst_senders", "Q7", variant="burst", sql=_Q7 + " ORDER BY txn_count DESC")
def _q7(L):
    return reports.burst_senders(L.transactions, L.accounts, 5)


_Q8 = """
SELECT t.transaction_id, t.sender_id, t.step, t.sender_balance_pre, b.prev_post AS prev_balance_post,
       CAST(GREATEST(t.sender_balance_pre - b.prev_post, b.prev_post - t.sender_balance_pre) AS DECIMAL(38,2)) AS inconsistency
FROM transactions t JOIN before b ON b.transaction_id = t.transaction_id
WHERE b.prev_post IS NOT NULL AND (t.sender_balance_pre > b.prev_post + 0.01 OR t.sender_balance_pre < b.prev_post - 0.01)
ORDER BY inconsistency DESC, t.transaction_id"""


@register("balance_inconsistency", "Q8", sql=_Q8 + " LIMIT 20")
def _q8(L):
    return reports.balance_inconsistency(L.transactions, 0.01, 20)


@register("balance_inconsistency_all", "Q8", sql=_Q8)
def _q8_all(L):
    return reports.balance_inconsistency(L.transactions, 0.01, None)


@register("feature_completeness", "F1", sql="""
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE sender_amount_zscore IS NULL) AS null_zscores,
       COUNT(*) FILTER (WHERE sender_prev_amount IS NULL) AS null_lag_amount,
       COUNT(*) FILTER (WHERE sender_total_txns IS NULL) AS null_sender_stats
FROM ml_features""")
def _f1(L):
    return quality.feature_completeness(L.ml_features)


@register("feature_class_balance", "F2", sql=_V6.format(t="ml_features"))
def _f2(L):
    return quality.label_distribution(L.ml_features)


_F34 = f"""
SELECT {{c}}, COUNT(*) AS count, {FRAUD} AS fraud_count,
       {pct_sql(FRAUD, 'COUNT(*)', 2)} AS fraud_rate_pct
FROM ml_features GROUP BY {{c}} ORDER BY {{c}}"""


@register("fraud_by_drained", "F3", sql=_F34.format(c="sender_drained"))
def _f3(L):
    return quality.fraud_by_flag(L.ml_features, "sender_drained")


@register("fraud_by_empty_dest", "F4", sql=_F34.format(c="dest_was_empty"))
def _f4(L):
    return quality.fraud_by_flag(L.ml_features, "dest_was_empty")


# ── 2.3 dashboard data ──────────────────────────────────────────────────────
@register("kpi_summary", "D1", sql=f"""
SELECT CAST(SUM(total_transactions) AS BIGINT) AS total_txns,
       CAST(SUM(fraud_count) AS BIGINT) AS total_fraud,
       CAST(SUM(total_volume) AS DECIMAL(38,2)) AS total_volume,
       CAST(COALESCE(SUM(fraud_volume), 0) AS DECIMAL(38,2)) AS fraud_volume,
       COALESCE({pct_sql('SUM(fraud_count)', 'SUM(total_transactions)', 3)}, 0.0) AS fraud_rate_pct
FROM ({_A4}) x""")
def _d1(L):
    return dash.kpi_summary(reports.fraud_by_type(L.transactions, L.types))


@register("high_rate_types", "D2", sql=f"""
SELECT type_name, fraud_rate_pct, fraud_rate_pct > 5.0 AS is_high_rate FROM ({_A4}) x""")
def _d2(L):
    return dash.high_rate_types(reports.fraud_by_type(L.transactions, L.types))


@register("type_table", "D3", sql=f"""
SELECT type_name AS "Type", total_transactions AS "Total", fraud_count AS "Fraud",
       fraud_rate_pct AS "Fraud %" FROM ({_A4}) x""")
def _d3a(L):
    return dash.type_table(reports.fraud_by_type(L.transactions, L.types))


@register("risky_table", "D3", sql=f"""
SELECT account_ref AS "Account", total_txn_count AS "Total Txns", fraud_count AS "Fraud Txns",
       CAST(ROUND(fraud_rate * 100, 2) AS VARCHAR) || '%' AS "Fraud Rate",
       '$' || format('{{:,.0f}}', CAST(total_amount AS DOUBLE)) AS "Total Volume",
       unique_recipients AS "Unique Recipients"
FROM ({_A6} LIMIT 20) x""")
def _d3b(L):
    return dash.risky_table(reports.risky_senders(L.sender_features, 20))


@register("balanced_sample", "D4", sql=f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY is_fraud
            ORDER BY {portable_hash_sql('transaction_id')}, transaction_id) AS rn
  FROM ml_features) x
WHERE rn <= 2500""")
def _d4(L):
    return dash.balanced_sample(L.ml_features, 5000, 42)


_REQUEST = """
SELECT t.transaction_id, tt.type_name, t.amount, t.sender_balance_pre, t.sender_balance_post,
       t.recip_balance_pre, t.recip_balance_post
FROM transactions t JOIN types tt ON t.type_id = tt.type_id"""


@register("derive_request_features", "D6", sql=f"""
SELECT *,
  CAST(sender_balance_pre - sender_balance_post AS DECIMAL(38,2)) AS sender_balance_drop,
  CAST(recip_balance_post - recip_balance_pre AS DECIMAL(38,2)) AS recipient_balance_gain,
  CAST(ABS(amount - (recip_balance_post - recip_balance_pre)) AS DECIMAL(38,2)) AS dest_balance_mismatch,
  CASE WHEN sender_balance_post = 0 THEN 1 ELSE 0 END AS sender_drained,
  CASE WHEN recip_balance_pre = 0 THEN 1 ELSE 0 END AS dest_was_empty
FROM ({_REQUEST}) r""")
def _d6(L):
    req = L.transactions.join(L.types, "type_id").select(
        "transaction_id", "type_name", "amount", "sender_balance_pre", "sender_balance_post",
        "recip_balance_pre", "recip_balance_post")
    out = dash.derive_request_features(req)
    for c in ("sender_balance_drop", "recipient_balance_gain", "dest_balance_mismatch"):
        out = out.withColumn(c, F.col(c).cast(SUM_MONEY))
    return out


_ALIGN = ",\n".join(
    [f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in FEATURE_COLS]
    + [f"CASE WHEN type_name = '{n}' THEN 1.0 ELSE 0.0 END AS type_{n}" for n in SEED_TYPE_NAMES])


@register("align_features", "D5/M2/M3", sql=f"SELECT transaction_id, {_ALIGN} FROM ml_features")
def _d5(L):
    return dash.align_features(L.ml_features, FEATURE_COLS + TYPE_DUMMIES,
                               keep=["transaction_id"])


_SIG = """
SELECT transaction_id, is_fraud,
       sender_drained = 1 AS sig_drained,
       dest_was_empty = 1 AS sig_empty_dest,
       COALESCE(dest_balance_mismatch > amount * 0.05, FALSE) AS sig_mismatch,
       COALESCE(sender_txns_same_step > 3, FALSE) AS sig_velocity,
       COALESCE(sender_amount_zscore > 2.5, FALSE) AS sig_anomalous
FROM ml_features"""

_SCORED = f"""scored AS (
  SELECT transaction_id, CAST(is_fraud AS INTEGER) AS label,
         CAST(CAST(sig_drained AS INTEGER) + CAST(sig_empty_dest AS INTEGER)
              + CAST(sig_mismatch AS INTEGER) + CAST(sig_velocity AS INTEGER)
              + CAST(sig_anomalous AS INTEGER) AS DOUBLE) / 5 AS score
  FROM ({_SIG}) s
),
counts AS (
  SELECT score, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label = 0) AS neg
  FROM scored GROUP BY score
),
cum AS (
  SELECT score, pos, neg,
         SUM(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         SUM(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
         SUM(pos) OVER () AS "P", SUM(neg) OVER () AS "N"
  FROM counts
),
cells AS (
  SELECT COUNT(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn,
         COUNT(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
         COUNT(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn,
         COUNT(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp
  FROM scored
)"""


@register("risk_signals", "D8", sql=_SIG)
def _d8(L):
    return dash.risk_signals(L.ml_features)


# ── 2.4 model-free metrics (score = share of the five signals) ──────────────
def _scored(L):
    return dash.signal_score(L.ml_features)


def _pred(L, threshold=0.5):
    s = _scored(L)
    return s.withColumn("prediction", (F.col("score") >= threshold).cast("int"))


@register("signal_scores", "D8/M10", extra_ctes=_SCORED, sql="SELECT * FROM scored")
def _scores(L):
    return _scored(L)


@register("roc_auc", "M10", extra_ctes=_SCORED, sql="""
SELECT ROUND(SUM(pos * ("N" - fp + neg * 0.5)) / (MAX("P") * MAX("N")), 12) AS roc_auc FROM cum""")
def _m10(L):
    return metrics.roc_auc(_scored(L))


@register("average_precision", "M11", extra_ctes=_SCORED, sql="""
SELECT ROUND(SUM((CAST(pos AS DOUBLE) / "P") * (CAST(tp AS DOUBLE) / (tp + fp))), 12)
  AS average_precision FROM cum""")
def _m11(L):
    return metrics.average_precision(_scored(L))


@register("classification_report", "M12", extra_ctes=_SCORED, sql="""
SELECT v.class, v.precision, v.recall, v.f1_score, v.support FROM (
  SELECT p0, r0, f0, s0, p1, r1, f1, s1, acc, n FROM (
    SELECT *,
      CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
      CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1
    FROM (
      SELECT COALESCE(CAST(tn AS DOUBLE) / NULLIF(tn + fn, 0), 0.0) AS p0,
             COALESCE(CAST(tn AS DOUBLE) / NULLIF(tn + fp, 0), 0.0) AS r0,
             COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0) AS p1,
             COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0.0) AS r1,
             tn + fp AS s0, tp + fn AS s1,
             COALESCE(CAST(tp + tn AS DOUBLE) / NULLIF(tn + fp + fn + tp, 0), 0.0) AS acc,
             tn + fp + fn + tp AS n
      FROM cells) a) b) m,
LATERAL (VALUES
  ('Legit', p0, r0, f0, s0),
  ('Fraud', p1, r1, f1, s1),
  ('accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n),
  ('macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
  ('weighted avg', (p0 * s0 + p1 * s1) / CAST(n AS DOUBLE), (r0 * s0 + r1 * s1) / CAST(n AS DOUBLE),
                   (f0 * s0 + f1 * s1) / CAST(n AS DOUBLE), n)
) v(class, precision, recall, f1_score, support)""")
def _m12(L):
    return metrics.classification_report(_pred(L), "label", "prediction")


@register("confusion_matrix", "M13", extra_ctes=_SCORED, sql="""
SELECT actual, predicted, count FROM cells,
LATERAL (VALUES (0, 0, tn), (0, 1, fp), (1, 0, fn), (1, 1, tp)) v(actual, predicted, count)""")
def _m13(L):
    return metrics.confusion_matrix(_pred(L), "label", "prediction")


@register("roc_curve", "M14", extra_ctes=_SCORED, sql="""
SELECT score AS threshold, CAST(fp AS DOUBLE) / NULLIF("N", 0) AS fpr,
       CAST(tp AS DOUBLE) / NULLIF("P", 0) AS tpr FROM cum
UNION ALL SELECT NULL, 0.0, 0.0 ORDER BY threshold DESC NULLS FIRST""")
def _m14(L):
    return metrics.roc_curve(_scored(L))


@register("pr_curve", "M15", extra_ctes=_SCORED, sql="""
SELECT score AS threshold, CAST(tp AS DOUBLE) / NULLIF("P", 0) AS recall,
       CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) AS precision FROM cum
UNION ALL SELECT NULL, 0.0, 1.0 ORDER BY threshold DESC NULLS FIRST""")
def _m15(L):
    return metrics.pr_curve(_scored(L))


@register("threshold_sweep", "M19", extra_ctes=_SCORED, sql="""
SELECT g.threshold,
       COUNT(*) FILTER (WHERE s.label = 1 AND s.score >= g.threshold) AS tp,
       COUNT(*) FILTER (WHERE s.label = 0 AND s.score >= g.threshold) AS fp,
       COUNT(*) FILTER (WHERE s.label = 1 AND s.score < g.threshold) AS fn,
       COUNT(*) FILTER (WHERE s.label = 0 AND s.score < g.threshold) AS tn,
       COALESCE(CAST(COUNT(*) FILTER (WHERE s.label = 1 AND s.score >= g.threshold) AS DOUBLE)
                / NULLIF(COUNT(*) FILTER (WHERE s.score >= g.threshold), 0), 0.0) AS precision,
       COALESCE(CAST(COUNT(*) FILTER (WHERE s.label = 1 AND s.score >= g.threshold) AS DOUBLE)
                / NULLIF(COUNT(*) FILTER (WHERE s.label = 1), 0), 0.0) AS recall
FROM (SELECT CAST(i AS DOUBLE) / 100 AS threshold FROM range(1, 100) r(i)) g
CROSS JOIN scored s
GROUP BY g.threshold ORDER BY g.threshold""")
def _m19(L):
    return metrics.threshold_sweep(_scored(L))


@register("select_best", "M17", extra_ctes=_SCORED + """,
drained AS (
  SELECT score, SUM(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         SUM(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
         pos, SUM(pos) OVER () AS "P"
  FROM (SELECT CAST(sender_drained AS DOUBLE) AS score,
               COUNT(*) FILTER (WHERE is_fraud) AS pos, COUNT(*) FILTER (WHERE NOT is_fraud) AS neg
        FROM ml_features GROUP BY 1) d
),
board AS (
  SELECT 'signals' AS model, ROUND(SUM((CAST(pos AS DOUBLE) / "P") * (CAST(tp AS DOUBLE) / (tp + fp))), 12)
         AS pr_auc FROM cum
  UNION ALL
  SELECT 'drained', ROUND(SUM((CAST(pos AS DOUBLE) / "P") * (CAST(tp AS DOUBLE) / (tp + fp))), 12)
  FROM drained
)""", sql="SELECT model, pr_auc FROM board ORDER BY pr_auc DESC, model LIMIT 1")
def _m17(L):
    scored = _scored(L)
    drained = L.ml_features.select(F.col("sender_drained").cast("double").alias("score"),
                                   F.col("is_fraud").cast("int").alias("label"))
    board = (metrics.average_precision(scored).select(F.lit("signals").alias("model"),
                                                      F.col("average_precision").alias("pr_auc"))
             .unionByName(metrics.average_precision(drained).select(
                 F.lit("drained").alias("model"), F.col("average_precision").alias("pr_auc"))))
    return metrics.select_best(board, "pr_auc")


# ML data operators (sampling, split, weights, SMOTE, models) live in ml_plans.
ml_plans.register_all(register, pct_sql)

from .ml_registry import register_models  # noqa: E402

register_models(register)

from .stream_registry import register_streams  # noqa: E402

register_streams(register, _A5, _Q7, f"SELECT transaction_id, {', '.join(FEATURE_COLS)} FROM ml_features", _SIG)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: e.fn for k, e in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in REGISTRY.items() if e.sql}
