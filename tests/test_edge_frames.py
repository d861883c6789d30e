"""Hand-made edge frames (FIXTURES.md §4)."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerscope.operators import dashboard as dash
from ledgerscope.operators import features as feat
from ledgerscope.operators import metrics, reports
from ledgerscope.operators.ingest import seed_types

TX = ("transaction_id long, step int, type_id long, amount decimal(18,2), sender_id long, "
      "sender_balance_pre decimal(18,2), sender_balance_post decimal(18,2), recipient_id long, "
      "recip_balance_pre decimal(18,2), recip_balance_post decimal(18,2), is_fraud boolean, "
      "is_flagged_fraud boolean")


def d(x):
    return None if x is None else Decimal(str(x))


def txns(spark, rows):
    return spark.createDataFrame(
        [(i, st, ty, d(a), s, d(p0), d(p1), r, d(q0), d(q1), f, False)
         for i, st, ty, a, s, p0, p1, r, q0, q1, f in rows], TX)


def accounts(spark, n=10):
    return spark.createDataFrame([(i, f"C{i}", "C") for i in range(1, n + 1)],
                                 "account_id long, account_ref string, account_type string")


def ml(spark, t):
    sf = feat.sender_features(t, accounts(spark))
    return feat.ml_features(t, seed_types(spark), sf)


def test_one_row_sender_has_null_zscore_and_lag(spark):
    t = txns(spark, [(1, 0, 1, 10, 1, 10, 0, 2, 0, 10, False)])
    r = ml(spark, t).first()
    assert r["sender_amount_zscore"] is None
    assert r["sender_prev_amount"] is None
    assert r["sender_amount_rank"] == 1 and r["sender_txns_same_step"] == 1


def test_equal_amounts_give_zero_zscore(spark):
    t = txns(spark, [(i, i, 1, 5, 1, 5, 0, 2, 0, 5, False) for i in range(1, 4)])
    assert {r["sender_amount_zscore"] for r in ml(spark, t).collect()} == {0.0}


def test_null_balances_are_not_drained_or_empty(spark):
    t = txns(spark, [(1, 0, 1, 10, 1, None, None, 2, None, None, False)])
    r = ml(spark, t).first()
    assert r["sender_drained"] == 0 and r["dest_was_empty"] == 0
    assert r["dest_balance_mismatch"] is None


def test_two_rows_in_one_step_are_ordered_by_id(spark):
    t = txns(spark, [(2, 5, 1, 7, 1, 7, 0, 2, 0, 7, False), (1, 5, 1, 3, 1, 3, 0, 2, 0, 3, False)])
    rows = {r["transaction_id"]: r for r in ml(spark, t).collect()}
    assert rows[1]["sender_prev_amount"] is None
    assert rows[2]["sender_prev_amount"] == Decimal("3.00")
    assert rows[2]["sender_cumulative_amount"] == Decimal("10.00")
    assert rows[1]["sender_txns_same_step"] == 2


def test_no_fraud_at_all(spark):
    t = txns(spark, [(i, i, 1, i, 1, i, 0, 2, 0, i, False) for i in range(1, 5)])
    assert reports.top_risky_senders(t, accounts(spark)).count() == 0
    scored = t.select(F.lit(0).alias("label"), F.col("amount").cast("double").alias("score"))
    assert metrics.roc_auc(scored).first()[0] is None
    rep = {r["class"]: r for r in metrics.classification_report(
        scored.withColumn("prediction", F.lit(0))).collect()}
    assert rep["Fraud"]["precision"] == 0.0 and rep["Legit"]["recall"] == 1.0


def test_unknown_type_gets_all_zero_dummies(spark):
    df = spark.createDataFrame([("REFUND",), ("PAYMENT",)], "type_name string")
    rows = {r["type_name"]: r for r in dash.one_hot_type(df).collect()}
    assert sum(rows["REFUND"][f"type_{n}"] for n in
               ["PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT"]) == 0.0
    assert rows["PAYMENT"]["type_PAYMENT"] == 1.0


def test_empty_table(spark):
    t = txns(spark, [])
    assert reports.fraud_by_type(t, seed_types(spark)).count() == 0
    assert ml(spark, t).count() == 0
    k = dash.kpi_summary(reports.fraud_by_type(t, seed_types(spark))).first()
    assert k["fraud_rate_pct"] == 0.0 and k["fraud_volume"] is None or k["fraud_volume"] == 0


def test_equal_scores_across_classes(spark):
    s = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "label int, score double")
    assert metrics.roc_auc(s).first()[0] == 0.5
    assert metrics.average_precision(s).first()[0] == 0.5
    sweep = {r["threshold"]: r for r in metrics.threshold_sweep(s).collect()}
    assert sweep[0.5]["tp"] == 2 and sweep[0.51]["tp"] == 0


def test_windows_and_scans_agree_and_windows_need_few_exchanges(spark):
    t = txns(spark, [(i, i // 3, 1, i % 4, 1 if i < 12 else 2, i, 0, 3, 0, i, i % 5 == 0) for i in range(1, 18)]
             + [(99, None, 1, 4, 3, 1, 0, 2, 0, 1, False)])
    sf = feat.sender_features(t, accounts(spark))
    found = [feat.ml_features(t, seed_types(spark), sf, w) for w in (0, 8, 100)]  # all scanned, one scanned, none
    assert len({tuple(sorted(map(repr, f.collect()))) for f in found}) == 1 and found[0].count() == 18
    few = feat.ml_features(t, seed_types(spark), t.sparkSession.createDataFrame(sf.collect(), sf.schema))
    assert few._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2  # totals and types
