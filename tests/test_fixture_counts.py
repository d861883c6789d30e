"""Contents measured in FIXTURES.md §3 (sf0.001) come out of our layers."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerscope.operators import reports
from ledgerscope.plans.layers import fixture_layers


def test_clean_counts(spark):
    L = fixture_layers(spark, SF_SMALL)
    t = L.transactions
    assert t.count() == 1000
    assert t.select("sender_id").distinct().count() == 15
    assert t.where("is_fraud").count() == 18
    assert t.where("is_flagged_fraud").count() == 2
    assert L.accounts.count() == 355
    assert t.select("step").distinct().count() == 531
    assert reports.sender_anomalies_all(t, L.accounts).count() == 15
    assert reports.receive_only_accounts(t, L.accounts, 5, None).count() == 38
    assert t.groupBy("sender_id", "step").count().where("count > 1").count() == 49
    assert reports.balance_inconsistency(t, 0.01, None).count() == 985
    ml = L.ml_features
    assert ml.where("sender_drained = 1").count() == 201
    assert ml.where("dest_was_empty = 1").count() == 232
    assert ml.where("recip_balance_post = recip_balance_pre").count() == 119


def test_burst_and_dirty_counts(spark):
    burst = fixture_layers(spark, SF_SMALL, "burst")
    assert reports.burst_senders(burst.transactions, burst.accounts).count() == 2
    dirty = fixture_layers(spark, SF_SMALL, "dirty")
    q = dirty.quarantined
    assert q.where(F.array_contains("reasons", "type_null")).count() == 10
    assert q.where(F.array_contains("reasons", "amount_negative")
                   | F.array_contains("reasons", "balance_negative")).count() == 20
    assert q.where(F.array_contains("reasons", "recipient_null")
                   | F.array_contains("reasons", "label_null")).count() == 20
    # REFUND is a new type, appended after the five seeds
    assert [tuple(r) for r in dirty.types.orderBy("type_id").collect()][-1] == (6, "REFUND")
