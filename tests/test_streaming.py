"""Streams in any order of arrival, over restarts and repeated batches, equal the batch."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerscope.ml import models
from ledgerscope.operators import reports
from ledgerscope.operators.dashboard import SIGNALS, align_features, risk_signals
from ledgerscope.operators.ingest import validate_constraints
from ledgerscope.plans.layers import fixture_layers
from ledgerscope.schemas import FEATURE_COLS, TYPE_DUMMIES
from ledgerscope.sources.versions import PublishedTable
from ledgerscope.streaming import pipeline as sp


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def layers(spark):
    return fixture_layers(spark, SF_SMALL)


def files_in_reverse(spark, folder, parts=4):
    """The events as files by time, the latest hours first to arrive."""
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").toPandas().sort_values("ts", ascending=False)
    size = -(-len(events) // parts)
    for k in range(parts):
        path = f"{folder}/events{k}.parquet"
        events.iloc[k * size:(k + 1) * size].to_parquet(path, index=False, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))


def stream(spark, folder):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    return sp.staged_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                            .parquet(f"{folder}/events*.parquet"))


def test_late_rows_count(spark, layers, tmp_path):
    files_in_reverse(spark, tmp_path)
    store = sp.StreamStore(spark, f"{tmp_path}/store", merge_every=2)
    sp.collect_hours(stream(spark, tmp_path), store, f"{tmp_path}/checkpoint")
    assert store.hours.manifest()["batch"] == 3 and len(store.hours.manifest()["folders"]) <= 3
    assert rows(store.fraud_trend()) == rows(reports.fraud_trend(layers.transactions))
    assert rows(store.bursts(1)) == rows(reports.burst_senders(layers.transactions, layers.accounts, 1))


def test_restart_goes_on(spark, layers, tmp_path):
    files_in_reverse(spark, tmp_path)
    last = f"{tmp_path}/events3.parquet"
    os.rename(last, f"{tmp_path}/later")
    store = sp.StreamStore(spark, f"{tmp_path}/store")
    sp.collect_hours(stream(spark, tmp_path), store, f"{tmp_path}/checkpoint")
    part = store.fraud_trend().agg(F.sum("total_txns")).first()[0]
    assert 0 < part < 1000
    os.rename(f"{tmp_path}/later", last)
    again = sp.StreamStore(spark, f"{tmp_path}/store")
    sp.collect_hours(stream(spark, tmp_path), again, f"{tmp_path}/checkpoint")
    assert rows(again.fraud_trend()) == rows(reports.fraud_trend(layers.transactions))
    with pytest.raises(ValueError):
        again.bind(f"{tmp_path}/another")


def test_a_batch_counts_once(spark, layers, tmp_path):
    store = sp.StreamStore(spark, f"{tmp_path}/store", merge_every=1)
    first, second = layers.staging.where("step < 300"), layers.staging.where("step >= 300")
    for number, part in ((0, first), (0, first), (1, second), (1, second), (0, first)):
        store.take_in(*validate_constraints(part), number, {})
    assert rows(store.fraud_trend()) == rows(reports.fraud_trend(layers.transactions))
    # died between the two tables: rejected rows are in, sums are not
    torn = sp.StreamStore(spark, f"{tmp_path}/torn")
    valid, rejected = validate_constraints(first)
    torn.rejected.append(rejected, 0)
    torn.take_in(valid, rejected, 0, {})
    assert torn.rejected.manifest()["version"] == 1
    assert torn.fraud_trend().agg(F.sum("total_txns")).first()[0] == first.count()


def test_rejected_rows_are_kept(spark, tmp_path):
    dirty = fixture_layers(spark, SF_SMALL, "dirty")
    store = sp.StreamStore(spark, f"{tmp_path}/store")
    staged = sp.staged_stream(sp.event_stream(spark, SF_SMALL), "dirty")
    sp.collect_hours(staged, store, f"{tmp_path}/checkpoint")
    got = store.rejected.read()
    assert rows(got.select("transaction_id", "reasons")) == rows(dirty.quarantined.select("transaction_id", "reasons"))


def test_context_over_batches(spark, layers, tmp_path):
    """The hour's count is what the stream has seen of it, whatever the order; the rest is
    the batch's."""
    files_in_reverse(spark, tmp_path, 3)
    store = sp.StreamStore(spark, f"{tmp_path}/store", merge_every=2)
    sink = PublishedTable(spark, f"{tmp_path}/scored")
    sp.score_stream(stream(spark, tmp_path), store, layers.sender_features, sink, f"{tmp_path}/checkpoint")
    got = {r.transaction_id: r for r in sink.read().collect()}
    want = {r.transaction_id: r for r in layers.ml_features.collect()}
    assert set(got) == set(want)
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").toPandas().sort_values("ts", ascending=False)
    order, seen, batch_of = [i + 1 for i in events.event_id], {}, {}
    size = -(-len(order) // 3)
    for k in range(3):
        part = order[k * size:(k + 1) * size]
        for i in part:
            seen[want[i].sender_id, want[i].step] = seen.get((want[i].sender_id, want[i].step), 0) + 1
        for i in part:
            batch_of[i] = seen[want[i].sender_id, want[i].step]
    for i, r in got.items():
        assert r.sender_txns_same_step == batch_of[i]
        for c in FEATURE_COLS:
            if c != "sender_txns_same_step":
                assert r[c] == want[i][c], c


def test_unknown_senders(spark, layers, tmp_path):
    valid, _ = validate_constraints(layers.staging.limit(20))
    nobody = layers.sender_features.limit(0)
    store = sp.StreamStore(spark, f"{tmp_path}/store")
    out = sp.with_context(valid, store.hours.read(), nobody).collect()
    assert len(out) == 20 and all(r.sender_total_txns is None and r.sender_amount_zscore is None for r in out)
    assert all(r.sender_txns_same_step >= 1 for r in out)


def test_probability_equals_batch(spark, layers, tmp_path):
    features = FEATURE_COLS + TYPE_DUMMIES
    ml = layers.ml_features
    train = align_features(ml.withColumn("label", F.col("is_fraud").cast("int")), features, keep=["label"])
    model = models.lr_pipeline(features, train.count()).pipeline.fit(train)
    store, sink = sp.StreamStore(spark, f"{tmp_path}/store"), PublishedTable(spark, f"{tmp_path}/scored")
    sp.score_stream(sp.staged_stream(sp.event_stream(spark, SF_SMALL)), store, layers.sender_features, sink,
                    f"{tmp_path}/checkpoint", model, features)
    got = {r.transaction_id: r for r in sink.read().collect()}
    want = {r.transaction_id: r for r in models.score(ml, model, features, keep=["transaction_id"]).collect()}
    signals = {r.transaction_id: r for r in risk_signals(ml).collect()}
    assert set(got) == set(want)
    for i, r in got.items():
        assert r.fraud_probability == pytest.approx(want[i].fraud_probability, rel=1e-9)
        assert r.prediction == want[i].prediction and all(r[s] == signals[i][s] for s in SIGNALS)
