"""Registry entries of the streaming re-aim: each runs a Structured Streaming query over
all events (Trigger.AvailableNow) into published tables in the shared checkpoint area and
returns what they hold. Partials are complete at any time, so the oracles are those of the
batch reports."""

from __future__ import annotations

import uuid

from ..ml import models
from ..session import scratch_path
from ..sources.versions import PublishedTable
from ..streaming import pipeline as sp
from .layers import fixture_layers
from .ml_registry import trained


def _store(spark, name: str) -> tuple[sp.StreamStore, str]:
    base = scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:12]}")
    return sp.StreamStore(spark, f"{base}/store"), f"{base}/checkpoint"


def _scored(spark, sf_dir, name: str, model=None, features=None):
    store, checkpoint = _store(spark, name)
    sink = PublishedTable(spark, f"{store.path}/scored")
    staged = sp.staged_stream(sp.event_stream(spark, sf_dir))
    senders = fixture_layers(spark, sf_dir).sender_features
    return sp.score_stream(staged, store, senders, sink, checkpoint, model, features).read()


def register_streams(register, fraud_trend_sql: str, burst_sql: str, features_sql: str, signals_sql: str) -> None:
    @register("stream_fraud_trend", "A5/stream", raw=True, bench=False, sql=fraud_trend_sql)
    def _trend(spark, sf_dir):
        store, checkpoint = _store(spark, "trend")
        return sp.collect_hours(sp.staged_stream(sp.event_stream(spark, sf_dir)), store, checkpoint).fraud_trend()

    @register("stream_burst_senders", "Q7/stream", raw=True, bench=False, variant="burst", sql=burst_sql)
    def _bursts(spark, sf_dir):
        store, checkpoint = _store(spark, "bursts")
        staged = sp.staged_stream(sp.event_stream(spark, sf_dir), "burst")
        return sp.collect_hours(staged, store, checkpoint).bursts()

    @register("stream_rejected", "C10/stream", raw=True, bench=False, variant="dirty", sql="""
SELECT transaction_id, array_to_string(reasons, ',') AS reasons FROM quarantined""")
    def _rejected(spark, sf_dir):
        store, checkpoint = _store(spark, "rejected")
        sp.collect_hours(sp.staged_stream(sp.event_stream(spark, sf_dir), "dirty"), store, checkpoint)
        return store.rejected.read().selectExpr("transaction_id", "array_join(reasons, ',') AS reasons")

    @register("stream_features", "D6/stream", raw=True, bench=False, sql=features_sql)
    def _features(spark, sf_dir):
        from ..schemas import FEATURE_COLS

        return _scored(spark, sf_dir, "features").select("transaction_id", *FEATURE_COLS)

    @register("stream_signals", "D8/stream", raw=True, bench=False, sql=signals_sql)
    def _signals(spark, sf_dir):
        from ..operators.dashboard import SIGNALS

        return _scored(spark, sf_dir, "signals").select("transaction_id", "is_fraud", *SIGNALS)

    @register("stream_score", "D6-D8/D7 stream", raw=True, bench=False)
    def _score(spark, sf_dir):
        r = trained(spark, sf_dir)
        model, meta = models.load_artifact(f"{r.artifact_path}/fraud_model")
        return _scored(spark, sf_dir, "score", model, meta["feature_names"])
