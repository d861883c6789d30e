"""Structured Streaming re-aim of the batch reports and scoring.

Events arrive in any order, and an hour is never closed: a late transaction belongs into
its hour's figures like any other. So nothing is thrown away behind a watermark. Each
micro-batch is reduced to additive partial sums per (hour, sender), which a published
table takes in once per batch number; the reports add the partials up when they are read,
and exact totals are there at any moment. Runs of partials are merged from time to time,
so that a reader has few files to open. Rows that break a rule of the core tables are
stored with their reasons, batch by batch, in the same way.

Scoring gives an arriving row the context that the batch features have: its sender's
totals come from the stored sender table, the transactions of its hour from the partials
of all batches before and from its own batch. A batch that is run again after a failure
finds the state that it found the first time, because its own partials are stored last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import count_if, money_sum, normalize_type, pct, sum_if
from ..ml import models
from ..operators import dashboard as dash
from ..operators import features as feat
from ..operators.ingest import validate_constraints
from ..schemas import FEATURE_COLS, MONEY, SUM_MONEY
from ..sources.fixtures import staging_from_events
from ..sources.versions import PublishedTable

PARTIALS = ("step int, account_ref string, txns long, fraud_txns long, volume decimal(38,2), "
            "fraud_volume decimal(38,2)")
#: Batches whose partials are merged into one.
MERGE_EVERY = 32


def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None
                 ) -> DataFrame:
    """readStream over the events Parquet with the batch schema (no inference)."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # The file source watches a folder or a glob; the glob also matches a
    # single events file (new files landing later are picked up as well).
    return reader.parquet(f"{sf_dir.rstrip('/')}/events*.parquet")


def staged_stream(events: DataFrame, variant: str = "clean") -> DataFrame:
    """Staging rows (the mapping needs no other rows); rules are applied per batch."""
    return staging_from_events(events, variant)


def partial_sums(valid: DataFrame) -> DataFrame:
    """Additive sums per (hour, sender); a hot sender is combined map-side."""
    amount = F.col("amount").cast(MONEY)
    return valid.groupBy("step", F.col("name_orig").alias("account_ref")).agg(
        F.count(F.lit(1)).alias("txns"), count_if(F.col("is_fraud") == 1).alias("fraud_txns"),
        money_sum(amount).alias("volume"),
        sum_if(amount, F.col("is_fraud") == 1).cast(SUM_MONEY).alias("fraud_volume"))


def merged(partials: DataFrame) -> DataFrame:
    return partials.groupBy("step", "account_ref").agg(
        F.sum("txns").alias("txns"), F.sum("fraud_txns").alias("fraud_txns"),
        F.sum("volume").cast(SUM_MONEY).alias("volume"), F.sum("fraud_volume").cast(SUM_MONEY).alias("fraud_volume"))


@dataclass
class StreamStore:
    """What a stream has taken in: partial sums, and the rows it had to reject."""

    spark: SparkSession
    path: str
    merge_every: int = MERGE_EVERY

    def __post_init__(self):
        self.hours = PublishedTable(self.spark, f"{self.path}/hours", PARTIALS)
        self.rejected = PublishedTable(self.spark, f"{self.path}/rejected")

    def bind(self, checkpoint_path: str) -> dict:
        """Batch numbers count from the query's checkpoint; another one starts at 0 again
        and its batches would be taken for old ones."""
        note = self.hours.manifest()["note"].get("checkpoint", checkpoint_path)
        if note != checkpoint_path:
            raise ValueError(f"{self.path} belongs to the stream with the checkpoint {note}")
        return {"checkpoint": checkpoint_path}

    def take_in(self, valid: DataFrame, rejected: DataFrame, batch: int, note: dict) -> None:
        self.rejected.append(rejected, batch, note)
        self.hours.append(partial_sums(valid), batch, note)
        if len(self.hours.manifest()["folders"]) > self.merge_every:
            self.merge()

    def merge(self) -> None:
        """All partials as one run, ordered by hour so that an hour's rows lie together.
        The batch number stays, and readers of older versions aren't touched."""
        whole = merged(self.hours.read())
        self.hours.replace(whole.repartitionByRange(F.col("step"), F.col("account_ref"))
                           .sortWithinPartitions("step", "account_ref"))
        self.hours.vacuum()
        self.rejected.vacuum()

    def fraud_trend(self) -> DataFrame:
        """A5 over everything taken in so far."""
        return self.hours.read().groupBy("step").agg(
            F.sum("txns").alias("total_txns"), F.sum("fraud_txns").alias("fraud_txns"),
            F.sum("volume").cast(SUM_MONEY).alias("total_volume"),
            F.sum("fraud_volume").cast(SUM_MONEY).alias("fraud_volume"),
            pct(F.sum("fraud_txns"), F.sum("txns"), 3).alias("fraud_rate_pct")).orderBy("step")

    def bursts(self, min_count: int = 5) -> DataFrame:
        """Q7 over everything taken in so far."""
        return (merged(self.hours.read()).where(F.col("txns") > min_count)
                .select("account_ref", "step", F.col("txns").alias("txn_count"), F.col("volume").alias("step_volume"))
                .orderBy(F.desc("txn_count"), "account_ref", "step"))


def _run(stream: DataFrame, each, checkpoint_path: str) -> None:
    """Every batch that is available now."""
    (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_path)
     .trigger(availableNow=True).start().awaitTermination())


def collect_hours(staged: DataFrame, store: StreamStore, checkpoint_path: str) -> StreamStore:
    """Take a stream of staging rows into the store."""
    note = store.bind(checkpoint_path)

    def each(batch: DataFrame, number: int) -> None:
        store.take_in(*validate_constraints(batch), number, note)

    _run(staged, each, checkpoint_path)
    return store


def with_context(valid: DataFrame, hours: DataFrame, senders: DataFrame) -> DataFrame:
    """The fifteen model features of arriving rows, and type, label and id.

    ``hours`` are the partials of earlier batches, ``senders`` the stored table of sender
    features. Of a sender that the table doesn't know, the history is NULL (0 for the
    model, as everywhere else); the count of its hour is known from the stream itself."""
    rows = valid.select(
        "transaction_id", "step", normalize_type("type").alias("type_name"), F.col("name_orig").alias("account_ref"),
        F.col("amount").cast(MONEY).alias("amount"),
        F.col("old_balance_orig").cast(MONEY).alias("sender_balance_pre"),
        F.col("new_balance_orig").cast(MONEY).alias("sender_balance_post"),
        F.col("old_balance_dest").cast(MONEY).alias("recip_balance_pre"),
        F.col("new_balance_dest").cast(MONEY).alias("recip_balance_post"),
        (F.col("is_fraud") == 1).alias("is_fraud"))
    own = rows.groupBy("step", "account_ref").agg(F.count(F.lit(1)).alias("txns"))
    before = hours.join(own.select("step", "account_ref"), ["step", "account_ref"], "left_semi")
    same_step = own.unionByName(before.select("step", "account_ref", "txns")).groupBy("step", "account_ref").agg(
        F.sum("txns").alias("sender_txns_same_step"))
    known = senders.select(
        "account_ref", F.col("total_txn_count").alias("sender_total_txns"), F.col("avg_amount").alias("sender_avg_amount"),
        F.col("unique_recipients").alias("sender_unique_recipients"), F.col("stddev_amount").alias("_std"))
    out = rows.join(same_step, ["step", "account_ref"]).join(known, "account_ref", "left")
    z = F.when(F.col("_std") == 0, F.lit(0.0)).otherwise(
        (F.col("amount").cast("double") - F.col("sender_avg_amount")) / F.col("_std"))
    return out.select("transaction_id", "step", "account_ref", "type_name", "is_fraud", "amount", "sender_balance_pre",
                      "sender_balance_post", "recip_balance_pre", "recip_balance_post", *feat.balance_features(),
                      "sender_txns_same_step", z.alias("sender_amount_zscore"), "sender_total_txns",
                      "sender_avg_amount", "sender_unique_recipients").select(
        "transaction_id", "step", "account_ref", "type_name", "is_fraud", *FEATURE_COLS)


def scored(rows: DataFrame, model: PipelineModel, features: list[str], threshold: float = 0.5) -> DataFrame:
    """D7 and D8 of rows with context: signals, probability, decision."""
    keep = ["transaction_id", "step", "account_ref", "type_name", "is_fraud"]
    signals = rows.select("*", *dash.signal_columns())
    return models.score(signals, model, features, threshold, keep=[*keep, *dash.SIGNALS])


def score_stream(staged: DataFrame, store: StreamStore, senders: DataFrame, sink: PublishedTable,
                 checkpoint_path: str, model: PipelineModel | None = None, features: list[str] | None = None,
                 threshold: float = 0.5) -> PublishedTable:
    """Give every arriving row its features and signals, and with a model its probability.
    Results are published first and the batch's partials last."""
    note = store.bind(checkpoint_path)

    def each(batch: DataFrame, number: int) -> None:
        valid, rejected = validate_constraints(batch)
        rows = with_context(valid, store.hours.read(), senders)
        if model is None:
            rows = rows.select("*", *dash.signal_columns())
        else:
            rows = scored(rows, model, features, threshold)
        sink.append(rows, number, note)
        store.take_in(valid, rejected, number, note)

    _run(staged, each, checkpoint_path)
    return sink
