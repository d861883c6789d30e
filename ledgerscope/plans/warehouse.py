"""Loads that follow each other, as published tables.

Every load publishes a new version of each table it changes, so queries that are running
keep what they read, and a load that failed half-way is simply run again under its batch
number: tables that took it in are left as they are. Types and accounts are replaced (new
rows, touched accounts), transactions and rejected rows are appended.

Transactions lie in a folder per day, so a range of hours reads its own files only.

Sender features (A2) are refreshed from the new transactions only. What is stored are
mergeable parts: count, exact sum, squared deviations, extremes, and for the distinct
recipients bitmaps over the dense account ids.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import count_if, money_sum, rate, safe_div
from ..operators import ingest
from ..schemas import SUM_MONEY
from ..session import measured
from ..sources.versions import PublishedTable

#: Exact products of a sum and a count: sums below 10^22, counts below 10^12.
SUM_EXACT, COUNT_EXACT = "decimal(24,2)", "decimal(12,0)"

#: Hours whose transactions lie in one folder.
DAY = 24


def day_of(step: str):
    return F.floor(F.col(step) / DAY).cast("int")


def moments(transactions: DataFrame) -> DataFrame:
    """Mergeable parts of A2 per sender; combined map-side, so a hot sender is cheap."""
    n = F.count(F.lit(1))
    return transactions.groupBy("sender_id").agg(
        n.alias("n"), money_sum("amount").alias("total"),
        (F.var_pop(F.col("amount").cast("double")) * n).alias("m2"),
        F.max("amount").alias("max_amount"), F.min("amount").alias("min_amount"),
        count_if("is_fraud").alias("fraud_count"),
        F.min("step").alias("first_step"), F.max("step").alias("last_step"))


def merge_moments(a: DataFrame, b: DataFrame) -> DataFrame:
    """Parts of the rows of both. The difference of the means enters squared deviations
    as an exact decimal, so equal amounts stay at a deviation of exactly 0."""
    x, y = a.alias("x"), b.alias("y")

    def either(c):
        return F.coalesce(F.col(f"x.{c}"), F.col(f"y.{c}"))

    def plus(c):
        return F.coalesce(F.col(f"x.{c}") + F.col(f"y.{c}"), either(c))

    def times(total, n):
        return F.col(total).cast(SUM_EXACT) * F.col(n).cast(COUNT_EXACT)

    gap = (times("y.total", "x.n") - times("x.total", "y.n")).cast("double")
    na, nb = F.col("x.n").cast("double"), F.col("y.n").cast("double")
    m2 = F.col("x.m2") + F.col("y.m2") + gap * gap / (na * nb * (na + nb))
    return x.join(y, F.col("x.sender_id") == F.col("y.sender_id"), "full_outer").select(
        either("sender_id").alias("sender_id"), plus("n").alias("n"), plus("total").cast(SUM_MONEY).alias("total"),
        F.coalesce(m2, either("m2")).alias("m2"),
        F.greatest("x.max_amount", "y.max_amount").alias("max_amount"),
        F.least("x.min_amount", "y.min_amount").alias("min_amount"), plus("fraud_count").alias("fraud_count"),
        F.least("x.first_step", "y.first_step").alias("first_step"),
        F.greatest("x.last_step", "y.last_step").alias("last_step"))


def recipient_bitmaps(transactions: DataFrame) -> DataFrame:
    """(sender_id, bucket, bits): which recipients a sender has, 32,768 ids a bitmap."""
    return (transactions.groupBy("sender_id", F.bitmap_bucket_number("recipient_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("recipient_id")).alias("bits")))


def merge_bitmaps(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("sender_id", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


class Warehouse:
    """The core tables and the state of the sender features under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        names = ("types", "accounts", "transactions", "rejected", "moments", "recipients")
        self.types, self.accounts, self.transactions, self.rejected, self.moments, self.recipients = (
            PublishedTable(spark, f"{self.path}/{n}", partitioned=n == "transactions") for n in names)

    def load(self, staging: DataFrame, as_of: datetime | None = None, batch: int | None = None) -> int:
        """Take in one load; the number it has. ON CONFLICT DO NOTHING throughout: known
        types, accounts and transaction ids are left alone, known accounts are touched."""
        if batch is None:
            batch = self.transactions.manifest()["batch"] + 1
        valid, rejected = ingest.validate_constraints(staging)
        self.rejected.append(rejected, batch)
        if not self.types.took(batch):
            known = self.types.read() if self.types.exists() else ingest.seed_types(self.spark)
            self.types.replace(ingest.upsert_types(valid, known), batch)
        if not self.accounts.took(batch):
            known = self.accounts.read() if self.accounts.exists() else None
            self.accounts.replace(ingest.merge_accounts(valid, known, as_of), batch)
        if not self.transactions.took(batch):
            there = self.transactions.read() if self.transactions.exists() else None
            rows = ingest.promote_transactions(
                valid, measured(self.types.read()), self.accounts.read(), as_of, existing=there)
            # by ranges, so that a busy day spreads over several tasks and files
            dealt = rows.withColumn("day", day_of("step")).repartitionByRange("day", "transaction_id")
            self.transactions.append(dealt, batch, shape=lambda w: w.partitionBy("day"))
        return batch

    def between(self, first_step: int, last_step: int) -> DataFrame:
        """Transactions of some hours; files of other days aren't opened."""
        days = F.col("day").between(first_step // DAY, last_step // DAY)
        return self.transactions.read().where(days & F.col("step").between(first_step, last_step))

    def with_refs(self) -> DataFrame:
        """Transactions with the refs of their accounts."""
        accounts, out = self.accounts.read(), self.transactions.read()
        for side in ("sender", "recipient"):
            out = out.join(accounts.select(F.col("account_id").alias(f"{side}_id"),
                                           F.col("account_ref").alias(f"{side}_ref")), f"{side}_id")
        return out

    def _fresh(self, state: PublishedTable) -> tuple[DataFrame | None, dict]:
        """Transactions that a state has not taken in yet."""
        folders = self.transactions.manifest()["folders"]
        done = set(state.manifest()["note"].get("folders", []))
        new = [f for f in folders if f not in done]
        rows = self.transactions.read({"folders": new}) if new else None
        return rows, {"folders": folders}

    def refresh(self) -> None:
        """C11 for A2: take the transactions of new loads into the stored parts."""
        for state, parts, merge in ((self.moments, moments, merge_moments),
                                    (self.recipients, recipient_bitmaps, merge_bitmaps)):
            rows, note = self._fresh(state)
            if rows is not None:
                fresh = parts(rows)
                state.replace(merge(state.read(), fresh) if state.exists() else fresh, note=note)

    def sender_features(self) -> DataFrame:
        """A2 from the stored parts."""
        unique = self.recipients.read().groupBy("sender_id").agg(
            F.sum(F.bitmap_count("bits")).alias("unique_recipients"))
        refs = self.accounts.read().select(F.col("account_id").alias("sender_id"), "account_ref")
        n = F.col("n")
        return self.moments.read().join(unique, "sender_id").join(refs, "sender_id").select(
            "sender_id", n.alias("total_txn_count"), F.col("total").alias("total_amount"),
            safe_div("total", "n").alias("avg_amount"),
            F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("stddev_amount"), "max_amount", "min_amount", "fraud_count",
            rate("fraud_count", "n", 4).alias("fraud_rate"), "unique_recipients",
            (F.col("last_step") - F.col("first_step")).alias("active_duration_steps"), "account_ref")

    def vacuum(self) -> None:
        for table in (self.types, self.accounts, self.transactions, self.rejected, self.moments, self.recipients):
            table.vacuum()
