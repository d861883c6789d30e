"""Load paths the fixture layers do not take: raw CSV without ids
(sequential BIGSERIAL ids) and an idempotent second promotion."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerscope.operators import ingest
from ledgerscope.plans.layers import build_layers, fixture_layers
from ledgerscope.sources.files import csv_load, write_csv


def test_csv_without_ids_gets_dense_sequential_ids(spark):
    staged = fixture_layers(spark, SF_SMALL).staging
    path = tempfile.mkdtemp(prefix="ls-csv-", dir="/tmp") + "/raw"
    write_csv(staged, path)
    raw = csv_load(spark, path)
    assert raw.count() == 1000
    assert raw.where(F.col("type").startswith(" ")).count() == staged.where(
        F.col("type").startswith(" ")).count()  # whitespace kept for UPPER(TRIM)
    layers = build_layers(spark, raw.drop("loaded_at"))
    ids = sorted(r[0] for r in layers.transactions.select("transaction_id").collect())
    assert ids == list(range(1, 1001))


def test_second_promotion_is_idempotent(spark):
    L = fixture_layers(spark, SF_SMALL)
    again = ingest.promote_transactions(L.valid, L.types, L.accounts, existing=L.transactions)
    assert again.count() == 0
    first = L.valid.where(F.col("step") < 300)
    part = ingest.promote_transactions(first, L.types, L.accounts)
    rest = ingest.promote_transactions(L.valid, L.types, L.accounts, existing=part)
    assert part.count() + rest.count() == 1000
