"""Published tables, loads that follow each other, incremental refresh, line order."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerscope.operators import features as feat
from ledgerscope.operators import ingest
from ledgerscope.plans.layers import fixture_layers
from ledgerscope.plans.warehouse import Warehouse, merge_bitmaps, merge_moments, moments, recipient_bitmaps
from ledgerscope.schemas import CSV_COLUMNS, MALFORMED
from ledgerscope.sources.files import csv_load
from ledgerscope.sources.versions import MANIFESTS, PublishedTable


def rows(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=repr)


@pytest.fixture(scope="module")
def layers(spark):
    return fixture_layers(spark, SF_SMALL)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_readers_keep_their_version(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t")
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.append(numbers(spark, 1, 2))
    old = table.read()
    table.replace(table.read().select((F.col("v") * 10).alias("v")))  # reads what it replaces
    table.append(numbers(spark, 5))
    assert rows(old) == [(1,), (2,)] and rows(table.read()) == [(10,), (20,), (5,)]
    table.vacuum(keep=1)
    assert rows(table.read()) == [(10,), (20,), (5,)]
    assert len(list((tmp_path / "t").glob("data-*"))) == 2
    assert len(list((tmp_path / "t" / MANIFESTS).glob("*.json"))) == 1


def test_batches_are_taken_once_and_versions_are_nobody_elses(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", "v int")
    assert rows(table.read()) == []
    assert table.append(numbers(spark, 1), batch=0) and not table.append(numbers(spark, 1), batch=0)
    with pytest.raises(Exception, match="exist"):
        table._publish(1, {"version": 1, "folders": [], "batch": 9, "note": {}})
    assert rows(table.read()) == [(1,)]


def test_a_torn_manifest_is_no_version(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t")
    table.append(numbers(spark, 1))
    (tmp_path / "t" / MANIFESTS / "000000000002.json").write_text('{"version": 2, "fol')
    assert rows(table.read()) == [(1,)]
    table.append(numbers(spark, 2))
    assert rows(table.read()) == [(1,), (2,)] and table.manifest()["version"] == 3


def test_two_loads_equal_one(spark, layers, tmp_path):
    w = Warehouse(spark, f"{tmp_path}/w")
    w.load(layers.staging.where("step < 400"))
    w.refresh()
    before = w.sender_features()
    w.load(layers.staging.where("step >= 300"))
    before.count()  # still readable
    w.refresh()
    plain = layers.v_transactions()
    assert rows(w.with_refs(), "transaction_id", "amount", "sender_ref", "recipient_ref") == rows(
        plain, "transaction_id", "amount", "sender_ref", "recipient_ref")
    ids = sorted(r[0] for r in w.accounts.read().select("account_id").collect())
    assert ids == list(range(1, len(ids) + 1)) == list(range(1, layers.accounts.count() + 1))
    got = {r.account_ref: r for r in w.sender_features().collect()}
    want = {r.account_ref: r for r in layers.sender_features.collect()}
    assert set(got) == set(want)
    for ref, a in want.items():
        b = got[ref]
        assert (b.stddev_amount is None) == (a.stddev_amount is None)
        assert b.stddev_amount == pytest.approx(a.stddev_amount, rel=1e-11)
        for c in ("total_txn_count", "total_amount", "max_amount", "min_amount", "fraud_count", "fraud_rate",
                  "unique_recipients", "active_duration_steps", "avg_amount"):
            assert b[c] == a[c], c


def test_a_load_that_failed_is_run_again(spark, layers, tmp_path):
    w = Warehouse(spark, f"{tmp_path}/w")
    w.load(layers.staging.where("step < 300"))
    second = layers.staging.where("step >= 300")
    valid, rejected = ingest.validate_constraints(second)
    w.rejected.append(rejected, 1)
    w.accounts.replace(ingest.merge_accounts(valid, w.accounts.read()), 1)  # and then it died
    w.load(second, batch=1)
    w.load(second, batch=1)
    assert w.transactions.read().count() == 1000 == w.transactions.read().select("transaction_id").distinct().count()
    assert w.accounts.manifest()["version"] == 2 and w.rejected.manifest()["version"] == 2


def test_refresh_reads_new_transactions_only(spark, layers, tmp_path):
    w = Warehouse(spark, f"{tmp_path}/w")
    w.load(layers.staging.where("step < 300"))
    w.refresh()
    w.load(layers.staging.where("step >= 300"))
    fresh, _ = w._fresh(w.moments)
    assert fresh.count() == layers.staging.where("step >= 300").count()
    w.refresh()
    assert w._fresh(w.moments)[0] is None and w._fresh(w.recipients)[0] is None


def test_merged_moments(spark):
    rnd = random.Random(8)
    data = [(i, 1 if i % 3 else rnd.randint(2, 30), Decimal(rnd.randint(0, 10 ** 9)) / 100, rnd.randint(1, 90_000), i % 7 == 0, i % 50)
            for i in range(2000)] + [(5000 + i, 99, Decimal("0.10"), 4, False, 1) for i in range(9)]
    df = spark.createDataFrame(data, "transaction_id long, sender_id long, amount decimal(18,2), recipient_id long, "
                                     "is_fraud boolean, step int")
    whole = {r.sender_id: r for r in feat.sender_stats(df).collect()}
    parts = [moments(df.where(F.col("transaction_id") % 4 == k)) for k in range(4)]
    merged = {r.sender_id: r for r in merge_moments(merge_moments(parts[0], parts[1]), merge_moments(parts[2], parts[3])).collect()}
    assert set(merged) == set(whole) and merged[99].m2 == 0.0
    for s, r in whole.items():
        m = merged[s]
        assert (m.n, m.total, m.max_amount, m.min_amount, m.fraud_count) == (
            r.total_txn_count, r.total_amount, r.max_amount, r.min_amount, r.fraud_count)
        assert m.n == 1 or (m.m2 / (m.n - 1)) ** 0.5 == pytest.approx(r.stddev_amount, rel=1e-12)
    bits = merge_bitmaps(recipient_bitmaps(df.where("step < 20")), recipient_bitmaps(df.where("step >= 10")))
    got = {r.sender_id: r.u for r in bits.groupBy("sender_id").agg(F.sum(F.bitmap_count("bits")).alias("u")).collect()}
    assert got == {s: r.unique_recipients for s, r in whole.items()}


def test_ids_follow_files_and_lines(spark, tmp_path):
    sizes = {"a.csv": 30, "b.csv": 4000, "c.csv": 700}
    for name, n in sizes.items():
        lines = [f"{i},PAYMENT,{i}.25,C{name}{i},1,1,M1,0,0,0,0" for i in range(n)]
        lines[7] = "broken" + name
        (tmp_path / name).write_text("\n".join([",".join(CSV_COLUMNS), *lines]) + "\n")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # several splits a file, large ones are dealt first
    try:
        got = csv_load(spark, str(tmp_path), number_from=11).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    want, at = {}, 11
    for name, n in sizes.items():
        for i in range(n):
            want[at] = f"broken{name}" if i == 7 else f"C{name}{i}"
            at += 1
    assert {r.transaction_id: r[MALFORMED] or r.name_orig for r in got} == want


def test_amounts_at_the_limit(spark):
    cases = {"9999999999999999.99": True, "9999999999999999.994": True, "9999999999999999.995": False, "-1": False,
             "10000000000000000": False}
    base = fixture_layers(spark, SF_SMALL).staging.limit(1)
    for amount, good in cases.items():
        valid, parked = ingest.validate_constraints(base.withColumn("amount", F.lit(Decimal(amount)).cast("decimal(38,6)")))
        assert valid.count() == int(good) and parked.count() == int(not good), amount


def test_hours_read_their_own_files(spark, layers, tmp_path):
    w = Warehouse(spark, f"{tmp_path}/w")
    w.load(layers.staging.where("step < 400"))
    w.load(layers.staging.where("step < 400"))  # nothing new
    w.load(layers.staging)
    whole, part = w.transactions.read(), w.between(100, 130)
    assert rows(part, "transaction_id") == rows(layers.transactions.where("step BETWEEN 100 AND 130"), "transaction_id")
    scan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "day#" in scan.split("PartitionFilters")[1]
    days = {r.day for r in part.select("day").distinct().collect()}
    read = {f for f in part.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert days <= {4, 5} and 0 < len(read) < len(whole.inputFiles()) / 5
    assert whole.count() == 1000
