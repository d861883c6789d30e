"""Digit scans against plain windows, and selection against sorting."""

import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerscope.functions.scans import amount_digits, id_digit, prefix_scan, score_digits
from ledgerscope.operators import metrics, reports
from ledgerscope.operators.features import amount_ranks
from ledgerscope.operators.ingest import seed_types


def rows(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=repr)


def frame(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    data = [(i, rnd.randint(0, 9), 1 if rnd.random() < 0.5 else rnd.randint(2, 40), Decimal(rnd.randint(0, 10 ** 9)) / 100,
             None if rnd.random() < 0.2 else rnd.randint(0, 50)) for i in range(-50, n)]
    return spark.createDataFrame(data, "id long, step int, k long, amount decimal(18,2), v int")


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_and_lags(spark, descending):
    df = frame(spark)
    got = prefix_scan(df, ["k"], [F.col("step"), id_digit("id", 64)], ["id"], {"amount": "total"}, {"v": "prev"},
                      "in_step", descending)
    order = [F.desc("step"), F.desc("id")] if descending else ["step", "id"]
    w = Window.partitionBy("k").orderBy(*order)
    want = df.select("*", F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
                     F.lag("v").over(w).alias("prev"),
                     F.count(F.lit(1)).over(Window.partitionBy("k", "step")).alias("in_step"))
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_scan_without_keys(spark):
    df = frame(spark, 500)
    got = prefix_scan(df, [], [id_digit("id", 7)], ["id"], {"v": "s"})
    want = df.select("*", F.sum("v").over(Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    assert rows(got.na.fill(0, ["s"])) == rows(want.na.fill(0, ["s"]))
    assert prefix_scan(df.limit(0), [], [id_digit("id", 7)], ["id"], {"v": "s"}).count() == 0


def test_ranks_with_a_hundred_thousand_ties(spark):
    same = spark.range(100_000).select(F.col("id").alias("transaction_id"), F.lit(7).cast("long").alias("sender_id"),
                                       F.lit("25.00").cast("decimal(18,2)").alias("amount"))
    other = frame(spark, 2000).select((F.col("id") + 200_000).alias("transaction_id"), F.col("k").alias("sender_id"), "amount")
    df = same.unionByName(other)
    got = amount_ranks(df)
    assert got.where("amount = 25").first().sender_amount_rank == 1 + other.where("sender_id = 7 AND amount > 25").count()
    w = Window.partitionBy("sender_id").orderBy(F.desc("amount"))
    want = df.select("sender_id", "amount", F.rank().over(w).cast("long").alias("r")).distinct()
    assert rows(got) == rows(want)


def test_amounts_fall_into_bounded_segments(spark):
    df = spark.createDataFrame([(Decimal("9999999999999999.99"),), (Decimal("10000.00"),), (Decimal("9999.99"),)],
                               "amount decimal(18,2)")
    digits = [tuple(r) for r in df.select(*amount_digits("amount")).collect()]
    assert digits == [(999_999, 999_999_999_999), (0, 1), (0, 0)]


def test_score_digits_follow_the_order(spark):
    rnd = random.Random(4)
    scores = sorted({rnd.random() ** k for k in (1, 5, 40) for _ in range(400)} | {0.0, 1.0, 0.5, 0.25, 5e-324, 1e-310}
                    | {0.5 + i * 2.0 ** -52 for i in range(200)} | {1 - i * 2.0 ** -53 for i in range(200)}
                    | {-x for x in (0.1, 0.2, 3.0, 1e-9)} | {7.0, 1e6})
    df = spark.createDataFrame([(s,) for s in scores], "score double")
    first, second = score_digits("score")
    found = sorted((r.score, r.a, r.b) for r in df.select("score", first.alias("a"), second.alias("b")).collect())
    assert [x[1:] for x in found] == sorted(x[1:] for x in found)


def test_curves_of_many_scores(spark):
    rnd = random.Random(9)
    data = [(rnd.random() ** 3, int(rnd.random() < 0.3)) for _ in range(3000)] + [(0.5, 1), (0.5, 0)] * 500
    df = spark.createDataFrame(data, "score double, label int")
    got = {r.threshold: (r.fpr, r.tpr) for r in metrics.roc_curve(df).collect()}
    pos, neg = sum(y for _, y in data), sum(1 - y for _, y in data)
    for t in random.Random(1).sample(sorted({s for s, _ in data}), 200):
        tp, fp = sum(y for s, y in data if s >= t), sum(1 - y for s, y in data if s >= t)
        assert got[t] == (fp / neg, tp / pos)


def test_nothing_is_stored(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")

    def size():
        return sum(len(f) for _, _, f in os.walk(folder))

    before, df = size(), frame(spark)
    prefix_scan(df, ["k"], [F.col("step"), id_digit("id")], ["id"], {"amount": "t"}).count()
    metrics.roc_auc(df.select((F.col("amount") / 1e7).cast("double").alias("score"), (F.col("v") > 40).cast("int").alias("label"))).collect()
    assert size() == before


def test_percentiles_are_selected(spark):
    rnd = random.Random(2)
    amounts = {1: [Decimal(rnd.randint(0, 10 ** 18 - 1)) / 100 for _ in range(501)], 2: [Decimal("5.00")] * 1000,
               3: [Decimal("-3.25"), Decimal("0.00"), Decimal("9999999999999999.99")], 4: [Decimal("1.10")]}
    data = [(t, a) for t, own in amounts.items() for a in own] + [(1, None), (5, None)]
    df = spark.createDataFrame(data, "type_id long, amount decimal(18,2)")
    out = reports.amount_percentiles(df, seed_types(spark))
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    names = {r.type_name: r.type_id for r in seed_types(spark).collect()}
    got = {names[r.type_name]: r for r in out.collect()}
    assert set(got) == {1, 2, 3, 4}
    for t, own in amounts.items():
        own = sorted(own)
        assert got[t].max_amount == own[-1]
        for p, name in zip(reports.PERCENTILES, ("p25", "p50", "p75", "p90", "p99")):
            at = (len(own) - 1) * p
            lo, hi = float(own[int(at)]), float(own[-int(-at // 1)] if at % 1 else own[int(at)])
            assert got[t][name] == pytest.approx(lo + (hi - lo) * (at % 1), rel=1e-12, abs=1e-9)
