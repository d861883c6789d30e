"""Malformed and out-of-range input is quarantined; curves have their end points."""

from ledgerscope.operators import ingest, metrics
from ledgerscope.schemas import CSV_COLUMNS, MALFORMED
from ledgerscope.sources.files import csv_load

GOOD = "1,PAYMENT,10.5,C1,100,89.5,M1,0,0,0,0"


def load(spark, tmp_path, lines):
    (tmp_path / "raw.csv").write_text("\n".join([",".join(CSV_COLUMNS), *lines]) + "\n")
    return csv_load(spark, str(tmp_path / "raw.csv"), mark_malformed=True)


def test_malformed_lines(spark, tmp_path):
    bad = ["1,PAYMENT,10.5,C2,garbage,89.5,M1,0,0,0,0", "1,PAYMENT,10.5,C3", GOOD + ",extra,fields"]
    valid, parked = ingest.validate_constraints(load(spark, tmp_path, [GOOD, *bad]))
    assert [r.name_orig for r in valid.collect()] == ["C1"] and MALFORMED not in valid.columns
    rows = parked.collect()
    assert sorted(r[MALFORMED] for r in rows) == sorted(bad) and all("malformed" in r.reasons for r in rows)


def test_amounts_beyond_the_columns(spark, tmp_path):
    lines = [GOOD, "1,PAYMENT,1e20,C2,100,89.5,M1,0,0,0,0", "1,PAYMENT,1,C3,1e17,89.5,M1,0,0,0,0"]
    valid, parked = ingest.validate_constraints(load(spark, tmp_path, lines))
    assert [r.name_orig for r in valid.collect()] == ["C1"]
    assert {r.name_orig: list(r.reasons) for r in parked.collect()} == {
        "C2": ["amount_out_of_range"], "C3": ["balance_out_of_range"]}


def test_curve_ends(spark):
    scored = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.4, 1), (0.1, 0)], "score double, label int")
    roc = [(r.threshold, r.fpr, r.tpr) for r in metrics.roc_curve(scored).collect()]
    assert roc[0] == (None, 0.0, 0.0) and roc[1] == (0.9, 0.0, 0.5) and roc[-1] == (0.1, 1.0, 1.0)
    pr = [(r.threshold, r.recall, r.precision) for r in metrics.pr_curve(scored).collect()]
    assert pr[0] == (None, 0.0, 1.0) and pr[-1] == (0.1, 1.0, 0.5)
