import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.periods import holdout_labels, split_by_period
from ledgerlens.operators.stats import (
    binary_metrics, class_report, class_weight_table, class_weights, mode_value, null_counts, value_counts,
)


def day(y, m=1, d=1):
    return dt.datetime(y, m, d)


@pytest.fixture(scope="module", params=["timestamp_ntz", "timestamp", "date"])
def dated(spark, request):
    dates = [day(2020), day(2021, 3, 1), day(2021, 6, 30), day(2021, 7, 1), day(2022, 5, 5)]
    df = spark.createDataFrame([(i, str(t)) for i, t in enumerate(dates)] + [(9, None)], "i int, s string")
    return df.withColumn("t", F.col("s").cast(request.param)).drop("s")


def ids(df):
    return sorted(r.i for r in df.collect())


def test_period_bounds_belong_to_it(dated):
    train, evaluation, _ = split_by_period(dated, "t", "2021-03-01", "2021-06-30")
    assert (ids(train), ids(evaluation)) == ([0], [1, 2])
    train, evaluation, _ = split_by_period(dated, "t", "2021-03-01", "2021-06-30", after_end="train")
    assert (ids(train), ids(evaluation)) == ([0, 3, 4], [1, 2])


def test_period_out_of_range(dated):
    with pytest.warns(UserWarning):
        train, evaluation, period = split_by_period(dated, "t", "2030-01-01", "2031-01-01")
    assert (period.start, period.end) == (day(2021), day(2022, 5, 5))
    assert (ids(train), ids(evaluation)) == ([0], [1, 2, 3, 4])


def test_holdout(spark):
    df = spark.createDataFrame(
        [("a", 0, "old"), ("b", 0, "old"), ("c", None, "old"), ("d", 1, "old"), ("e", 0, "old")],
        "k string, label int, repeat_phase_property_type string",
    )
    evaluation = spark.createDataFrame(
        [("a", 1, "Landed"), ("a", 2, "High Rise"), ("c", 1, None), ("d", 1, "Landed"), ("e", 1, "RSKU")],
        "k string, t int, kind string",
    )
    rp, pt = holdout_labels(df, evaluation, "k", "kind", ["t"], exclude=["RSKU", "Industrial"])
    assert {r.k: r.label for r in rp.collect()} == {"a": 1, "b": 0, "c": 1, "e": 1}
    assert {r.k: r.repeat_phase_property_type for r in pt.collect()} == {"a": "High Rise", "c": None}


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), ("c",), (None,), (None,), (None,)], "x string")
    assert df.select(mode_value(df, "x").alias("m")).first()["m"] == "a"
    assert [(r.x, r.n) for r in value_counts(df, "x").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    none = df.where("x is null")
    assert none.select(mode_value(none, "x").alias("m")).first()["m"] is None
    assert {r["column"]: r.n_null for r in null_counts(df).collect()} == {"x": 3}


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2 + [(None,)], "y int")
    assert class_weights(df, "y") == {0: 8 / 12, 1: 2.0}
    assert {r.y: r.weight for r in class_weight_table(df, "y").collect()} == {0: 8 / 12, 1: 2.0}
    with pytest.raises(ValueError):
        class_weights(df.where("y = 0"), "y")


def metrics(spark, pairs):
    return binary_metrics(spark.createDataFrame(pairs, "t int, p int"), "t", "p").first().asDict()


def test_metrics(spark):
    assert metrics(spark, [(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)]) == {
        "tp": 1, "tn": 2, "fp": 1, "fn": 1, "accuracy": 0.6, "precision": 0.5, "recall": 0.5, "f1": 0.5,
    }
    assert metrics(spark, [(1, 0), (0, 0)])["precision"] == 0.0
    assert metrics(spark, [(0, 0)])["f1"] == 0.0


def test_class_report(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] * 1 + [(1, 1)] * 2 + [(1, 0)] * 2
    out = {r["class"]: r for r in class_report(spark.createDataFrame(pairs, "t int, p int"), "t", "p").collect()}
    assert out["0"].precision == 0.6 and out["0"].recall == 0.75 and out["0"].support == 4
    assert out["1"].precision == pytest.approx(2 / 3) and out["1"].recall == 0.5
    assert out["accuracy"].f1 == 0.625 and out["macro avg"].recall == 0.625
    assert out["weighted avg"].precision == pytest.approx((0.6 + 2 / 3) / 2)
