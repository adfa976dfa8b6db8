import random

import numpy as np
import pandas as pd
import pytest

from ledgerlens.operators.quantiles import Cut, bin_columns, fit_edges, order_statistics

CASES = {
    "spread": [random.Random(1).uniform(-50, 900) for _ in range(3001)],
    "ties": [random.Random(2).randrange(12) * 1.5 for _ in range(3001)],
    "hot": [7.0] * 1500 + [random.Random(3).uniform(0, 20) for _ in range(1501)],
    "outlier": [random.Random(4).random() for _ in range(3000)] + [1e12],
}
CUTS = {
    "spread": Cut(20, "midpoint"), "ties": Cut(5), "hot": Cut(5, numbered=True), "outlier": Cut(20),
}


@pytest.fixture(scope="module")
def frame(spark):
    rows = list(zip(*CASES.values())) + [(None, float("nan"), None, None)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in CASES)).repartition(7)


def points(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["column"], {})[r["point"]] = r["edge"]
    return {c: [v[i] for i in range(len(v))] for c, v in out.items()}


@pytest.mark.parametrize("direct_rows", [10**9, 500, 0])
def test_points_match_numpy(frame, direct_rows):
    got = points(order_statistics(frame, CUTS, direct_rows=direct_rows))
    for c, cut in CUTS.items():
        want = np.percentile(CASES[c], np.linspace(0, 100, cut.bins + 1), method=cut.interpolation)
        assert np.allclose(got[c], want, rtol=1e-9, atol=1e-9), c


@pytest.mark.parametrize("direct_rows", [10**9, 0])
def test_whole_ranks_are_data_values(spark, direct_rows):
    values = [float(x) / 7 for x in range(0, 101)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = points(order_statistics(df, {"x": Cut(5)}, direct_rows=direct_rows))["x"]
    assert got == [values[i] for i in (0, 20, 40, 60, 80, 100)]


def test_bins_match_pandas_cut(frame):
    cuts = {"spread": Cut(20, "midpoint"), "ties": Cut(5), "hot": Cut(5), "outlier": Cut(20)}
    edges = fit_edges(frame, cuts)
    out = bin_columns(frame, {c: Cut(k.bins, numbered=True) for c, k in cuts.items()}, edges).toPandas()
    for c in cuts:
        want = pd.cut(out[c], bins=edges[c], labels=False, include_lowest=True)
        got = out[f"{c}_category"].str.extract(r"\((\d+)\)$")[0].astype(float) - 1
        assert got.equals(want.astype(float)), c


def test_single_value_and_empty(spark):
    df = spark.createDataFrame([(3.0, None), (3.0, None)], "x double, y double")
    out = bin_columns(df, {"x": Cut(5), "y": Cut(5, missing="NOT APPLICABLE")}).first()
    assert out["x_category"] is None and out["y_category"] == "NOT APPLICABLE"


def test_labels_cut_toward_zero(spark):
    df = spark.createDataFrame([(v,) for v in (-1.9, 0.0, 5.99, 6.0, None)], "x double")
    out = bin_columns(df, {"x": Cut(2, suffix=" SQFT")}, edges={"x": [-1.9, 5.99, 7.2]})
    assert [r["x_category"] for r in out.collect()] == [
        "-1-5 SQFT", "-1-5 SQFT", "-1-5 SQFT", "5-7 SQFT", None
    ]


def test_bad_cut():
    with pytest.raises(ValueError):
        Cut(5, "nearest")
