import datetime as dt
import random

import pytest

from ledgerlens.operators.quantiles import Cut, bin_columns
from ledgerlens.operators.sampling import downsample_near, sample_near
from ledgerlens.operators.sketches import RANK_ERROR, sketched_edges, sketched_points, slice_sketches

CUTS = {"a": Cut(20), "b": Cut(5)}


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = [(i % 9, rng.lognormvariate(0, 2), float(rng.choice([1, 1, 1, 5, 9])) if i % 7 else None) for i in range(60_000)]
    return spark.createDataFrame(rows, "day int, a double, b double"), rows


def within(values, edges, bins):
    values, n = sorted(values), len(values)
    for p, e in enumerate(edges):
        below, upto = sum(v < e for v in values), sum(v <= e for v in values)
        assert below <= n * p / bins + RANK_ERROR * n + 1 and upto >= n * p / bins - RANK_ERROR * n - 1
    assert edges[0] == values[0] and edges[-1] == values[-1]


def test_merged_edges_are_within_the_error(spark, table):
    df, rows = table
    sketches = slice_sketches(df, list(CUTS), "day")
    assert sketches.count() == 18
    for c, cut in CUTS.items():
        points = {r["point"]: r["edge"] for r in sketched_points(sketches, CUTS).where(f"column = '{c}'").collect()}
        at = 1 if c == "a" else 2
        within([r[at] for r in rows if r[at] is not None], [points[p] for p in sorted(points)], cut.bins)


def test_new_slices_are_added_without_the_old_rows(spark, table, tmp_path):
    df, rows = table
    path = str(tmp_path / "sketches")
    slice_sketches(df.where("day < 5"), ["a"], "day").write.parquet(path)
    slice_sketches(df.where("day >= 5"), ["a"], "day").write.mode("append").parquet(path)
    edges = sketched_edges(spark.read.parquet(path), {"a": Cut(20)})
    within([r[1] for r in rows], edges["a"], 20)
    binned = bin_columns(df, {"a": Cut(20, numbered=True)}, edges=edges).groupBy("a_category").count().collect()
    assert sum(r["count"] for r in binned) == 60_000 and max(r["count"] for r in binned) < 60_000 * (0.05 + 2 * RANK_ERROR) + 2


def test_no_values(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), None, float("nan"))], "day date, a double, b double")
    assert slice_sketches(df, ["a", "b"], "day").isEmpty()
    assert sketched_edges(slice_sketches(df, ["a", "b"], "day"), CUTS) == {"a": [], "b": []}


def test_threshold_samples(spark):
    df = spark.range(40_000).selectExpr("id", "cast(id % 4 = 0 as int) as label", "case when id % 10 < 3 then 'x' when id % 10 < 9 then 'y' end as g")
    assert sample_near(df, {None: 0}, ["id"], 5).isEmpty()
    for n in (100, 2500, 30_000):
        got = {r.id for r in sample_near(df, {None: n}, ["id"], 5).collect()}
        assert abs(len(got) - n) <= 4 * n**0.5
        # the same rows however the table is cut, and a larger sample holds a smaller one
        assert got == {r.id for r in sample_near(df.repartition(7), {None: n}, ["id"], 5).collect()}
        assert got <= {r.id for r in sample_near(df, {None: n + 500}, ["id"], 5).collect()}
    assert sample_near(df, {None: 10**9}, ["id"], 5).count() == 40_000
    parts = {r.g: r["count"] for r in sample_near(df, {"x": 1000, "y": None, "z": 5}, ["id"], 1, "g").groupBy("g").count().collect()}
    assert set(parts) == {"x", "y"} and parts["y"] == 24_000 and abs(parts["x"] - 1000) <= 4 * 1000**0.5
    balanced = {r.label: r["count"] for r in downsample_near(df, "label", ["id"]).groupBy("label").count().collect()}
    assert balanced[1] == 10_000 and abs(balanced[0] - 10_000) <= 400
    assert downsample_near(df, "label", ["id"], ratio=9).count() == 40_000
