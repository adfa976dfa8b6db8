import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.sampling import (
    downsample, sample_exact, split_by_hash, split_exact, temporal_splits,
)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(1000).withColumn("label", (F.col("id") % 5 == 0).cast("int"))


@pytest.mark.parametrize("n", [0, 1, 137, 1000, 5000])
def test_exact_size(frame, n):
    got = {r.id for r in sample_exact(frame, n, ["id"], 3).collect()}
    assert len(got) == min(n, 1000)
    again = {r.id for r in sample_exact(frame.repartition(13), n, ["id"], 3).collect()}
    assert got == again


def test_downsample(frame):
    out = downsample(frame, "label", ["id"], ratio=2)
    assert {r.label: r["count"] for r in out.groupBy("label").count().collect()} == {0: 400, 1: 200}
    with pytest.raises(ValueError, match="without replacement"):
        downsample(frame, "label", ["id"], ratio=5)
    assert downsample(frame, "label", ["id"], ratio=5, clamp=True).count() == 1000
    assert downsample(frame.where("label = 0"), "label", ["id"]).count() == 0
    with pytest.raises(ValueError):
        downsample(frame, "label", ["id"], ratio=6)


def test_splits(frame):
    train, held = split_exact(frame, 0.15, ["id"])
    assert (train.count(), held.count()) == (850, 150)
    assert train.join(held, "id").isEmpty()
    train, held = split_by_hash(frame, 0.2, ["id"])
    assert train.count() + held.count() == 1000 and 150 < held.count() < 250
    with pytest.raises(ValueError):
        split_by_hash(frame, 0.7, ["id"])


@pytest.mark.parametrize(
    "k,first,want",
    [
        (1, 2000, {y: 1 for y in range(2000, 2022)} | {None: 1}),
        (3, 2000, {y: 1 if y < 2007 else 2 if y < 2015 else 3 for y in range(2000, 2022)} | {None: None}),
        (3, 2014, {2014: 2} | {y: 3 for y in range(2015, 2022)} | {None: None}),
        (3, 2016, {y: 3 for y in range(2016, 2022)} | {None: None}),
    ],
)
def test_temporal_slices(spark, k, first, want):
    rows = [(dt.datetime(y, 6, 1),) for y in range(first, 2022)] + [(None,)]
    out = temporal_splits(spark.createDataFrame(rows, "d timestamp_ntz"), "d", k)
    assert {(r.d.year if r.d else None): r.split_id for r in out.collect()} == want


def test_too_many_slices_are_an_error(spark):
    rows = [(dt.datetime(y, 6, 1),) for y in range(2000, 2022)]
    for splits in (0, 6):
        with pytest.raises(ValueError, match="between 1 and 5"):
            temporal_splits(spark.createDataFrame(rows, "d timestamp_ntz"), "d", splits)
