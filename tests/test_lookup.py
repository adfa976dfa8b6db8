import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.lookup import (
    attach_group, attach_range, duplicate_keys, flag_member, last_value_per_key, map_values,
    override_first, override_where, require_unique_keys, unmapped_values, upsert_mapping,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def mapping(spark):
    return spark.createDataFrame(
        [("Zambia", "ZAMBIA", 1.0, "OTHERS"), ("Zambia ", "ZAMBIA ", 2.0, "AFRICA"), ("x", "X", 1.0, None)],
        "raw string, clean string, count double, target string",
    )


def test_overrides(spark):
    df = spark.createDataFrame([(1, "Undefined"), (2, "NRIC"), (3, "Undefined"), (4, None)], "id long, v string")
    lookup = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "id long, o string")
    assert rows(override_where(df, lookup, "id", "v", "o", F.col("v") == "Undefined")) == [
        (1, "a"), (2, "NRIC"), (3, None), (4, None)
    ]
    assert rows(override_first(df, lookup, "id", "v", "o")) == [
        (1, "a"), (2, "b"), (3, "Undefined"), (4, "d")
    ]


def test_mapping_keeps_rows_and_defaults(spark, mapping):
    df = spark.createDataFrame([(1, " zambia"), (2, None), (3, "x"), (4, "new")], "id int, v string")
    exact = map_values(df, "v", mapping, "clean", "target", "g", normalise_key=False)
    assert rows(exact.select("id", "g")) == [(1, "OTHERS"), (2, "UNKNOWN"), (3, "UNKNOWN"), (4, "UNKNOWN")]
    # keys that clash once normalised do not multiply the rows
    loose = map_values(df, "v", mapping, "clean", "target", "g")
    assert rows(loose.select("id", "g"))[0] == (1, "AFRICA") and loose.count() == 4
    assert rows(unmapped_values(df, "v", mapping, "clean", "target")) == [("NEW", 1), ("X", 1), (None, 1)]


def test_duplicate_gate(spark, mapping):
    assert duplicate_keys(mapping, "clean").isEmpty()
    twice = mapping.union(mapping.where("clean = 'X'"))
    assert duplicate_keys(twice, "clean").count() == 2
    with pytest.raises(ValueError, match="bad"):
        require_unique_keys({"good": (mapping, "clean"), "bad": (twice, "clean")})


def test_upsert(spark, mapping):
    new = spark.createDataFrame([(" x ", "y"), ("peru", "others")], "clean string, target string")
    got = {r.clean: r.target for r in upsert_mapping(mapping, new, "clean", "target").collect()}
    assert got == {"ZAMBIA": "OTHERS", "ZAMBIA ": "AFRICA", "X": "Y", "PERU": "OTHERS"}
    again = spark.createDataFrame([("zambia", "b"), ("Zambia\u00a0", "a")], "clean string, target string")
    got = sorted((r.clean, r.target) for r in upsert_mapping(mapping, again, "clean", "target").collect())
    assert got == [("X", None), ("ZAMBIA", "A")]


def test_repeated_range_key_is_an_error(spark):
    df = spark.createDataFrame([("p", "1")], "a string, b string")
    ranges = spark.createDataFrame([("p", "1", 5.0), ("p", "1", 6.0), (None, "1", 1.0), (None, "1", 2.0)], "a string, b string, low double")
    with pytest.raises(ValueError, match="more than once"):
        attach_range(df, ranges, ["a", "b"], ["low"])
    assert attach_range(df, ranges.where("low <> 6"), ["a", "b"], ["low"]).count() == 1


def test_range_match(spark):
    df = spark.createDataFrame([("p", "1"), ("p", "2"), (None, "1")], "a string, b string")
    ranges = spark.createDataFrame([("p", "1", 5.0)], "a string, b string, low double")
    out = attach_range(df, ranges, ["a", "b"], ["low"])
    assert rows(out) == rows(
        spark.createDataFrame(
            [("p", "1", 5.0, True), ("p", "2", None, False), (None, "1", None, False)],
            "a string, b string, low double, m boolean",
        )
    )


def test_group_without_key_has_no_group(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 7)], "g string, x int")
    assert rows(attach_group(df, "g", {"m": F.min("x")})) == [("a", 1, 1), ("a", 2, 1), (None, 7, None)]


def test_membership_and_last_value(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    other = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, None), (None, 3, "z")], "k string, t int, kind string"
    )
    assert rows(flag_member(df, other, "k", "f")) == [("a", 1), ("b", 0), (None, 0)]
    # the last row wins even when its value is null
    assert rows(last_value_per_key(other, "k", "kind", ["t"], "last")) == [("a", None)]
