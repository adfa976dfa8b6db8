"""Exact-size sampling, hash splits, temporal slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators.sampling import (
    downsample, downsample_near, sample_exact, split_by_hash, split_exact, temporal_splits,
)

from .registry import query, table


def _hash(seed: int, *ids: str) -> str:
    return "md5(" + " || '|' || ".join([f"'{seed}'", *[f"cast({i} as string)" for i in ids]]) + ")"


@query(
    "sample_exact",
    f"select l_orderkey, l_linenumber, l_partkey from lineitem order by {_hash(7, 'l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey')} limit 1000",
)
def sampled(spark, d):
    """A sampling operator: the size asked for is the feature."""
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return sample_exact(table(spark, d, "lineitem"), 1000, ids, seed=7).select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query(
    "downsample_exact",
    f"""
with o as (select o_orderkey, cast(o_orderpriority = '1-URGENT' as int) as label from orders),
r as (select *, row_number() over (partition by label order by {_hash(123, 'o_orderkey')}, o_orderkey) as rn from o)
select o_orderkey, label from r where label = 1 or rn <= 2 * (select count(*) from o where label = 1)
""",
)
def balanced(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("label")
    )
    return downsample(rows, "label", ["o_orderkey"], ratio=2)


@query(
    "downsample_near",
    f"""
with o as (select o_orderkey, cast(o_orderpriority = '1-URGENT' as int) as label, ('0x' || substr({_hash(123, 'o_orderkey')}, 1, 13))::bigint as place from orders),
n as (select count(*) filter (label = 1) as ones, count(*) filter (label = 0) as zeros from o)
select o_orderkey, label from o, n where label = 1 or place < 4503599627370496::hugeint * least(2 * ones, zeros) // zeros
""",
)
def nearly_balanced(spark, d):
    """A sampling operator: about the size asked for, by a threshold, in one pass after the counts."""
    rows = table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("label")
    )
    return downsample_near(rows, "label", ["o_orderkey"], ratio=2)


def _marked(train, held):
    return train.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("held")))


@query(
    "split_by_hash",
    f"""select o_orderkey, case when cast('0x' || substr({_hash(42, 'o_orderkey')}, 1, 4) as int) < floor(0.2 * 65536)
        then 'held' else 'train' end as part from orders""",
)
def hashed(spark, d):
    return _marked(*split_by_hash(table(spark, d, "orders").select("o_orderkey"), 0.2, ["o_orderkey"]))


@query(
    "split_exact",
    f"""select doc_id, case when row_number() over (order by {_hash(42, 'doc_id')}, doc_id) <= ceil(0.2 * (select count(*) from labels))
        then 'held' else 'train' end as part from labels""",
)
def exact(spark, d):
    return _marked(*split_exact(table(spark, d, "labels").select("doc_id"), 0.2, ["doc_id"]))


@query(
    "temporal_splits",
    """
with y as (select o_orderkey, year(o_orderdate) as y from orders), b as (select min(y) as a, (1999 - min(y)) // 2 as step from y)
select o_orderkey, cast(case when y >= 1999 then 3 when y < a + step then 1 else 2 end as int) as split_id from y, b
""",
)
def slices(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return temporal_splits(rows, "o_orderdate", 3, pivot_year=1999).drop("o_orderdate")


@query(
    "temporal_split_sizes",
    """
with y as (select year(o_orderdate) as y from orders), b as (select min(y) as a, (2000 - min(y)) // 4 as step from y)
select cast(case when y >= 2000 then 5 else least((y - a) // step, 3) + 1 end as int) as split_id, count(*) as n
from y, b group by 1
""",
)
def slice_sizes(spark, d):
    out = temporal_splits(table(spark, d, "orders"), "o_orderdate", 5, pivot_year=2000)
    return out.groupBy("split_id").agg(F.count(F.lit(1)).alias("n"))
