"""Contiguous shards of near-equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import shuffle_partitions

from .common import exclusive_sums, fresh, others, with_buckets


def shard_by_bytes(docs: DataFrame, shards: int, text: str = "text", order_by: str = "doc_id", overhead: int = 8) -> DataFrame:
    """Adds ``size``, ``shard`` (from 0) and ``slot`` (from 0, gapless in its shard) to each row.

    Rows stand in the order of ``order_by`` (a number or date), nulls first; ties by a hash of the
    text. A row's size is its text's UTF-8 bytes (null: none) plus ``overhead``, at least one in all.
    Quantiles cut the order into partitions; their totals give global prefix sums, and a row
    goes to the shard that holds the middle of its bytes, so no shard is off by more than one row's
    size at either end. Input columns of the same names are replaced. Equal rows may swap slots. No rows:
    no rows.
    """
    if shards < 1 or overhead < 1:
        raise ValueError("shards and overhead must be positive")
    docs = docs.select(*others(docs, "size", "shard", "slot"))
    names = ("_part", "_sub", "_tie", "_before", "_index", "_one", "_total", "_first", "_all")
    part, sub, tie, before, index, one, total, first, every = fresh(docs, *names)
    rows = docs.withColumns({
        "size": (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long"),
        tie: F.xxhash64(text),
        one: F.lit(1).cast("long"),
        every: F.lit(0),
    })
    rows = with_buckets(rows, order_by, tie, part, sub, max(2, shuffle_partitions(docs.sparkSession)))
    rows = exclusive_sums(rows, [every], [part, sub], [order_by, tie, "size"], {before: "size", index: one}, {total: "size"})
    rows = rows.withColumn("shard", F.expr(f"(2 * `{before}` + size) * {shards} div (2 * `{total}`)").cast("int"))
    firsts = rows.groupBy("shard").agg(F.min(index).alias(first))
    rows = rows.join(firsts, "shard").withColumn("slot", F.col(index) - F.col(first))
    return rows.select(*docs.columns, "size", "shard", "slot")
