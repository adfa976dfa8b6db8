"""Deterministic sampling, random splits and temporal slices.

Rows are placed by a hash of their identifying columns, so the outcome does
not depend on partitioning and is the same after a recomputation.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.columns import hash_bucket, row_hash
from .stats import bounds

MAX_SPLITS = 5
MAX_RATIO = 5


def hash_order_flag(
    df: DataFrame, sizes: Mapping, ids: Sequence[str], seed: int, flag: str, group: str | None = None
) -> DataFrame:
    """Flag exactly ``sizes[g]`` rows of every group ``g``: those with the smallest hashes.

    ``ids`` must identify a row; without ``group`` all rows are the group None.
    Rows fall into 65,536 hash buckets per group; counting them finds the
    bucket the last row wanted is in. Only that bucket, one row in 65,536, is
    ordered.
    """
    g = F.col(group) if group else F.lit(0)
    sizes = sizes if group else {0: sizes[None]}
    marked = df.withColumns({"_b": hash_bucket(ids, seed), "_g": g})
    counts = marked.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(W.partitionBy("_g").orderBy("_b"))
    counts = counts.withColumn("_upto", upto).withColumn("_size", _case(F.col("_g"), sizes))
    # one row per group: the bucket where its running count reaches the size
    reached = counts.where(F.col("_upto") >= F.col("_size")).groupBy("_g").agg(
        F.min(F.struct("_b", (F.col("_size") - F.col("_upto") + F.col("_n")).alias("need"))).alias("cut")
    )
    cuts = {r["_g"]: r["cut"] for r in reached.collect()}
    bucket = {k: cuts[k]["_b"] if k in cuts else 65536 for k in sizes}
    need = {k: cuts[k]["need"] if k in cuts else 0 for k in sizes}
    last = _case(F.col("_g"), bucket)
    rank = F.row_number().over(W.partitionBy("_g", "_b").orderBy(row_hash(ids, seed), *ids))
    whole = marked.where(~F.coalesce(F.col("_b") == last, F.lit(False))).withColumn(
        flag, F.coalesce(F.col("_b") < last, F.lit(False))
    )
    part = marked.where(F.col("_b") == last).withColumn(flag, rank <= _case(F.col("_g"), need))
    return whole.unionByName(part).drop("_b", "_g")


def _case(key: Column, values: Mapping) -> Column:
    """The value of a key as a CASE over a handful of keys, else null."""
    out = F.lit(None).cast("long")
    for k, v in values.items():
        out = F.when(key == k, F.lit(v).cast("long")).otherwise(out)
    return out


def sample_exact(df: DataFrame, n: int, ids: Sequence[str], seed: int) -> DataFrame:
    """Exactly ``n`` rows without replacement."""
    return hash_order_flag(df, {None: n}, ids, seed, "_take").where("_take").drop("_take")


def downsample(
    df: DataFrame, label: str, ids: Sequence[str], ratio: int = 1, seed: int = 123, clamp: bool = False
) -> DataFrame:
    """All rows of class 1 with ``ratio`` times as many of class 0.

    Asking for more than there are is an error unless ``clamp`` is set.
    """
    one = F.lit(1)
    return downsample_slices(df.withColumn("_s", one), "_s", [1], label, ids, ratio, seed, clamp).drop("_s")


def downsample_slices(
    df: DataFrame,
    slice_id: str,
    slices: Sequence[int],
    label: str,
    ids: Sequence[str],
    ratio: int = 1,
    seed: int = 123,
    clamp: bool = False,
) -> DataFrame:
    """Down-sample every slice on its own, all in one pass."""
    if not 1 <= ratio <= MAX_RATIO:
        raise ValueError(f"ratio must be between 1 and {MAX_RATIO}")
    c = F.col(label)
    counted = df.groupBy(slice_id).agg(F.count_if(c == 0).alias("zeros"), F.count_if(c == 1).alias("ones"))
    sizes = {s: 0 for s in slices}
    for r in counted.where(F.col(slice_id).isin(list(slices))).collect():
        n = r["ones"] * ratio
        if n > r["zeros"] and not clamp:
            raise ValueError(f"cannot take {n} of {r['zeros']} rows without replacement")
        sizes[r[slice_id]] = min(n, r["zeros"])
    zeros = hash_order_flag(df.where(c == 0), sizes, ids, seed, "_take", slice_id)
    return zeros.where("_take").drop("_take").unionByName(df.where(c == 1))


def split_by_hash(
    df: DataFrame, fraction: float, ids: Sequence[str], seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, validation): a row is held out by its own hash; no exchange."""
    _check_fraction(fraction)
    held = hash_bucket(ids, seed) < F.lit(math.floor(fraction * 65536))
    return df.where(~held), df.where(held)


def split_exact(
    df: DataFrame, fraction: float, ids: Sequence[str], seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, validation) with exactly ceil(fraction * rows) rows held out."""
    _check_fraction(fraction)
    flagged = hash_order_flag(df, {None: math.ceil(fraction * df.count())}, ids, seed, "_held")
    return flagged.where(~F.col("_held")).drop("_held"), flagged.where("_held").drop("_held")


def hold_out(
    df: DataFrame, slice_id: str, slices: Sequence[int], fraction: float, ids: Sequence[str],
    flag: str, seed: int = 42,
) -> DataFrame:
    """Flag exactly ceil(fraction * rows) rows of every slice, all in one pass."""
    _check_fraction(fraction)
    counted = df.groupBy(slice_id).agg(F.count(F.lit(1)).alias("n"))
    rows = {r[slice_id]: r["n"] for r in counted.where(F.col(slice_id).isin(list(slices))).collect()}
    sizes = {s: math.ceil(fraction * rows.get(s, 0)) for s in slices}
    return hash_order_flag(df, sizes, ids, seed, flag, slice_id)


def _check_fraction(fraction: float) -> None:
    if not 0 <= fraction <= 0.5:
        raise ValueError("the validation fraction must be between 0 and 0.5")


def temporal_split_id(
    year: Column, min_year: int | None, splits: int, pivot_year: int = 2015
) -> Column:
    """Slice number of a year: equal blocks before ``pivot_year``, one from it on.

    The last block before the pivot takes the years left over. One split takes
    every row, undated ones too.
    """
    if not 1 <= splits <= MAX_SPLITS:
        raise ValueError(f"splits must be between 1 and {MAX_SPLITS}")
    if splits == 1 or min_year is None:
        return F.lit(1)
    blocks = splits - 1
    step = (pivot_year - min_year) // blocks
    out = F.when(year >= pivot_year, splits)
    for i in range(blocks):
        first = min_year + i * step
        last = pivot_year - 1 if i == blocks - 1 else first + step - 1
        out = out.when((year >= first) & (year <= last), i + 1)
    return out


def temporal_splits(
    df: DataFrame, date: str, splits: int = 3, pivot_year: int = 2015, out: str = "split_id"
) -> DataFrame:
    first = bounds(df, date)[0] if splits > 1 else None
    min_year = first.year if first is not None else None
    return df.withColumn(out, temporal_split_id(F.year(date), min_year, splits, pivot_year))


#: Parts of the hash that a threshold can tell apart.
HASH_RANGE = 1 << 52


def sample_near(
    df: DataFrame, sizes: Mapping, ids: Sequence[str], seed: int, group: str | None = None
) -> DataFrame:
    """About ``sizes[g]`` rows of every group ``g``, by a threshold on the hash of their ids; a size of None takes all.

    One aggregate counts the groups, then a filter takes the rows: nothing is exchanged, ordered or numbered. Of
    n rows wanted, fewer or more than 4 sqrt(n) off come once in ten thousand times; the same rows always come
    for the same ids and seed, and a larger size only adds rows. For exact sizes see ``hash_order_flag``.
    Groups that ``sizes`` lacks give no row; groups smaller than their size give all.
    """
    g = F.col(group) if group else F.lit(0)
    sizes = dict(sizes) if group else {0: sizes[None]}
    counted = df.select(g.alias("g")).where(F.col("g").isin(list(sizes))).groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    share = {}
    for r in counted.collect():
        wanted = r["n"] if sizes[r["g"]] is None else min(sizes[r["g"]], r["n"])
        share[r["g"]] = HASH_RANGE * wanted // r["n"]
    place = F.conv(F.substring(row_hash(ids, seed), 1, 13), 16, 10).cast("long")
    return df.where(F.coalesce(place < _case(g, share), F.lit(False)))


def downsample_near(df: DataFrame, label: str, ids: Sequence[str], ratio: float = 1, seed: int = 123) -> DataFrame:
    """All rows of class 1 with about ``ratio`` times as many of class 0, or all of these if there are fewer."""
    ones = df.where(F.col(label) == 1).count()
    return sample_near(df, {1: None, 0: round(ones * ratio)}, ids, seed, label)
