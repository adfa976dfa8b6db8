"""Approximate edges from stored, mergeable quantile sketches.

Each slice of a table (a day, a load) leaves one small sketch a column, of a size that does not depend on the rows.
Sketches merge, so edges follow new slices without reading the old rows again. For exact edges see ``quantiles``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import plain_number
from .quantiles import Cut

#: The sketch's parameter. Of ranks from one merged sketch all are off by less than RANK_ERROR of the rows with a
#: chance of 99 %; more is more exact and larger.
K, RANK_ERROR = 800, 0.006
SCHEMA = "slice string, column string, sketch binary, n long, low double, high double"


def slice_sketches(df: DataFrame, columns: Sequence[str], by: Column | str, k: int = K) -> DataFrame:
    """``(slice, column, sketch, n, low, high)``: a sketch of each column's values in each slice, in one pass.

    Nulls and NaN are no values; a column without any in a slice has no row there.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), plain_number(F.col(c)).alias("v")) for c in columns])
    part = (F.col(by) if isinstance(by, str) else by).cast("string")
    cell = df.select(part.alias("slice"), F.explode(cells).alias("c")).select("slice", "c.*").where("v is not null")
    # partial sketches are made where the rows are and merged behind the exchange
    return cell.groupBy("slice", "column").agg(
        F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """``(column, sketch, n, low, high)`` of all slices together: sketches in, no rows."""
    return sketches.groupBy("column").agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def sketched_points(sketches: DataFrame, cuts: Mapping[str, Cut]) -> DataFrame:
    """``(column, point, edge)``: the percentile points of each cut from the merged sketches.

    The first and last point are the exact least and largest value. A point between is a value whose rank is
    within RANK_ERROR of the rows of the wanted one.
    """
    whole = merged_sketches(sketches)
    parts = []
    for c, cut in cuts.items():
        ranks = [i / cut.bins for i in range(cut.bins + 1)]
        edges = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(r) for r in ranks]))
        points = whole.where(F.col("column") == c).select("column", "low", "high", F.posexplode(edges).alias("point", "edge"))
        edge = F.when(F.col("point") == 0, F.col("low")).when(F.col("point") == cut.bins, F.col("high")).otherwise(F.col("edge"))
        parts.append(points.select("column", F.col("point").cast("int").alias("point"), edge.alias("edge")))
    return reduce(DataFrame.unionByName, parts)


def sketched_edges(sketches: DataFrame, cuts: Mapping[str, Cut]) -> dict[str, list[float]]:
    """Distinct ascending edges per column, as ``bin_columns`` takes them: at most bins + 1 numbers each."""
    found: dict[str, set[float]] = {c: set() for c in cuts}
    for r in sketched_points(sketches, cuts).collect():
        found[r["column"]].add(r["edge"])
    return {c: sorted(v) for c, v in found.items()}
