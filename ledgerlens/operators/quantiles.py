"""Exact order statistics and equal-frequency binning.

A quantile sketch, merged on the map side, brackets every wanted rank in a
narrow value range; one aggregate counts exactly the rows below and inside the
ranges. Only the rows inside are exchanged, as counts per value, so a value
held by a third of the rows is one row. If they are still many values, they are
put in order over many slices and only slices with a wanted rank are numbered.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.columns import cut_right, plain_number, range_label
from ..session import stage
from .sequence import ordered_slices

DIRECT_ROWS = 200_000
ACCURACY = 10_000  # sketch error: one in 10,000 of the rows
SLACK = 5 / ACCURACY


@dataclass(frozen=True)
class Cut:
    """How to bin one numeric column."""

    bins: int
    interpolation: str = "linear"
    suffix: str = ""
    numbered: bool = False
    missing: str | None = None

    def __post_init__(self):
        if self.interpolation not in ("linear", "midpoint"):
            raise ValueError(f"unknown interpolation {self.interpolation!r}")
        if self.bins < 1:
            raise ValueError("bins must be positive")


def _ranks(cut: Cut, n: int) -> list[tuple[int, int, int, float]]:
    """``(point, low rank, high rank, part)``: point p of q sits at p*(n-1)/q."""
    out = []
    for point in range(cut.bins + 1):
        whole, rest = divmod(point * (n - 1), cut.bins)
        part = rest / cut.bins
        if rest and cut.interpolation == "midpoint":
            part = 0.5
        out.append((point, whole, whole + (rest > 0), part))
    return out


def _brackets(cut: Cut, sketch: Sequence[float]) -> list[tuple[float, float]]:
    """Disjoint value ranges that should hold all wanted ranks."""
    pairs = sorted(zip(sketch[0::2], sketch[1::2]))
    merged = [list(pairs[0])]
    for low, high in pairs[1:]:
        if low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    return [tuple(m) for m in merged]


def _fractions(cut: Cut) -> list[float]:
    out = []
    for point in range(cut.bins + 1):
        at = point / cut.bins
        out += [max(0.0, at - SLACK), min(1.0, at + SLACK)]
    return out


def _narrow(data: DataFrame, cuts: Mapping[str, Cut], first) -> dict[str, list[tuple]]:
    """Per column ``[(low, high, rows below, rows inside)]`` around the wanted ranks.

    One aggregate counts exactly what the sketch guessed. A column whose
    ranks are not all inside is taken whole.
    """
    guess = {c: _brackets(cut, first[f"s_{c}"]) for c, cut in cuts.items()}
    aggregates = []
    for c, ranges in guess.items():
        for i, (low, high) in enumerate(ranges):
            aggregates.append(F.count_if(F.col(c) < low).alias(f"b_{c}_{i}"))
            aggregates.append(F.count_if(F.col(c).between(low, high)).alias(f"i_{c}_{i}"))
    counted = data.agg(*aggregates).first()
    out = {}
    for c, cut in cuts.items():
        n = first[f"n_{c}"]
        ranges = [
            (low, high, counted[f"b_{c}_{i}"], counted[f"i_{c}_{i}"])
            for i, (low, high) in enumerate(guess[c])
        ]
        covered = all(
            any(below <= r < below + inside for _, _, below, inside in ranges)
            for _, low, high, _ in _ranks(cut, n)
            for r in (low, high)
        )
        out[c] = ranges if covered else [(-math.inf, math.inf, 0, n)]
    return out


def order_statistics(
    df: DataFrame, cuts: Mapping[str, Cut], direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """``(column, point, edge)``: the bins+1 percentile points of every column.

    Ranks are exact. Nulls and NaN take no part. All columns share each pass;
    ``df`` is read up to three times, so stage it if it is costly.
    """
    if not cuts:
        raise ValueError("no columns to cut")
    data = df.select([plain_number(F.col(c)).alias(c) for c in cuts])
    first = data.agg(
        *[F.count(c).alias(f"n_{c}") for c in cuts],
        *[
            F.percentile_approx(c, _fractions(cut), ACCURACY).alias(f"s_{c}")
            for c, cut in cuts.items()
        ],
    ).first()
    cuts = {c: cut for c, cut in cuts.items() if first[f"n_{c}"]}
    if not cuts:
        return df.sparkSession.createDataFrame([], "column string, point int, edge double")
    rows = sum(first[f"n_{c}"] for c in cuts)
    if rows <= direct_rows:
        ranges = {c: [(-math.inf, math.inf, 0, first[f"n_{c}"])] for c in cuts}
    else:
        ranges = _narrow(data, cuts, first)

    def near(c: str) -> Column:
        tests = [F.col(c).between(low, high) for low, high, _, _ in ranges[c]]
        return F.when(reduce(or_, tests), F.col(c))

    pairs = ", ".join(f"'{c}', `{c}`" for c in cuts)
    counts = (
        data.select([near(c).alias(c) for c in cuts])
        .select(F.expr(f"stack({len(cuts)}, {pairs}) as (column, value)"))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    # rank of every wanted point among the rows kept for its column
    wanted = []
    for c, cut in cuts.items():
        for point, low, high, part in _ranks(cut, first[f"n_{c}"]):
            for side, rank in (("low", low), ("high", high)):
                kept = 0
                for _, _, below, inside in ranges[c]:
                    if below <= rank < below + inside:
                        wanted.append((c, point, side, part, kept + rank - below))
                        break
                    kept += inside
    kept_rows = sum(r[3] for rs in ranges.values() for r in rs)
    if kept_rows > direct_rows:
        counts = stage(counts, "value-counts")
        kept_rows = counts.count()
    found = (
        _pick_directly(counts, wanted) if kept_rows <= direct_rows else _pick_by_slice(counts, wanted)
    )
    low = F.max(F.when(F.col("side") == "low", F.col("value")))
    high = F.max(F.when(F.col("side") == "high", F.col("value")))
    part = F.max("part")
    edge = F.when(part < 0.5, low + (high - low) * part).otherwise(high - (high - low) * (1 - part))
    return found.groupBy("column", "point").agg(edge.alias("edge"))


WANTED = "column string, point int, side string, part double, rank long"


def _hits(numbered: DataFrame, targets: DataFrame, on: Sequence[str]) -> DataFrame:
    """Values whose ranks cover a target. Two targets per point: a few dozen rows."""
    inside = (F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("n"))
    return numbered.join(F.broadcast(targets), list(on)).where(inside)


def _pick_directly(counts: DataFrame, wanted: list) -> DataFrame:
    """Number at most ``direct_rows`` values with one window."""
    targets = counts.sparkSession.createDataFrame(wanted, WANTED)
    upto = F.sum("n").over(W.partitionBy("column").orderBy("value"))
    return _hits(counts.withColumn("_upto", upto), targets, ["column"])


def _pick_by_slice(counts: DataFrame, wanted: list) -> DataFrame:
    """Order the values over many slices; only slices with a target are numbered."""
    slices = ordered_slices(counts, ["column", "value"])
    # one row per slice and column
    sizes = slices.groupBy("column", "_slice").agg(F.sum("n").alias("n")).collect()
    targets = []
    for column, point, side, part, rank in wanted:
        for r in sorted((r for r in sizes if r["column"] == column), key=lambda r: r["_slice"]):
            if rank < r["n"]:
                targets.append((column, point, side, part, rank, r["_slice"]))
                break
            rank -= r["n"]
    targets = counts.sparkSession.createDataFrame(targets, f"{WANTED}, _slice int")
    used = slices.join(F.broadcast(targets.select("column", "_slice").distinct()), ["column", "_slice"], "left_semi")
    upto = F.sum("n").over(W.partitionBy("column", "_slice").orderBy("value"))
    return _hits(used.withColumn("_upto", upto), targets, ["column", "_slice"])


def fit_edges(df: DataFrame, cuts: Mapping[str, Cut]) -> dict[str, list[float]]:
    """Distinct ascending edges per column: at most bins+1 numbers each."""
    edges: dict[str, set[float]] = {c: set() for c in cuts}
    for r in order_statistics(df, cuts).collect():
        edges[r["column"]].add(r["edge"])
    return {c: sorted(v) for c, v in edges.items()}


def bin_labels(edges: Sequence[float], cut: Cut) -> list[str]:
    """One label per bin; ``numbered`` adds the bin number to keep labels apart."""
    out = []
    for i, (low, high) in enumerate(zip(edges, edges[1:]), start=1):
        number = f" ({i})" if cut.numbered else ""
        out.append(range_label(low, high, cut.suffix + number))
    return out


def bin_columns(
    df: DataFrame,
    cuts: Mapping[str, Cut],
    edges: Mapping[str, Sequence[float]] | None = None,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``<column>_category`` per cut, on given edges or on the data's own."""
    edges = edges if edges is not None else fit_edges(df, cuts)
    names = names or {}
    added = {}
    for c, cut in cuts.items():
        label = cut_right(plain_number(F.col(c)), edges[c], bin_labels(edges[c], cut))
        if cut.missing is not None:
            label = F.coalesce(label, F.lit(cut.missing))
        added[names.get(c, f"{c}_category")] = label
    return df.withColumns(added)
