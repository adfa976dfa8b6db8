"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A token of the word contracts: no space, tab, line break or form feed (fixed pattern).
WORD = r"[^\x20\x09-\x0D]+"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with the given ones that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def others(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` that an operator's own output columns do not replace."""
    own = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in own]


def words(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """crc32 of the id as text leaves ``part`` when divided by ``parts``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def exclusive_sums(df: DataFrame, group: list[str], bucket: list[str], order: list, sums: dict[str, str], totals: dict[str, str] | None = None) -> DataFrame:
    """Running totals over each group in the order of (bucket, order), the row itself left out.

    Each bucket is summed on the map side, the bucket totals give every bucket its
    offset, and only the order inside a bucket needs one task. ``sums`` names, for each
    new column, the column to add up. ``totals`` does so for sums over the whole group.
    ``group`` and ``bucket`` must not hold nulls.
    """
    keys = [*group, *bucket]
    sizes = {new: f"{new}__of" for new in {*sums, *(totals or {})}}
    of = df.groupBy(*keys).agg(*(F.sum(c).alias(sizes[new]) for new, c in {**sums, **(totals or {})}.items()))
    upto = Window.partitionBy(*group).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    zero = F.lit(0).cast("long")
    of = of.select(
        *keys,
        *(F.coalesce(F.sum(sizes[new]).over(upto), zero).alias(f"{new}__to") for new in sums),
        *(F.sum(sizes[new]).over(whole).alias(new) for new in totals or {}),
    )
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({new: F.coalesce(F.sum(c).over(within), zero) for new, c in sums.items()}).join(of, keys)
    return df.withColumns({new: F.col(new) + F.col(f"{new}__to") for new in sums}).drop(*(f"{new}__to" for new in sums))


#: Parts into which rows that share one order value are split.
TIE_PARTS = 64


def with_buckets(rows: DataFrame, order_by: str, tie: str, part: str, sub: str, parts: int) -> DataFrame:
    """Adds the bucket (part, sub) of each row in the order of a number or date, nulls first.

    Quantiles cut the order into about ``parts``; at most that many values come to the driver.
    Rows whose value is a cut come first in their part, in sub-buckets of their own by the hash column
    ``tie``, so no value fills one bucket.
    """
    cuts = rows.agg(F.percentile_approx(order_by, [i / parts for i in range(1, parts)], 20 * parts).alias("c")).first()["c"]
    cuts = sorted({c for c in cuts or [] if c is not None})
    value = F.col(order_by)
    place, on_cut = F.lit(0), F.lit(False)
    if cuts:
        # the number of cuts up to the value, by halving steps
        steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
        bounds = F.lit(cuts)
        reached = lambda i: F.coalesce((i <= len(cuts)) & (F.get(bounds, i - 1) <= value), F.lit(False))
        place = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(reached(at + step), at + step).otherwise(at))
        on_cut = F.coalesce(F.get(bounds, F.col(part) - 1) == value, F.lit(False))
    rows = rows.withColumn(part, F.when(value.isNull(), -1).otherwise(place))
    spread = F.pmod(F.col(tie), F.lit(TIE_PARTS)).cast("int")
    return rows.withColumn(sub, F.when((F.col(part) < 0) | on_cut, spread).otherwise(TIE_PARTS))
