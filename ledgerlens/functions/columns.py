"""Column expressions with the null rules the cleaning steps rely on.

Everything here is a native expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

INFINITY = float("inf")
# Unicode's white space, and the four separators U+001C to U+001F
WHITE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Remove whitespace of every kind at both ends (``trim`` knows only spaces).

    That is Unicode's white space and the four separators U+001C to U+001F.
    """
    return F.btrim(c, F.lit(WHITE))


def strip_upper(c: Column) -> Column:
    return F.upper(strip(c))


def is_in(c: Column, values: Iterable) -> Column:
    """Membership that is False, not null, for a null input."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def not_in_keep_null(c: Column, values: Iterable) -> Column:
    """Not-in filter that keeps nulls (SQL ``NOT IN`` would drop them)."""
    return ~is_in(c, values)


def differs(c: Column, value) -> Column:
    """``!=`` that is True for null."""
    return ~c.eqNullSafe(F.lit(value))


def is_sentinel(c: Column, values: Iterable[str]) -> Column:
    """Is the stripped, upper-cased text one of ``values``? False for null."""
    return is_in(strip_upper(c), values)


def first_valid(candidates: Sequence[tuple[Column, Iterable[str]]], fallback: Column) -> Column:
    """First candidate that is neither null nor one of its own sentinels."""
    out = None
    for value, invalid in candidates:
        ok = value.isNotNull() & ~is_sentinel(value, invalid)
        out = F.when(ok, value) if out is None else out.when(ok, value)
    return out.otherwise(fallback)


def parity_value(c: Column, odd: str, even: str) -> Column:
    """``odd``/``even`` by the last character when it is a digit, else null."""
    last = F.right(c.cast("string"), F.lit(1))
    digit = F.when(last.rlike("^[0-9]$"), last.cast("int"))
    return F.when(digit % 2 == 1, odd).when(digit % 2 == 0, even)


def safe_ratio(num: Column, den: Column) -> Column:
    """Division where 0/0 and null give null and x/0 gives a signed infinity."""
    infinite = F.when(num > 0, F.lit(INFINITY)).when(num < 0, F.lit(-INFINITY))
    return F.when(den == 0, infinite).otherwise(F.try_divide(num, den))


def ratio_band(c: Column, limit: float = 0.1) -> Column:
    """No rebate / below / at-or-above ``limit``; null when negative or null."""
    share = f"{limit * 100:g}%"
    return (
        F.when(c == 0, "NO REBATE")
        .when((c > 0) & (c < limit), f"< {share} REBATE")
        .when(c >= limit, f"> {share} REBATE")
    )


def within_tolerance(x: Column, low: Column, high: Column, tolerance: float = 0.2) -> Column:
    return (x >= low * (1 - tolerance)) & (x <= high * (1 + tolerance))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two instants, floored."""
    return F.timestamp_diff("DAY", earlier, later)


def coerce_timestamp(c: Column, fmt: str | None = None) -> Column:
    """Text to timestamp; what does not parse becomes null."""
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def plain_number(c: Column) -> Column:
    """NaN and null are one thing in the input; keep only null."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def range_label(low: float, high: float, suffix: str) -> str:
    """``a-b`` with both ends cut to whole numbers."""
    return f"{int(low)}-{int(high)}{suffix}"


def cut_right(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins with the lowest edge included; outside or null is null.

    A CASE chain keeps the test in generated code, unlike array functions.
    """
    if len(edges) < 2:
        return F.lit(None).cast("string")
    out = F.when(x < edges[0], F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        out = out.when(x <= edge, label)
    return out


def at_least(score: Column, threshold: float) -> Column:
    return (score >= threshold).cast("int")


def row_hash(ids: Sequence[str], seed: int) -> Column:
    """Hex hash of the identifying columns; the same in any engine with md5."""
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ids]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def hash_bucket(ids: Sequence[str], seed: int) -> Column:
    """First 16 bits of the row hash, 0..65535."""
    return F.conv(F.substring(row_hash(ids, seed), 1, 4), 16, 10).cast("int")
