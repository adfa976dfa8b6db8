"""Evaluation periods and hold-out labels."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import differs, not_in_keep_null
from .lookup import flag_member, last_value_per_key
from .stats import bounds


@dataclass(frozen=True)
class Period:
    start: dt.datetime
    end: dt.datetime


def as_instant(value) -> dt.datetime:
    if isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return dt.datetime(value.year, value.month, value.day)


def resolve_period(df: DataFrame, date: str, start, end) -> Period:
    """Keep the asked period where the data covers it.

    A start outside the data becomes 1 January of the year before the last
    one; an end outside it becomes the last date.
    """
    # as text, so that the session's time zone plays no part
    first, last = bounds(df.select(F.col(date).cast("string").alias(date)), date)
    start, end = as_instant(start), as_instant(end)
    if first is None:
        return Period(start, end)
    first, last = as_instant(first), as_instant(last)
    if not first <= start <= last:
        start = dt.datetime(last.year - 1, 1, 1)
        warnings.warn(f"evaluation start is out of range, using {start}", stacklevel=2)
    if not first <= end <= last:
        end = last
        warnings.warn(f"evaluation end is out of range, using {end}", stacklevel=2)
    return Period(start, end)


def split_by_period(
    df: DataFrame, date: str, start, end, after_end: str = "drop"
) -> tuple[DataFrame, DataFrame, Period]:
    """(train, evaluation, period): train is before the period's start.

    Rows after its end are dropped, or join the training rows with
    ``after_end="train"``. Undated rows belong to neither.
    """
    if after_end not in ("drop", "train"):
        raise ValueError("after_end must be 'drop' or 'train'")
    period = resolve_period(df, date, start, end)
    kind = df.schema[date].dataType
    d = F.col(date)
    a, b = (F.lit(v.isoformat(" ")).cast(kind) for v in (period.start, period.end))
    evaluation = df.where(d.between(a, b))
    train = df.where(d < a)
    if after_end == "train":
        train = train.unionByName(df.where((d > b) & (d >= a)))
    return train, evaluation, period


def holdout_labels(
    df: DataFrame,
    evaluation: DataFrame,
    key: str,
    kind: str,
    order: Sequence[str],
    label: str = "label",
    next_kind: str = "repeat_phase_property_type",
    exclude: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Test sets from an evaluation slice.

    The first keeps each customer's latest purchase (label not 1) and labels
    it 1 when the customer buys again in the slice. The second keeps those
    buyers with the kind of their last purchase in the slice, leaving out
    ``exclude`` but not a null kind.
    """
    latest = df.where(differs(F.col(label), 1)).drop(label)
    repeat = flag_member(latest, evaluation, key, label)
    kinds = last_value_per_key(evaluation, key, kind, order, next_kind)
    buyers = repeat.where(F.col(label) == 1).drop(label, next_kind)
    typed = buyers.join(kinds, key, "left").where(not_in_keep_null(F.col(next_kind), exclude))
    return repeat, typed
