"""From raw sales rows to one thinned row per sale, and next-purchase labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import coerce_timestamp, plain_number
from ..operators.periods import Period, split_by_period
from ..operators.quality import observe_count, removed_rows, require_columns
from ..operators.sequence import HOT_ROWS, next_event, thin_recent
from ..session import stage
from .settings import DATE_COLUMNS, FILTER_COLUMNS, PRICE_COLUMNS, Preparation

# Fixed values for a customer's last purchase.
NO_NEXT = "NOT APPLICABLE"
NO_NEXT_DATE = "2022-12-31"


def coerce_dates(df: DataFrame, columns: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Text columns to timestamps, unreadable values to null; others stay as they are."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: coerce_timestamp(F.col(c), fmt) for c in columns if types[c] == "string"}
    )


def equal_to(conditions: Mapping[str, object]) -> Column:
    out = F.lit(True)
    for c, v in conditions.items():
        out = out & (F.col(c) == v)
    return out


def join_views(
    df: DataFrame,
    on: str,
    left: Mapping[str, object],
    left_columns: Sequence[str],
    right: Mapping[str, object],
    right_columns: Sequence[str],
) -> DataFrame:
    """Join two filtered, projected views of one table on an id.

    Both filters and both column lists reach the scans.
    """
    a = df.where(equal_to(left)).select(list(dict.fromkeys([on, *left_columns])))
    b = df.where(equal_to(right)).select(list(dict.fromkeys([on, *right_columns])))
    return a.join(b, on, "inner")


@dataclass(frozen=True)
class Extraction:
    sales: DataFrame
    report: DataFrame
    evaluation: DataFrame | None = None
    period: Period | None = None


def extract(df: DataFrame, settings: Preparation, hot_rows: int = HOT_ROWS) -> Extraction:
    """Filtered, joined and thinned sales, cut at the evaluation period if there is one."""
    require_columns(df, DATE_COLUMNS, "for date conversion")
    require_columns(df, FILTER_COLUMNS, "for filtering")
    columns = list(dict.fromkeys([*settings.columns, settings.key]))
    require_columns(df, columns, "for extraction")
    require_columns(df, ["sales_id", *PRICE_COLUMNS], "for extraction")

    df = coerce_dates(df, DATE_COLUMNS, settings.date_format)
    df = df.withColumn(settings.key, F.col(settings.key).cast("string"))
    df = df.withColumns({c: plain_number(F.col(c)) for c in PRICE_COLUMNS})
    sold = {"project_country": settings.country, "last_sales_status": settings.sale_status}
    # thinning reads it more than once: the raw table is read once for each view
    joined, known = observe_count(join_views(
        df,
        "sales_id",
        {**sold, "date_type": settings.attribute_view},
        columns,
        {**sold, "date_type": settings.price_view},
        PRICE_COLUMNS,
    ), F.col(settings.key).isNotNull())
    joined = stage(joined, "joined")
    # read by the statistics and the search for date bounds; both writes count what the report says
    thinned, left = observe_count(thin_recent(joined, settings.key, "spa_date", "sales_id", settings.thin_days, hot_rows))
    sales = stage(thinned, "thinned")
    report = removed_rows(df.sparkSession, known() - left(), "extraction", "recent purchases removed")
    if settings.evaluation is None:
        return Extraction(sales, report)
    train, evaluation, period = split_by_period(
        sales, "spa_date", *settings.evaluation, settings.after_end
    )
    return Extraction(train, report, evaluation, period)


def label_next_purchase(
    df: DataFrame,
    key: str,
    date: str = "spa_date",
    row_id: str = "sales_id",
    kind: str = "phase_property_type",
    price: str = "non_land_posted_selling_price",
    stamp: str = "spa_stamp_date",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Label each purchase with the customer's next one.

    ``label`` is 1 when there is a next purchase; a null in that purchase does
    not change it. The last purchase gets the fixed fillers.
    """
    take = {
        "repeat_sales_id": row_id,
        f"repeat_{kind}": kind,
        f"repeat_{price}": price,
        f"repeat_{stamp}": stamp,
        f"repeat_{date}": date,
    }
    out = next_event(df, key, date, row_id, take, hot_rows)
    has = F.col("has_next")
    end = F.lit(NO_NEXT_DATE).cast("date")
    return out.withColumns(
        {
            "label": has.cast("int"),
            "repeat_sales_id": F.when(has, F.col("repeat_sales_id").cast("string")).otherwise(NO_NEXT),
            f"repeat_{kind}": F.when(has, F.col(f"repeat_{kind}")).otherwise(NO_NEXT),
            f"repeat_{stamp}": F.when(has, F.to_date(f"repeat_{stamp}")).otherwise(end),
            f"repeat_{date}": F.when(has, F.to_date(f"repeat_{date}")).otherwise(end),
        }
    ).drop("has_next")
