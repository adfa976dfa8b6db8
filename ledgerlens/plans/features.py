"""Features, groups and bins on cleaned rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import not_in_keep_null, ratio_band, safe_ratio, strip_upper
from ..operators.lookup import UNMAPPED, attach_group, mapping_table, require_unique_keys
from ..operators.quantiles import Cut, bin_columns
from ..session import packed, stage, unpacked
from .clean import COMPANY, ID_TYPE, NOT_APPLICABLE
from .settings import DROPPED_SALES

# Years to completion by property type, and the age bands.
YEARS_TO_COMPLETE = {
    "LANDED": 3, "RSKU": 3, "HIGH RISE": 4, "COMMERCIAL": 2, "INDUSTRIAL": 2,
}
NEW_BELOW, DEVELOPING_TO = 5, 10
# The groups whose first date counts.
AGED = ["phase", "project_name"]

# Column, mapping table, output, is the table's key normalised.
GROUPS = [
    ("derived_contact_salutation", "salutation", "group_derived_contact_salutation", True),
    ("derived_nationality", "nationality", "group_derived_nationality", False),
    ("derived_contact_occupation", "occupation", "derived_occupation_status", False),
    ("derived_financier_name", "financier", "group_derived_financier_name", False),
    ("derived_race", "race", "group_derived_race", False),
    ("derived_contact_city", "city", "group_derived_contact_city", False),
    ("derived_contact_annual_income", "annual_income", "group_derived_contact_annual_income", False),
]

# The binned columns.
PRICE_BINS = [
    "derived_non_land_posted_list_price", "derived_non_land_posted_selling_price",
    "derived_non_land_posted_total_rebate", "derived_non_land_posted_total_loan_amount",
    "derived_non_land_posted_spa_amount",
]
CUTS = {
    "derived_built_up_area_sqft": Cut(20, "midpoint", " SQFT"),
    "derived_age": Cut(5, suffix=" AGE-GROUP", missing=NOT_APPLICABLE),
    **{c: Cut(5, numbered=True) for c in PRICE_BINS},
}
CATEGORY_NAMES = {"derived_age": "derived_age_equal_category"}


def maturity(years: Column) -> Column:
    return (
        F.when(years < NEW_BELOW, "NEW")
        .when(years.between(NEW_BELOW, DEVELOPING_TO), "DEVELOPING")
        .otherwise("MATURED")
    )


def completion(kind: Column, years: Column) -> Column:
    """In progress below the type's number of years; unknown age counts as completed."""
    out = None
    for name, limit in YEARS_TO_COMPLETE.items():
        state = F.when(years < limit, "IN PROGRESS").otherwise("COMPLETED")
        out = F.when(kind == name, state) if out is None else out.when(kind == name, state)
    return out.otherwise("UNKNOWN")


def years_since_first(
    df: DataFrame, group: str, date: str, out: str, source: DataFrame | None = None
) -> DataFrame:
    """Years between a row's date and the first date of its group."""
    return (
        attach_group(df, group, {"_first": F.min(date)}, source)
        .withColumn(out, F.year(date) - F.year("_first"))
        .drop("_first")
    )


def add_features(df: DataFrame) -> DataFrame:
    rows = _firsts(packed(df, {c: F.col(c) for c in AGED}), df)
    return _featured(rows, df.columns)


def _firsts(rows: DataFrame, source: DataFrame) -> DataFrame:
    """Packed rows with the first date of their phase and their project."""
    for group in AGED:
        rows = attach_group(rows, group, {f"_{group}_first": F.min("spa_date")}, source)
    return rows


def _featured(rows: DataFrame, columns: Sequence[str], *more: Column) -> DataFrame:
    """Plain rows with their features, and ``more``, of packed rows with first dates."""
    firsts = [f"_{group}_first" for group in AGED]

    def years(group: str) -> Column:
        return F.year("spa_date") - F.year(f"_{group}_first")

    order = [*AGED, *(c for c in columns if c not in AGED)]
    return unpacked(rows, order, *map(F.col, firsts), *more).withColumns(
        {
            "derived_rebate_percentage": safe_ratio(
                F.col("derived_non_land_posted_total_rebate"),
                F.col("derived_non_land_posted_selling_price"),
            ),
            "derived_township_maturity": maturity(years("project_name")),
            "derived_completion_status": completion(F.col("derived_phase_property_type"), years("phase")),
        }
    ).drop(*firsts)


def group_values(
    df: DataFrame, mappings: dict[str, DataFrame], features: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(grouped rows, report of values without a target).

    With ``features`` those of ``add_features`` are added too, so that rows are packed and unpacked once.
    """
    missing = [name for _, name, _, _ in GROUPS if name not in mappings]
    if missing:
        raise ValueError(f"missing mapping tables {missing}")
    require_unique_keys({n: (t, t.columns[1]) for n, t in mappings.items()})
    tables = []
    for column, name, _, normalise in GROUPS:
        table = mappings[name]
        key, value = table.columns[1], table.columns[3]
        tables.append(
            mapping_table(table, key, value, normalise).withColumn("_name", F.lit(name))
        )
    # one small staged table for all mappings
    staged = stage(reduce(DataFrame.unionByName, tables), "mappings")
    # the joins pass on a row as one value
    keys = {f"_{name}_key": strip_upper(F.col(column)) for column, name, _, _ in GROUPS}
    rows = _firsts(packed(df, {**keys, **{c: F.col(c) for c in AGED}}), df) if features else packed(df, keys)
    for _, name, _, _ in GROUPS:
        table = staged.where(F.col("_name") == name)
        table = table.select(F.col("_key").alias(f"_{name}_key"), F.col("_value").alias(f"_{name}"))
        rows = rows.join(table, f"_{name}_key", "left")
    mapped = {target: F.coalesce(f"_{name}", F.lit(UNMAPPED)) for _, name, target, _ in GROUPS}
    names = [f"_{name}" for _, name, _, _ in GROUPS]
    out = (_featured if features else unpacked)(rows, df.columns, *map(F.col, names))
    out = out.withColumns(mapped).drop(*names)
    report = _unmapped(df, staged)
    income = "group_derived_contact_annual_income"
    company = F.col(ID_TYPE) == COMPANY
    return out.withColumn(income, F.when(company, NOT_APPLICABLE).otherwise(F.col(income))), report


def _unmapped(df: DataFrame, tables: DataFrame) -> DataFrame:
    """Report of the values of all grouped columns that have no target, from one pass."""
    cells = F.array(*[
        F.struct(F.lit(column).alias("column"), F.lit(name).alias("name"), strip_upper(F.col(column)).alias("value"))
        for column, name, _, _ in GROUPS
    ])
    seen = df.select(F.explode(cells).alias("c")).select("c.*")
    seen = seen.groupBy("column", "name", "value").agg(F.count(F.lit(1)).alias("n"))
    known = tables.where(F.col("_value").isNotNull()).select(F.col("_name").alias("name"), F.col("_key").alias("value"))
    # a null value matches no key
    return seen.join(known, ["name", "value"], "left_anti").select(
        F.lit("group").alias("stage"), "column", F.lit("no mapping target").alias("issue"), "value", "n"
    )


def bin_values(df: DataFrame, dropped_sales: Sequence[int] = DROPPED_SALES) -> DataFrame:
    """Quantile categories of area, age and prices, and the rebate band."""
    df = df.where(not_in_keep_null(F.col("sales_id"), dropped_sales))
    df = bin_columns(df, CUTS, names=CATEGORY_NAMES)
    return df.withColumn(
        "derived_rebate_percentage_category", ratio_band(F.col("derived_rebate_percentage"))
    )
