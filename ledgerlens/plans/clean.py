"""Cleaning: derived columns by rule cascades, lookups and global statistics.

Every rule is a Column expression. A step adds its derived column and the row
is dropped if that is null; drops are one filter at the end. A statistic sees
only the rows the earlier steps kept, so it is taken from the frame filtered on
the columns derived so far; one narrow aggregate takes them all, and their values
enter the rules as literals. The input should be a staged table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import (
    differs, first_valid, is_in, is_sentinel, parity_value, plain_number, strip_upper,
    within_tolerance,
)
from ..operators.lookup import attach_override, attach_range
from ..operators.quality import drop_nulls, drop_report, observe_drops
from ..session import packed, stage
from .settings import Lookups

# Ids, sentinels and area constants of the cleaning rules.
COMPANY = "REG NO."
PERSON_IDS = ["NRIC NO.", "PASSPORT"]
NOT_APPLICABLE = "NOT APPLICABLE"
NO_GENDER = ["UNDEFINED", "NOT APPLICABLE", "OTHERS", "-"]
NO_MARITAL = ["UNDEFINED", "NOT APPLICABLE", "OTHER", "-"]
NO_SALUTATION = ["Not Applicable", "Undefined", "Others", "-"]
NO_NATION = ["UNDEFINED", "OTHERS"]
NO_CONTACT_NATION = ["UNDEFINED", "OTHERS", "-"]
NO_RACE = ["N/A", "OTHERS", "UNDEFINED"]
NO_INCOME = ["Not Applicable", "Undefined", "-"]
SQM_TO_SQFT = 10.7639
SQFT_TO_SQM = 0.092903
TOLERANCE = 0.2
MIN_SQFT = 250
MAX_SQM = 1000
MIN_LAND_SQFT = 1000
MIN_LAND_SQM = 1500
SMALLEST_SQFT = 200
#: How a rule gets a column of the input: by its name, or out of the struct that holds the row.
Read = Callable[[str], Column]
ID_TYPE = "derived_contact_identification_type"
FILLED_PRICES = [
    "non_land_posted_list_price", "non_land_posted_selling_price", "non_land_posted_total_loan_amount",
    "non_land_posted_spa_amount", "non_land_posted_sales_amount", "non_land_posted_total_rebate",
]
AGE = "customer_age"
AREAS = ["built_up_area_sqft", "built_up_area_sqm", "land_area_sqft", "land_area_sqm"]
LIMITS = {
    "_low": "min_area_transformed_to_sqft", "_high": "max_area_transformed_to_sqft",
    "_mean": "mean_sqft",
    "_low_sqm": "min_area_transformed_to_sqm", "_high_sqm": "max_area_transformed_to_sqm",
}
# in the order in which the rules take them
STATISTICS = ["customer_gender", "customer_marital_status", AGE, "contact_annual_income"]


def id_type_rule(value: Column, purchaser: Column, nationality: Column) -> Column:
    """Id type from the purchaser kind and nationality where missing or OTHERS."""
    value = strip_upper(value)
    local = F.coalesce(strip_upper(nationality) == "MALAYSIA", F.lit(False))
    guess = (
        F.when(purchaser == "Corporate", COMPANY)
        .when(purchaser.isin("Individual", "Undefined"), F.when(local, "NRIC NO.").otherwise("PASSPORT"))
        .otherwise(value)
    )
    out = F.when(value.isNull() | (value == "OTHERS"), guess).otherwise(value)
    return F.when(out == "REG NO", COMPANY).otherwise(out)


def person_cascade(id_type: Column, person: Column, fallback: Column) -> Column:
    """Companies are not applicable, persons follow ``person``, others the fallback."""
    return (
        F.when(id_type == COMPANY, NOT_APPLICABLE)
        .when(id_type.isin(PERSON_IDS), person)
        .otherwise(fallback)
    )


def gender_rule(id_type, customer, contact, nric, mode) -> Column:
    by_digit = F.coalesce(parity_value(nric, "MALE", "FEMALE"), F.upper(mode))
    person = first_valid([(F.upper(customer), NO_GENDER), (F.upper(contact), NO_GENDER)], by_digit)
    return person_cascade(id_type, person, F.upper(mode))


def marital_rule(id_type, customer, contact, mode) -> Column:
    person = first_valid(
        [(F.upper(customer), NO_MARITAL), (F.upper(contact), NO_MARITAL)], F.upper(mode)
    )
    return person_cascade(id_type, person, F.upper(mode))


def salutation_rule(id_type, salutation, gender) -> Column:
    vague = salutation.isNull() | is_in(salutation, NO_SALUTATION)
    title = F.when(gender == "MALE", "MR").when(gender == "FEMALE", "MS")
    stated = F.upper(F.coalesce(salutation, F.lit("nan")))
    return F.when(id_type == COMPANY, NOT_APPLICABLE).otherwise(
        F.coalesce(F.when(vague & id_type.isin(PERSON_IDS), title), stated)
    )


def purchaser_rule(id_type) -> Column:
    return F.when(id_type.isin(PERSON_IDS), "INDIVIDUAL").when(id_type == COMPANY, "CORPORATE")


def nationality_rule(customer, contact) -> Column:
    usable = contact.isNotNull() & ~is_sentinel(contact, NO_CONTACT_NATION)
    return F.when(is_sentinel(customer, NO_NATION) & usable, contact).otherwise(customer)


def age_rule(id_type, event_date, birth_date, stated, mean) -> Column:
    """-1 for companies; else by birth year, stated age or the mean.

    A known birth date decides even when the event date is missing (null).
    """
    by_birth = (F.year(event_date) - F.year(birth_date)).cast("double")
    age = F.when(birth_date.isNotNull(), by_birth).otherwise(
        F.coalesce(plain_number(stated), mean)
    )
    return F.when(id_type == COMPANY, F.lit(-1.0)).otherwise(F.when(age <= 0, mean).otherwise(age))


def cash_rule(cash, financier) -> Column:
    unfunded_loan = financier.isNull() & is_sentinel(cash, ["LOAN"])
    return F.when(unfunded_loan, "CASH").otherwise(F.upper(cash))


def financier_rule(cash, financier) -> Column:
    return F.when(cash == "CASH", "CASH").otherwise(
        F.coalesce(F.upper(financier), F.lit(NOT_APPLICABLE))
    )


def race_rule(id_type, customer, contact, group) -> Column:
    """Customer, then contact, then group race; a null contact ends the search."""
    contact_vague = is_sentinel(contact, NO_RACE)
    race = (
        F.when(~is_sentinel(customer, NO_RACE), customer)
        .when(~contact_vague, contact)
        .when(~is_sentinel(group, NO_RACE), group)
    )
    return F.when(id_type == COMPANY, NOT_APPLICABLE).otherwise(
        F.coalesce(F.upper(race), F.lit("OTHERS"))
    )


def status_rule(id_type, value, vague: str, instead: str, fill_null: bool) -> Column:
    out = F.when(value == vague, instead).otherwise(value)
    if fill_null:
        out = F.coalesce(out, F.lit(instead))
    return F.when(id_type == COMPANY, NOT_APPLICABLE).otherwise(F.upper(out))


def income_rule(income, mode) -> Column:
    return F.upper(F.when(income.isNull() | is_in(income, NO_INCOME), mode).otherwise(income))


def ranged_area(sqft, sqm, low, high, mean, low_sqm, high_sqm) -> Column:
    """Area of a row whose project, phase and build type have a known range."""
    by_sqft = F.when(within_tolerance(sqft, low, high, TOLERANCE), sqft).otherwise(sqft * SQFT_TO_SQM)
    by_sqm = F.when(within_tolerance(sqm, low_sqm, high_sqm, TOLERANCE), sqm * SQM_TO_SQFT).otherwise(sqm)
    return F.when(sqft > 0, by_sqft).when(sqm > 0, by_sqm).when(mean > 0, mean)


def unranged_area(sqft, sqm, land_sqft, land_sqm, group_mean) -> Column:
    """Area of a row without a known range: group mean, own area, land area."""
    return (
        F.when(group_mean.isNotNull(), group_mean)
        .when(sqft >= MIN_SQFT, sqft)
        .when(sqm > 0, F.when(sqm <= MAX_SQM, sqm * SQM_TO_SQFT).otherwise(sqm))
        .when(land_sqft > 0, F.when(land_sqft >= MIN_LAND_SQFT, land_sqft).otherwise(land_sqft * SQM_TO_SQFT))
        .when(land_sqm > 0, F.when(land_sqm >= MIN_LAND_SQM, land_sqm).otherwise(land_sqm * SQFT_TO_SQM))
    )


def repair_area(area, group_mean) -> Column:
    """Replace a missing, zero or implausibly small area."""
    area = F.when(area.isNull() | (area == 0), F.coalesce(group_mean, area)).otherwise(area)
    small = (area > 0) & (area < SMALLEST_SQFT)
    return F.when(small, F.coalesce(group_mean, area * SQM_TO_SQFT)).otherwise(area)


def clean_area(
    df: DataFrame,
    ranges: DataFrame,
    out: str = "derived_built_up_area_sqft",
    keep: Callable[[DataFrame], DataFrame] = lambda d: d,
) -> DataFrame:
    """Range-checked area; ``keep`` filters the rows the group means are taken from.

    The group means are over rows with a known range only, per build type.
    """
    joined = _in_range(df.withColumn("_build", _build()), ranges)
    joined = joined.withColumn("_area", _ranged())
    means = (
        keep(joined)
        .where(F.col("_matched") & F.col("_build").isNotNull())
        .groupBy("_build")
        .agg(F.avg("_area").alias("_group"))
    )
    joined = joined.join(stage(means, "area-means"), "_build", "left")
    return joined.withColumn(out, _final_area()).drop(*LIMITS, "_build", "_matched", "_area", "_group")


def _in_range(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Join the limits of the row's project, phase and build type (``_build``)."""
    table = ranges.select(
        "project_name", "phase", _build().alias("_build"),
        *[plain_number(F.col(c)).alias(n) for n, c in LIMITS.items()],
    )
    return attach_range(df, table, ["project_name", "phase", "_build"], list(LIMITS))


def _build() -> Column:
    return strip_upper(F.col("build_type"))


def _areas(read: Read) -> list[Column]:
    return [plain_number(read(c)) for c in AREAS]


def _ranged(read: Read = F.col) -> Column:
    """The area of a row in a known range, else null."""
    return F.when(F.col("_matched"), ranged_area(*_areas(read)[:2], *map(F.col, LIMITS)))


def _final_area(read: Read = F.col) -> Column:
    group = F.col("_group")
    first = F.when(F.col("_matched"), F.col("_area")).otherwise(unranged_area(*_areas(read), group))
    return repair_area(first, group)


def upper_columns(read: Read = F.col) -> dict[str, Column]:
    """Texts that are only put into one case."""
    return {
        "derived_bumi_status": F.upper(read("customer_bumi_status")),
        "derived_contact_occupation": strip_upper(read("contact_occupation")),
        "derived_build_type": F.upper(read("build_type")),
        "derived_phase_property_type": F.upper(read("phase_property_type")),
    }


def filled_prices(read: Read = F.col) -> dict[str, Column]:
    """Prices with 0 for a missing one."""
    return {f"derived_{p}": F.coalesce(plain_number(read(p)), F.lit(0.0)) for p in FILLED_PRICES}


def _looked_up(df: DataFrame, lookups: Lookups) -> DataFrame:
    """Each row in one struct, with its overrides and area limits; what the joins pass on is narrow."""
    keys = {c: F.col(c) for c in ("sales_id", "project_name", "phase")}
    out = packed(df, {**keys, "_build": _build()})
    out = attach_override(out, lookups.id_type, "sales_id", "derived_id_type", "_own_id_type")
    out = attach_override(out, lookups.nationality, "sales_id", "derived_nationality", "_own_nationality")
    out = attach_override(out, lookups.city, "sales_id", "derived_contact_city", "_own_city")
    return _in_range(out, lookups.area_range)


def held(name: str) -> Column:
    """A column of the row's struct."""
    return F.col("_row")[name]


def _derive(
    df: DataFrame, known: Mapping[str, Column]
) -> tuple[DataFrame, list[str], dict[str, list[str]]]:
    """The rules up to the income, given the statistics, on held rows with their overrides.

    The columns come in three steps, each of what the one before has made, so that rows are not rebuilt for
    every rule. Returns the frame, the columns that must not be null, and for each statistic
    those that were there when it is taken.
    """
    c, upper = held, upper_columns(held)
    done: list[str] = []
    before: dict[str, list[str]] = {}
    steps: list[dict[str, Column]] = [{}, {}, {}]

    def add(columns: Mapping[str, Column], step: int = 1) -> None:
        steps[step].update(columns)
        done.extend(columns)

    def statistic(name: str) -> Column:
        before[name] = list(done)
        return known[name]

    # id type, with its override
    stated = c("contact_identification_type")
    stated = F.when(stated == "Undefined", F.col("_own_id_type")).otherwise(stated)
    add({ID_TYPE: id_type_rule(stated, c("contact_purchaser_type"), c("customer_nationality"))}, 0)
    add({"derived_bumi_status": upper["derived_bumi_status"]})
    id_type = F.col(ID_TYPE)

    add({"derived_gender": gender_rule(
        id_type, c("customer_gender"), c("contact_gender"), c("contact_nric"), statistic("customer_gender"))})
    add({"derived_marital_status": marital_rule(
        id_type, c("customer_marital_status"), c("contact_marital_status"), statistic("customer_marital_status"))})
    add({"derived_contact_salutation": salutation_rule(
        id_type, c("contact_salutation"), F.col("derived_gender"))}, 2)
    add({"derived_contact_purchaser_type": purchaser_rule(id_type)})

    steps[0]["_nation"] = nationality_rule(c("customer_nationality"), c("contact_nationality"))
    nation = F.col("_nation")
    own = F.when(is_sentinel(nation, NO_NATION), F.col("_own_nationality")).otherwise(nation)
    add({"derived_nationality": F.coalesce(own, F.lit("OTHERS"))})

    add({"derived_age": age_rule(
        id_type, c("spa_date"), c("buyer_dob"), c("customer_age"), statistic("customer_age"))})
    add({"derived_contact_occupation": upper["derived_contact_occupation"]})
    add({"derived_is_cash_buyer": cash_rule(c("is_cash_buyer"), c("financier1_name"))})
    add({"derived_race": race_rule(
        id_type, c("customer_race"), c("contact_race"), c("customer_race_group"))})

    add({"derived_contact_city": strip_upper(F.coalesce(F.col("_own_city"), c("contact_city")))})
    add({"derived_contact_staff": status_rule(
        id_type, c("contact_staff"), "Undefined", "Not Staff", fill_null=False)})
    lifestyle = "contact_lifestyle_registration_status"
    add({f"derived_{lifestyle}": status_rule(
        id_type, c(lifestyle), "Undefined", "Non-Registered", fill_null=True)})
    add({"derived_contact_annual_income": income_rule(
        c("contact_annual_income"), statistic("contact_annual_income"))})
    for columns in steps:
        df = df.withColumns(columns)
    return df, done, before


def _measured(
    df: DataFrame, before: Mapping[str, list[str]], names: list[str], done: list[str]
) -> tuple[dict[str, object], DataFrame]:
    """Modes, and the mean age of persons, each over the rows without a null so far; and the mean area per build type
    over those with a known range and no null in ``done``. In one pass."""

    def there(columns: Sequence[str]) -> Column:
        here = F.lit(True)
        for x in columns:
            here = here & F.col(x).isNotNull()
        return here

    def cell(name: str, here: Column, value: Column, number: Column) -> Column:
        return F.when(here, F.struct(F.lit(name).alias("name"), value.alias("value"), number.alias("number")))

    cells = []
    for name in names:
        if name == AGE:
            age, person = plain_number(held(name)), differs(F.col(ID_TYPE), COMPANY)
            cells.append(cell(name, there(before[name]) & person & age.isNotNull(), F.lit(None).cast("string"), age))
        else:
            value = held(name).cast("string")
            cells.append(cell(name, there(before[name]) & value.isNotNull(), value, F.lit(None).cast("double")))
    area = _ranged(held)
    cells.append(cell("_area", there([*done, "_build"]) & area.isNotNull(), F.col("_build"), area))
    cell_rows = df.select(F.explode(F.array_compact(F.array(*cells))).alias("c")).select("c.*")
    counts = cell_rows.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("number").alias("total"))
    counts = stage(counts, "statistics")
    # the most frequent value, the smallest one on ties
    first = F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")
    mean = (F.sum("total") / F.sum("n")).alias("mean")
    rows = counts.where(F.col("name") != "_area").groupBy("name").agg(first, mean).collect()
    found = {r["name"]: r["mean"] if r["name"] == AGE else r["mode"] for r in rows}
    means = counts.where("name = '_area'").select(F.col("value").alias("_build"), (F.col("total") / F.col("n")).alias("_group"))
    return {name: found.get(name) for name in names}, means


def _statistics(df: DataFrame) -> tuple[dict[str, Column], DataFrame]:
    """The statistics as literals, and the mean areas.

    A rule is null or not whatever the statistics before it are, as long as they
    are not null; so stand-ins serve to tell which rows are left, and one pass
    takes all. Should one be null, the rest is taken in turn.
    """
    literal = {n: F.lit(1.0) if n == AGE else F.lit("?") for n in STATISTICS}
    left, settled = list(STATISTICS), False
    while not settled:
        frame, done, before = _derive(df, literal)
        found, means = _measured(frame, before, left, done)
        settled = True
        while left and settled:
            name = left.pop(0)
            literal[name] = F.lit(found[name]).cast("double" if name == AGE else "string")
            settled = found[name] is not None
    return literal, means


def _cleaned(df: DataFrame, lookups: Lookups) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """All held rows with their derived columns, the columns that must not be null, in the fixed order of the rules, and
    what makes plain rows of those that are left, with the prices."""
    keys = ["project_name", "phase", "sales_id"]
    columns = [*keys, *(c for c in df.columns if c not in keys)]
    rows = _looked_up(df, lookups)
    literal, means = _statistics(rows)
    rows, done, _ = _derive(rows.join(means, "_build", "left"), literal)
    upper, area = upper_columns(held), "derived_built_up_area_sqft"
    late = {
        "derived_build_type": upper["derived_build_type"],
        "derived_phase_property_type": upper["derived_phase_property_type"],
        "derived_financier_name": financier_rule(F.col("derived_is_cash_buyer"), held("financier1_name")),
    }
    rows = rows.withColumn("_area", _ranged(held)).withColumns({area: _final_area(held), **late})
    done = [*done, area, *late]

    def plain(left: DataFrame) -> DataFrame:
        there = [F.col(c) if c in done else held(c).alias(c) for c in columns]
        return left.select(*there, *[c for c in done if c not in columns]).withColumns(filled_prices())

    return rows, done, plain


def clean(df: DataFrame, lookups: Lookups) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, report of dropped rows); the report is a pass of its own."""
    rows, done, plain = _cleaned(df, lookups)
    return plain(drop_nulls(rows, done)), drop_report(rows, done, "clean")


def clean_observed(df: DataFrame, lookups: Lookups) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """(cleaned rows, their report); it can be read once the rows have been written, and costs no pass."""
    rows, done, plain = _cleaned(df, lookups)
    kept, report = observe_drops(rows, done, "clean")
    return plain(kept), report
