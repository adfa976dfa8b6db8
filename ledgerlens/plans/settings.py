"""Parameters of the property-sales preparation and models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# The column names, sentinels and constants of the input data.
DATE_COLUMNS = [
    "transaction_date", "commencement_date", "completion_date", "spa_stamp_date",
    "sales_conversion_date", "spa_date", "contact_reg_date", "buyer_dob",
]
PRICE_COLUMNS = [
    "non_land_posted_list_price", "non_land_posted_selling_price",
    "non_land_posted_net_selling_price", "non_land_posted_total_rebate",
    "non_land_posted_total_loan_amount", "non_land_posted_spa_amount",
    "non_land_posted_sales_amount",
]
FILTER_COLUMNS = ["project_country", "last_sales_status", "date_type"]
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
PROPERTY_TYPES = {"landed": "Landed", "high_rise": "High Rise", "commercial": "Commercial"}
EXCLUDED_TYPES = ["RSKU", "Industrial"]
DROPPED_SALES = [318456, 216039]
MODEL_NAMES = [
    "logistic_regression", "knn", "svm", "decision_tree", "random_forest",
    "gradient_boosting", "mlp",
]


@dataclass(frozen=True)
class Lookups:
    """Lookup tables the user supplies.

    ``mappings`` holds, per name, a table whose second column is the clean key
    and whose fourth is the target.
    """

    id_type: DataFrame
    nationality: DataFrame
    city: DataFrame
    area_range: DataFrame
    mappings: dict[str, DataFrame] = field(default_factory=dict)


@dataclass(frozen=True)
class Preparation:
    key: str = "contact_nric_masked"
    columns: Sequence[str] = ()
    country: str = "Malaysia"
    sale_status: str = "Sold"
    attribute_view: str = "spa_date_type"
    price_view: str = "spa_month_type"
    date_format: str | None = None
    thin_days: int = 30
    evaluation: tuple[str, str] | None = None
    after_end: str = "drop"
    with_label: bool = True
    dropped_sales: Sequence[int] = tuple(DROPPED_SALES)
    save_dir: str | None = None
    resume: bool = False  # use the finished tables in save_dir if there are any


@dataclass(frozen=True)
class PurchaseModel:
    """Repeat-purchase ensemble settings."""

    model: str = "random_forest"
    columns: Sequence[str] = ()
    splits: int = 3
    pivot_year: int = 2015
    down_sampling: bool = True
    ratio: int = 1
    clamp: bool = False
    validation: float = 0.2
    threshold: float = 0.6
    params: Mapping = field(default_factory=dict)
    hash_width: int | None = None  # slots of a column of very many categories; None refuses it

    def __post_init__(self):
        check_model(self.model, self.validation)
        if not 1 <= self.splits <= 5:
            raise ValueError("splits must be between 1 and 5")
        if not 1 <= self.ratio <= 5:
            raise ValueError("ratio must be between 1 and 5")
        if not 0 <= self.threshold <= 1:
            raise ValueError("threshold must be between 0 and 1")


@dataclass(frozen=True)
class TypeModel:
    """Property-type one-vs-rest settings."""

    model: str = "random_forest"
    columns: Sequence[str] = ()
    validation: float = 0.2
    threshold: float = 0.5
    types: Sequence[str] = tuple(PROPERTY_TYPES)
    params: Mapping = field(default_factory=dict)
    hash_width: int | None = None

    def __post_init__(self):
        check_model(self.model, self.validation)
        unknown = [t for t in self.types if t not in PROPERTY_TYPES]
        if unknown:
            raise ValueError(f"unknown property types {unknown}")


def check_model(name: str, validation: float) -> None:
    if name not in MODEL_NAMES:
        raise ValueError(f"model {name!r} is not one of {MODEL_NAMES}")
    if not 0 <= validation <= 0.5:
        raise ValueError("validation must be between 0 and 0.5")
