"""Reading raw sales, lookup tables, column lists and stage tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import is_in, plain_number
from ..plans.settings import NA_TOKENS, Lookups
from ..session import path_exists

SALES_ID = T.StructField("sales_id", T.LongType())
OVERRIDE_VALUES = {
    "id_type": "derived_id_type", "nationality": "derived_nationality", "city": "derived_contact_city",
}
RANGE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("project_name", "phase", "build_type")]
    + [
        T.StructField(c, T.DoubleType())
        for c in (
            "min_area_transformed_to_sqft", "max_area_transformed_to_sqft", "mean_sqft",
            "min_area_transformed_to_sqm", "max_area_transformed_to_sqm",
        )
    ]
)


def normalise_na(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Missing-value tokens in text become null, NaN in doubles becomes null."""
    fixed = {}
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "string":
            fixed[name] = F.when(is_in(c, tokens), None).otherwise(c)
        elif kind in ("double", "float"):
            fixed[name] = plain_number(c)
    return df.withColumns(fixed)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, na_tokens: Sequence[str] = NA_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header and a declared schema; columns are matched by name.

    Every column is read as text and cast after the missing-value tokens are
    taken out, so a token in a numeric column is a null, not a bad row. A whole
    number may be written with a fraction of zero (``2.0``). Text that is no
    value of its column's type is a null too: ``cast_failures`` lists it.

    Quoted fields may hold line breaks. A file is then read by one task; without
    such fields, ``multi_line=False`` lets Spark split large files. A record
    with more or fewer fields than the header ends the job.
    """
    text = normalise_na(_read_text(spark, path, schema, multi_line), na_tokens)
    return text.select([_typed(f).alias(f.name) for f in _schema(schema)])


def cast_failures(
    spark: SparkSession, path: str, schema: T.StructType | str, na_tokens: Sequence[str] = NA_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """``(column, value, n)``: texts that ``read_csv`` turns into nulls although they are no token."""
    text = normalise_na(_read_text(spark, path, schema, multi_line), na_tokens)
    cells = F.array(
        *[
            F.when(
                F.col(f"`{f.name}`").isNotNull() & _typed(f).isNull(),
                F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("value")),
            )
            for f in _schema(schema)
        ]
    )
    cell = text.select(F.explode(F.array_compact(cells)).alias("c"))
    return cell.groupBy("c.column", "c.value").agg(F.count(F.lit(1)).alias("n"))


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _typed(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return c
    if isinstance(field.dataType, T.IntegralType):
        c = F.regexp_replace(c, r"^(\s*[+-]?\d+)\.0*\s*$", "$1")
    return c.try_cast(field.dataType)


def _read_text(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool) -> DataFrame:
    """Every column of the file as text; a record of another number of fields is an error."""
    _must_exist(spark, path)
    # with only the asked columns parsed, surplus fields would not be seen
    reader = (
        spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
        .option("columnPruning", False)
    )
    names = reader.csv(path).columns
    missing = [f.name for f in _schema(schema) if f.name not in names]
    if missing:
        raise ValueError(f"missing columns in {path}: {missing}")
    bad = "_bad_record"
    fields = [T.StructField(c, T.StringType()) for c in [*names, bad]]
    text = reader.option("columnNameOfCorruptRecord", bad).schema(T.StructType(fields)).csv(path)
    message = F.concat(F.lit(f"bad record in {path}: "), F.col(bad))
    # Spark refuses to read the bad records alone, as a count would: the first column goes along
    good = F.coalesce(F.length(F.col(f"`{names[0]}`")) >= 0, F.lit(True))
    return text.where(F.when(F.col(bad).isNull(), good).otherwise(F.raise_error(message).cast("boolean"))).drop(bad)


def read_sales(
    spark: SparkSession, path: str, key: str, schema: T.StructType | str | None = None, fmt: str = "csv",
    multi_line: bool = True,
) -> DataFrame:
    """Raw sales with the customer key as text, from CSV or parquet; ``multi_line`` as in ``read_csv``."""
    _must_exist(spark, path)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV needs a declared schema")
        df = read_csv(spark, path, schema, multi_line=multi_line)
    else:
        reader = spark.read.format(fmt)
        df = normalise_na((reader.schema(schema) if schema is not None else reader).load(path))
    if "buyer_dob" not in df.columns:
        raise ValueError("buyer_dob is not in the input")
    return df.withColumn(key, F.col(key).cast("string"))


def read_column_list(spark: SparkSession, path: str) -> list[str]:
    """Names in the one-column file ``column_name``."""
    return [r["column_name"] for r in read_csv(spark, path, "column_name string").collect()]


def read_override(spark: SparkSession, path: str, value: str) -> DataFrame:
    return read_csv(spark, path, T.StructType([SALES_ID, T.StructField(value, T.StringType())]))


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RANGE_SCHEMA)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A mapping table by position: raw text, clean key, count, target."""
    _must_exist(spark, path)
    names = spark.read.option("header", True).csv(path).columns
    if len(names) < 4:
        raise ValueError(f"{path} needs the columns raw, clean, count and target")
    kinds = [T.StringType()] * len(names)
    kinds[2] = T.DoubleType()
    return read_csv(spark, path, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))


def read_lookups(
    spark: SparkSession, overrides: dict[str, str], ranges: str, mappings: dict[str, str]
) -> Lookups:
    """All lookup tables from their paths."""
    tables = {n: read_override(spark, overrides[n], v) for n, v in OVERRIDE_VALUES.items()}
    return Lookups(
        **tables,
        area_range=read_ranges(spark, ranges),
        mappings={n: read_mapping(spark, p) for n, p in mappings.items()},
    )


def read_or_compute(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame], resume: bool = True
) -> DataFrame:
    """A finished stage table if there is one, else compute and write it."""
    if resume and path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        return spark.read.parquet(path)
    compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _must_exist(spark: SparkSession, path: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
