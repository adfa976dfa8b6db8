"""Column checks and the data-quality report."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, functions as F

REPORT_SCHEMA = "stage string, column string, issue string, value string, n long"


def require_columns(df: DataFrame, columns: Sequence[str], context: str = "") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {context}: {missing}")


def first_null(columns: Sequence[str]):
    """Name of the first of ``columns`` that is null in the row, else null."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def drop_report(df: DataFrame, columns: Sequence[str], stage_name: str) -> DataFrame:
    """Rows lost at each of a series of null drops, from one aggregate.

    A row counts at the first column that is null, as if the drops ran in turn.
    """
    return (
        df.select(first_null(columns).alias("column"))
        .where(F.col("column").isNotNull())
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.lit(stage_name).alias("stage"),
            "column",
            F.lit("null rows removed").alias("issue"),
            F.lit(None).cast("string").alias("value"),
            "n",
        )
    )


def unmapped_report(unmapped: DataFrame, column: str, stage_name: str) -> DataFrame:
    return unmapped.select(
        F.lit(stage_name).alias("stage"),
        F.lit(column).alias("column"),
        F.lit("no mapping target").alias("issue"),
        F.col("value"),
        "n",
    )


def removed_report(before: DataFrame, after: DataFrame, stage_name: str, issue: str) -> DataFrame:
    """How many rows a step took out, counted only when the report is read."""
    n = after.agg(F.count(F.lit(1)).alias("n")).scalar()
    return before.agg((F.count(F.lit(1)) - n).alias("n")).select(
        F.lit(stage_name).alias("stage"),
        F.lit(None).cast("string").alias("column"),
        F.lit(issue).alias("issue"),
        F.lit(None).cast("string").alias("value"),
        "n",
    )


def observe_drops(df: DataFrame, columns: Sequence[str], stage_name: str) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The rows without a null in ``columns``, and the report of those lost, like that of ``drop_report``.

    The counts are metrics of the write that follows, so the report costs no pass; read it after that write. They
    stand behind the last exchange of a plan that ends here, so its writing tasks count them, each once, also
    where executors are lost.
    """
    seen = Observation()
    counts = [F.count_if(F.col("_lost") == c).alias(c) for c in columns]
    kept = df.withColumn("_lost", first_null(columns)).observe(seen, *counts).where("_lost is null").drop("_lost")
    spark = df.sparkSession

    def report() -> DataFrame:
        lost = seen.get
        rows = [(stage_name, c, "null rows removed", None, lost[c]) for c in columns if lost.get(c)]
        return spark.createDataFrame(rows, REPORT_SCHEMA)

    return kept, report


def observe_count(df: DataFrame, condition=None) -> tuple[DataFrame, Callable[[], int]]:
    """``df``, and the number of its rows (that meet a condition) once it has been written."""
    seen = Observation()
    counted = F.count(F.lit(1)) if condition is None else F.count_if(condition)
    return df.observe(seen, counted.alias("n")), lambda: seen.get["n"]


def removed_rows(spark, n: int, stage_name: str, issue: str) -> DataFrame:
    """The report of ``removed_report`` from counts that are already there."""
    return spark.createDataFrame([(stage_name, None, issue, None, n)], REPORT_SCHEMA)
