"""Writing stage tables, predictions, metrics and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F


#: Digits of a run id's time, and microseconds to one step of it.
DIGITS, STEP = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", 40


def new_run_id() -> str:
    """The day, then the time of the day in steps of 40 microseconds, as six digits of base 36: runs within one second
    keep apart, and later ids sort behind earlier ones."""
    now = dt.datetime.now()
    steps = (now - now.replace(hour=0, minute=0, second=0, microsecond=0)) // dt.timedelta(microseconds=STEP)
    time = ""
    for _ in range(6):
        steps, digit = divmod(steps, len(DIGITS))
        time = DIGITS[digit] + time
    return f"{now:%Y%m%d}_{time}"


def write_stage(df: DataFrame, save_dir: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Replace a stage table and read it back, which also cuts the lineage."""
    path = f"{save_dir.rstrip('/')}/{name}"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
        return df.sparkSession.read.option("header", True).schema(df.schema).csv(path)
    writer.format(fmt).save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path)


def write_result(df: DataFrame, path: str, mode: str, run_id: str) -> None:
    """Append a result under its mode and run, as partition columns."""
    if mode not in ("eval", "infer"):
        raise ValueError("mode must be 'eval' or 'infer'")
    tagged = df.withColumns({"mode": F.lit(mode), "run_id": F.lit(run_id)})
    tagged.write.mode("append").partitionBy("mode", "run_id").parquet(path)


def append_report(report: DataFrame, path: str, run_id: str) -> None:
    """Append a report under its run, as a partition column."""
    report.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def latest_result(spark: SparkSession, path: str, mode: str) -> DataFrame:
    """The rows that the last run of a mode wrote, without the partition columns."""
    rows = spark.read.option("basePath", path).parquet(path).where(F.col("mode") == mode)
    last = rows.agg(F.max(F.col("run_id").cast("string"))).first()[0]
    if last is None:
        raise FileNotFoundError(f"{path} has no rows of mode {mode}")
    return rows.where(F.col("run_id") == last).drop("mode", "run_id")
