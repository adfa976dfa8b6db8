"""The whole preparation, and the modes that use it."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import differs
from ..operators.quality import REPORT_SCHEMA
from ..operators.sequence import HOT_ROWS
from ..session import delete_path, path_exists, stage, staging, wide_rows
from ..sources.sinks import write_stage
from . import manifest
from .clean import clean_observed
from .extract import extract, label_next_purchase
from .features import add_features, bin_values, group_values
from .settings import Lookups, Preparation


@dataclass(frozen=True)
class Prepared:
    rows: DataFrame
    evaluation: DataFrame | None
    report: DataFrame


def prepare(
    raw: DataFrame, lookups: Lookups, settings: Preparation, hot_rows: int = HOT_ROWS
) -> Prepared:
    """Extract, label, clean, add features, group and bin.

    Tables are staged where a later step reads its input more than once: after
    thinning (statistics), cleaning (group minima) and grouping (bin edges). Those that
    nothing reads any more are deleted at the end.
    With ``save_dir`` every phase's table is kept under its name, with a manifest of what it was made
    from. ``resume`` goes on behind the last finished phase, and refuses if what that was made from has
    changed; the report then has the rows of the phases that were run.
    """
    spark = raw.sparkSession
    facts, last = {}, None
    if settings.resume and not settings.save_dir:
        raise ValueError("save_dir is needed to resume")
    if settings.save_dir:
        facts = manifest.gather(raw, lookups, settings)
        if settings.resume:
            last = manifest.last_finished(spark, settings.save_dir, facts)
        else:
            manifest.forget(spark, settings.save_dir)
    with wide_rows(spark), staging() as staged:
        done = _phases(raw, lookups, settings, hot_rows, facts, last)
        staged.keep(done.rows, done.evaluation, done.report)
    return done


def _phases(
    raw: DataFrame, lookups: Lookups, settings: Preparation, hot_rows: int, facts: dict, last: str | None
) -> Prepared:
    """The phases behind ``last``."""
    spark, save_dir = raw.sparkSession, settings.save_dir
    reports = [spark.createDataFrame([], REPORT_SCHEMA)]

    def missing(phase: str) -> bool:
        return last is None or manifest.PHASES.index(phase) > manifest.PHASES.index(last)

    def keep(df: DataFrame, phase: str, barrier: bool = False) -> DataFrame:
        if save_dir:
            out = write_stage(df, save_dir, phase)
            manifest.write(spark, save_dir, phase, facts)
            return out
        return stage(df, phase) if barrier else df

    def table(name: str) -> DataFrame | None:
        path = f"{save_dir.rstrip('/')}/{name}"
        return spark.read.parquet(path) if path_exists(spark, f"{path}/_SUCCESS") else None

    if last is not None:
        df, evaluation = table(last), table("eval_slice")
    else:
        extracted = extract(raw, settings, hot_rows)
        evaluation = extracted.evaluation
        if evaluation is not None and save_dir:
            evaluation = write_stage(evaluation, save_dir, "eval_slice")
        elif save_dir:
            delete_path(spark, f"{save_dir.rstrip('/')}/eval_slice")
        reports.append(extracted.report)
        df = keep(extracted.sales, "extraction")
    if settings.with_label and missing("label"):
        df = keep(label_next_purchase(df, settings.key, hot_rows=hot_rows), "label", barrier=True)
    if missing("clean"):
        # staged, the lookups have a known size and small ones are broadcast
        fixed = {n: stage(getattr(lookups, n), n) for n in ("id_type", "nationality", "city", "area_range")}
        cleaned, dropped = clean_observed(df, replace(lookups, **fixed))
        df = keep(cleaned, "clean", barrier=True)
        reports.append(dropped())
    if missing("features") and save_dir:
        df = keep(add_features(df), "features")
    if missing("group"):
        # a table of features is made only to be kept
        grouped, unmapped = group_values(df, lookups.mappings, features=not save_dir)
        df = keep(grouped, "group", barrier=True)
        # its tables are small; what it is made from need not stay for it
        reports.append(stage(unmapped, "unmapped"))
    if missing("bin"):
        df = keep(bin_values(df, settings.dropped_sales), "bin")
    return Prepared(df, evaluation, reduce(DataFrame.unionByName, reports))


def with_label(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Label a prepared table that was made without labels."""
    return df if "label" in df.columns else label_next_purchase(df, key, hot_rows=hot_rows)


def scoring_rows(df: DataFrame) -> DataFrame:
    """Rows to score: known positives are left out."""
    return df.where(differs(F.col("label"), 1)) if "label" in df.columns else df
