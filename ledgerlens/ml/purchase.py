"""Repeat-purchase ensemble and property-type models: train, save, score, evaluate."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import at_least, differs, not_in_keep_null
from ..operators.quality import require_columns
from ..operators.sampling import downsample_slices, hold_out, split_exact, temporal_splits
from ..operators.stats import binary_metrics, class_report
from ..plans.settings import EXCLUDED_TYPES, PROPERTY_TYPES, PurchaseModel, TypeModel
from ..session import path_exists, stage, with_callers_staging
from ..sources.versions import commit, current
from .encode import FEATURES, encode, feature_names, fit_encoder
from .models import Member, fit_member, importances

TRUTH, PREDICTED, PROBABILITY = "truth label", "predicted label", "probability"
REPORT = "validation_report"
# members that are fitted at a time: their jobs share the cluster, and what one leaves idle another takes
AT_ONCE = 4


@dataclass
class Ensemble:
    """An encoder with members whose mean probability decides."""

    encoder: PipelineModel
    members: list[Member]
    importances: list[DataFrame] = field(default_factory=list)
    reports: list[DataFrame | None] = field(default_factory=list)

    def score(self, df: DataFrame, threshold: float) -> DataFrame:
        """Add probability and predicted label; all members in one pass, no joins
        (knn members and forests join their votes)."""
        out = encode(self.encoder, df)
        if any(m.votes for m in self.members):
            # each of them reads the vectors
            out = stage(out, "asked")
        parts = [f"_p{i}" for i in range(len(self.members))]
        for member, c in zip(self.members, parts):
            out = member.score(out, c)
        return soft_vote(out, parts, threshold).drop(FEATURES, *parts)

    def save(self, path: str) -> None:
        """Put the ensemble in place of the one at ``path``, in one step: a failure leaves the old one."""
        commit(SparkSession.active(), path, self._write)

    def _write(self, folder: str) -> None:
        self.encoder.write().overwrite().save(f"{folder}/encoder")
        for i, m in enumerate(self.members, start=1):
            m.save(f"{folder}/{m.name}_{i}")
        for i, table in enumerate(self.importances, start=1):
            ordered = table.orderBy(F.desc("importance"))
            ordered.write.mode("overwrite").parquet(f"{folder}/feature_importance_{i}")
        for i, table in enumerate(self.reports, start=1):
            if table is not None:
                table.write.mode("overwrite").parquet(f"{folder}/{REPORT}_{i}")

    @staticmethod
    def load(spark, path: str, name: str, members: int) -> "Ensemble":
        """The current ensemble at ``path``, with the importances and validation reports stored with it."""
        folder = current(spark, path)
        if folder is None or not path_exists(spark, f"{folder}/encoder"):
            raise FileNotFoundError(f"{path}/encoder")
        encoder = PipelineModel.load(f"{folder}/encoder")
        loaded = [Member.load(spark, name, f"{folder}/{name}_{i}") for i in range(1, members + 1)]

        def tables(stem: str) -> list[DataFrame | None]:
            paths = [f"{folder}/{stem}_{i}" for i in range(1, members + 1)]
            return [spark.read.parquet(p) if path_exists(spark, p) else None for p in paths]

        return Ensemble(encoder, loaded, [t for t in tables("feature_importance") if t is not None], tables(REPORT))


def soft_vote(df: DataFrame, parts: Sequence[str], threshold: float) -> DataFrame:
    """Mean of the members' probabilities and the decision at ``threshold``."""
    mean = reduce(add, [F.col(c) for c in parts]) / len(parts)
    return df.withColumn(PROBABILITY, mean).withColumn(
        PREDICTED, at_least(F.col(PROBABILITY), threshold)
    )


def _fit(name, train, held, names, label, row_id, settings):
    member = fit_member(name, train, label, row_id, settings.params)
    report = None
    if settings.validation > 0:
        scored = member.score(held, "_p").withColumn("_y", at_least(F.col("_p"), 0.5))
        report = class_report(scored, label, "_y")
    return member, report, importances(member, train, names, row_id)


def _side_by_side(spark: SparkSession, fit: Callable, items: Iterable) -> list:
    """``fit`` of every item, some at a time, in the order of the items. Each has a thread and a job group of its own, so
    one that fails takes only its own jobs along; its error is raised once the others have ended."""
    items = list(items)

    @inheritable_thread_target(spark)
    @with_callers_staging
    def run(item):
        spark.sparkContext.setJobGroup(f"fit {item}", f"fit of member {item}")
        return fit(item)

    if AT_ONCE <= 1 or len(items) <= 1:
        return [fit(item) for item in items]
    with ThreadPoolExecutor(min(AT_ONCE, len(items))) as pool:
        return list(pool.map(run, items))


def train_ensemble(
    df: DataFrame,
    settings: PurchaseModel,
    key: str,
    row_id: str = "sales_id",
    date: str = "spa_date",
    label: str = "label",
) -> Ensemble:
    """One member per temporal slice; the encoder is fitted on all rows."""
    features = [c for c in settings.columns if c not in (label, date, key, row_id)]
    require_columns(df, [*features, label, date, row_id], "for the purchase model")
    df = df.select(row_id, label, date, *features)
    encoder = fit_encoder(df, exclude=[row_id, label, date], hash_width=settings.hash_width)
    names = feature_names(encoder)
    encoded = temporal_splits(encode(encoder, df), date, settings.splits, settings.pivot_year)
    encoded = stage(encoded.select(row_id, label, "split_id", FEATURES), "encoded")
    slices = list(range(1, settings.splits + 1))
    rows = encoded.where(F.col("split_id").isin(slices))
    if settings.down_sampling:
        rows = downsample_slices(
            rows, "split_id", slices, label, [row_id], settings.ratio, clamp=settings.clamp
        )
    rows = stage(rows, "slices")
    rows = stage(hold_out(rows, "split_id", slices, settings.validation, [row_id], "_held"), "held")

    def fit(i):
        part = rows.where(F.col("split_id") == i)
        train, held = part.where(~F.col("_held")), part.where("_held")
        return _fit(settings.model, train, held, names, label, row_id, settings)

    members, reports, weights = zip(*_side_by_side(df.sparkSession, fit, slices))
    return Ensemble(encoder, list(members), list(weights), list(reports))


def one_hot_labels(df: DataFrame, column: str, classes: Mapping[str, str]) -> DataFrame:
    """One 0/1 column per class ``{name: value}``; a null is in no class."""
    return df.withColumns(
        {name: F.coalesce((F.col(column) == value).cast("int"), F.lit(0)) for name, value in classes.items()}
    )


def type_rows(
    df: DataFrame, next_kind: str = "repeat_phase_property_type", label: str = "label",
    exclude: Sequence[str] = tuple(EXCLUDED_TYPES),
) -> DataFrame:
    """Rows of repeat buyers with a usable next property type."""
    if label in df.columns:
        df = df.where(differs(F.col(label), 0)).drop(label)
    return df.where(not_in_keep_null(F.col(next_kind), exclude))


def train_types(
    df: DataFrame,
    settings: TypeModel,
    key: str,
    row_id: str = "sales_id",
    date: str = "spa_date",
    label: str = "label",
    next_kind: str = "repeat_phase_property_type",
    own_kind: str = "derived_phase_property_type",
    classes: Mapping[str, str] = PROPERTY_TYPES,
    exclude: Sequence[str] = tuple(EXCLUDED_TYPES),
) -> dict[str, Ensemble]:
    """One-vs-rest models, one per property type; each encoder sees its training rows only."""
    features = [c for c in settings.columns if c not in (label, date, key, row_id, next_kind, own_kind)]
    require_columns(df, [*features, next_kind, row_id], "for the type models")
    keep = [row_id, next_kind, *([label] if label in df.columns else []), *features]
    rows = type_rows(df.select(keep), next_kind, label, exclude)
    classes = {t: classes[t] for t in settings.types}
    rows = stage(one_hot_labels(rows, next_kind, {f"_is_{t}": v for t, v in classes.items()}), "types")
    train, held = split_exact(rows, settings.validation, [row_id])
    train, held = stage(train, "types-train"), stage(held, "types-held")
    encoder = fit_encoder(train.select(features), hash_width=settings.hash_width)
    names = feature_names(encoder)
    train = stage(encode(encoder, train), "types-encoded")
    held = encode(encoder, held)

    def fit(t):
        return _fit(settings.model, train, held, names, f"_is_{t}", row_id, settings)

    fitted = _side_by_side(df.sparkSession, fit, classes)
    return {t: Ensemble(encoder, [m], [table], [report]) for t, (m, report, table) in zip(classes, fitted)}


def save_types(models: Mapping[str, Ensemble], path: str) -> None:
    for t, model in models.items():
        model.save(f"{path}/{t}")


def load_types(spark, path: str, settings: TypeModel) -> dict[str, Ensemble]:
    return {t: Ensemble.load(spark, f"{path}/{t}", settings.model, 1) for t in settings.types}


def evaluate(
    model: Ensemble, df: DataFrame, key: str, truth: str, threshold: float
) -> tuple[DataFrame, DataFrame]:
    """(predictions with truth, metrics)."""
    scored = model.score(df, threshold).select(
        key, PROBABILITY, PREDICTED, F.col(truth).cast("int").alias(TRUTH)
    )
    # the metrics read what was scored, and score nothing again
    scored = stage(scored, "evaluated")
    return scored, binary_metrics(scored, f"`{TRUTH}`", f"`{PREDICTED}`")


def evaluate_types(
    models: Mapping[str, Ensemble], df: DataFrame, key: str, threshold: float = 0.5,
    next_kind: str = "repeat_phase_property_type", classes: Mapping[str, str] = PROPERTY_TYPES,
    exclude: Sequence[str] = tuple(EXCLUDED_TYPES),
) -> dict[str, tuple[DataFrame, DataFrame]]:
    rows = df.where(not_in_keep_null(F.col(next_kind), exclude))
    rows = one_hot_labels(rows, next_kind, {f"_is_{t}": classes[t] for t in models})
    rows = stage(rows, "types-test")
    return {t: evaluate(m, rows, key, f"_is_{t}", threshold) for t, m in models.items()}


def score_cascade(
    purchase: Ensemble,
    types: Mapping[str, Ensemble],
    df: DataFrame,
    key: str,
    threshold: float = 0.6,
    type_threshold: float = 0.5,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(all purchase predictions, type predictions of the likely buyers)."""
    if not types:
        warnings.warn("no property type is selected", stacklevel=2)
    scored = stage(purchase.score(df, threshold), "scored")
    return scored.select(key, PROBABILITY, PREDICTED), score_types(types, likely_buyers(scored), key, type_threshold)


def likely_buyers(scored: DataFrame) -> DataFrame:
    """The input rows of predicted buyers, fit for the type models now or in a later run."""
    return scored.where(F.col(PREDICTED) == 1).drop(PROBABILITY, PREDICTED)


def score_types(
    types: Mapping[str, Ensemble], buyers: DataFrame, key: str, threshold: float = 0.5
) -> dict[str, DataFrame]:
    return {
        t: m.score(buyers, threshold).select(key, PROBABILITY, PREDICTED) for t, m in types.items()
    }
