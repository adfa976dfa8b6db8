"""Modes: prepare, make test labels, train, evaluate or score."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from ..ml.purchase import (
    PREDICTED, PROBABILITY, Ensemble, evaluate, evaluate_types, likely_buyers, load_types, save_types,
    score_types, train_ensemble, train_types,
)
from ..operators.periods import holdout_labels
from ..session import stage, staging
from ..sources.sinks import append_report, latest_result, new_run_id, write_result, write_stage
from .prepare import Prepared, prepare, scoring_rows, with_label
from .settings import EXCLUDED_TYPES, Lookups, Preparation, PurchaseModel, TypeModel


@dataclass(frozen=True)
class Modes:
    """What to do after the preparation; test labels exclude the other modes."""

    test_labels: bool = False
    training: bool = False
    evaluation: bool = False
    inference: bool = False

    def __post_init__(self):
        if self.test_labels and (self.training or self.evaluation or self.inference):
            raise ValueError("making test labels excludes training, evaluation and inference")

    @property
    def labelled(self) -> bool:
        return self.training or (self.evaluation and not self.inference)


@dataclass
class Outcome:
    rows: DataFrame
    report: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)


def run(
    raw: DataFrame,
    lookups: Lookups,
    preparation: Preparation,
    modes: Modes,
    out_dir: str,
    purchase: PurchaseModel | None = None,
    types: TypeModel | None = None,
) -> Outcome:
    """Run the modes; models, results and reports go under ``out_dir``.

    Inference with type models alone takes the buyers that the last inference of
    a purchase model stored. Staged tables that the outcome does not read are deleted.
    """
    with staging() as staged:
        outcome = _run(raw, lookups, preparation, modes, out_dir, purchase, types)
        staged.keep(outcome.rows, outcome.report, *outcome.tables.values())
    return outcome


def _run(
    raw: DataFrame,
    lookups: Lookups,
    preparation: Preparation,
    modes: Modes,
    out_dir: str,
    purchase: PurchaseModel | None,
    types: TypeModel | None,
) -> Outcome:
    if purchase is None and types is None:
        raise ValueError("give a purchase model, a type model or both")
    need_period = modes.test_labels or modes.labelled and modes.evaluation
    if need_period and preparation.evaluation is None:
        raise ValueError("test labels and evaluation need an evaluation period")
    labelled = modes.labelled or modes.test_labels
    done = prepare(raw, lookups, replace(preparation, with_label=labelled))
    spark, run_id = raw.sparkSession, new_run_id()
    append_report(done.report, f"{out_dir}/report", run_id)
    key = preparation.key
    rows = done.rows
    if need_period and done.evaluation is None:
        raise FileNotFoundError("the resumed preparation has no evaluation slice")
    if (modes.training or modes.evaluation) and "label" not in rows.columns:
        rows = write_stage(with_label(rows, key), preparation.save_dir or out_dir, "bin_labelled")
    outcome = Outcome(rows, done.report)

    if modes.test_labels:
        repeat, typed = _test_sets(done, rows, key)
        outcome.tables["purchase_test"] = write_stage(repeat, out_dir, "purchase_test")
        outcome.tables["type_test"] = write_stage(typed, out_dir, "type_test")
        return outcome

    if modes.training:
        if purchase is not None:
            train_ensemble(rows, purchase, key).save(f"{out_dir}/purchase_model")
        if types is not None:
            save_types(train_types(rows, types, key), f"{out_dir}/type_model")

    if modes.evaluation and modes.inference:
        warnings.warn("evaluation and inference cannot run at the same time", stacklevel=2)
    elif modes.evaluation:
        repeat, typed = _test_sets(done, rows, key)
        results = {}
        if purchase is not None:
            model = _load_purchase(spark, out_dir, purchase)
            results["purchase"] = evaluate(model, repeat, key, "label", purchase.threshold)
        if types is not None:
            models = load_types(spark, f"{out_dir}/type_model", types)
            for name, pair in evaluate_types(models, typed, key, types.threshold).items():
                results[name] = pair
        for name, (scored, metrics) in results.items():
            _write(outcome, scored, out_dir, f"{name}_predictions", "eval", run_id)
            _write(outcome, metrics, out_dir, f"{name}_metrics", "eval", run_id)
    elif modes.inference:
        if purchase is not None:
            model = _load_purchase(spark, out_dir, purchase)
            scored = stage(model.score(scoring_rows(rows), purchase.threshold), "scored")
            buyers = likely_buyers(scored)
            scored = scored.select(key, PROBABILITY, PREDICTED)
            _write(outcome, scored, out_dir, "purchase_predictions", "infer", run_id)
            _write(outcome, buyers, out_dir, "likely_buyers", "infer", run_id)
        else:
            buyers = latest_result(spark, f"{out_dir}/likely_buyers", "infer")
        if types is not None:
            models = load_types(spark, f"{out_dir}/type_model", types)
            for name, part in score_types(models, buyers, key, types.threshold).items():
                _write(outcome, part, out_dir, f"{name}_predictions", "infer", run_id)
    return outcome


def _test_sets(done: Prepared, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return holdout_labels(
        rows, done.evaluation, key, "phase_property_type", ["spa_date", "sales_id"],
        exclude=EXCLUDED_TYPES,
    )


def _load_purchase(spark, out_dir: str, settings: PurchaseModel) -> Ensemble:
    return Ensemble.load(spark, f"{out_dir}/purchase_model", settings.model, settings.splits)


def _write(outcome: Outcome, df: DataFrame, out_dir: str, name: str, mode: str, run_id: str) -> None:
    write_result(df, f"{out_dir}/{name}", mode, run_id)
    outcome.tables[name] = df
