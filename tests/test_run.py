from dataclasses import replace

import pytest

from ledgerlens.plans.prepare import prepare
from ledgerlens.plans.run import Modes, run
from ledgerlens.plans.settings import Preparation, PurchaseModel, TypeModel
from ledgerlens.session import path_exists, stage, staged_dir
from property_rows import COLUMNS, SCHEMA, make_lookups, make_sales

MODEL_COLUMNS = [
    "label", "spa_date", "derived_age_equal_category", "derived_gender", "group_derived_race",
    "derived_rebate_percentage_category", "derived_township_maturity", "derived_phase_property_type",
]
SMALL = {"numTrees": 3, "maxDepth": 3}
PURCHASE = PurchaseModel(columns=MODEL_COLUMNS, splits=2, pivot_year=2012, clamp=True, params=SMALL)
TYPES = TypeModel(columns=[*MODEL_COLUMNS, "repeat_phase_property_type"], types=["landed", "commercial"], params=SMALL)
PERIOD = ("2019-01-01", "2021-06-30")


@pytest.fixture(scope="module")
def raw(spark):
    return stage(spark.createDataFrame(make_sales(400, 5), SCHEMA))


@pytest.fixture(scope="module")
def prepared(spark, raw, tmp_path_factory):
    """Folder with the finished tables, unlabelled, and an evaluation slice."""
    folder = str(tmp_path_factory.mktemp("prepared"))
    settings = Preparation(columns=COLUMNS, evaluation=PERIOD, with_label=False, save_dir=folder)
    prepare(raw, make_lookups(spark), settings)
    return folder


def test_train_evaluate_then_score(spark, raw, prepared, tmp_path):
    lookups, out = make_lookups(spark), str(tmp_path)
    settings = Preparation(columns=COLUMNS, evaluation=PERIOD, save_dir=prepared, resume=True)
    done = run(raw, lookups, settings, Modes(training=True, evaluation=True), out, PURCHASE, TYPES)
    assert path_exists(spark, f"{prepared}/bin_labelled/_SUCCESS")
    assert set(done.tables) == {
        "purchase_predictions", "purchase_metrics", "landed_predictions", "landed_metrics",
        "commercial_predictions", "commercial_metrics",
    }
    m = done.tables["purchase_metrics"].first()
    assert m.tp + m.tn + m.fp + m.fn == done.tables["purchase_predictions"].count() > 10
    assert path_exists(spark, f"{out}/purchase_model/feature_importance_2")

    scored = run(raw, lookups, settings, Modes(inference=True), out, PURCHASE, TYPES)
    assert "label" not in scored.rows.columns
    stored = spark.read.parquet(f"{out}/purchase_predictions")
    assert {r["mode"] for r in stored.select("mode").distinct().collect()} == {"eval", "infer"}
    buyers = scored.tables["likely_buyers"].count()
    assert scored.tables["landed_predictions"].count() == buyers

    # the type models alone, on the buyers that were stored
    alone = run(raw, lookups, settings, Modes(inference=True), out, types=TYPES)
    assert set(alone.tables) == {"landed_predictions", "commercial_predictions"}
    for name in alone.tables:
        a, b = (sorted(map(str, x.tables[name].collect())) for x in (scored, alone))
        assert a == b and len(a) == buyers

    # a smaller ensemble leaves nothing of the larger one
    smaller = replace(PURCHASE, splits=1)
    run(raw, lookups, settings, Modes(training=True), out, smaller)
    assert not path_exists(spark, f"{out}/purchase_model/random_forest_2")


def test_labels_only_and_bad_modes(spark, raw, tmp_path):
    lookups, out = make_lookups(spark), str(tmp_path)
    with pytest.raises(ValueError):
        Modes(test_labels=True, training=True)
    with pytest.raises(ValueError, match="period"):
        run(raw, lookups, Preparation(columns=COLUMNS), Modes(test_labels=True), out, PURCHASE)
    with pytest.raises(ValueError):
        run(raw, lookups, Preparation(columns=COLUMNS), Modes(), out)
    settings = Preparation(columns=COLUMNS, evaluation=PERIOD)
    done = run(raw, lookups, settings, Modes(test_labels=True), out, PURCHASE)
    rp, pt = done.tables["purchase_test"], done.tables["type_test"]
    assert rp.count() > pt.count() > 0
    assert {r.label for r in rp.select("label").distinct().collect()} == {0, 1}


def test_staged_tables_can_be_cleared(spark):
    stage(spark.range(1))
    assert path_exists(spark, staged_dir(spark))
