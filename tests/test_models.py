import random

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ledgerlens.ml import models, purchase
from ledgerlens.ml.encode import FEATURES, encode, feature_names, fit_encoder, importance_by_column
from ledgerlens.ml.models import Member, fit_member, importances
from ledgerlens.ml.purchase import (
    PREDICTED, PROBABILITY, Ensemble, evaluate, evaluate_types, load_types, one_hot_labels, save_types,
    score_cascade, soft_vote, train_ensemble, train_types,
)
from ledgerlens.plans.settings import MODEL_NAMES, PurchaseModel, TypeModel
from ledgerlens.session import stage

PARAMS = {
    "random_forest": {"numTrees": 5, "maxDepth": 4}, "gradient_boosting": {"maxIter": 5},
    "mlp": {"maxIter": 30}, "decision_tree": {"maxDepth": 4}, "svm": {"maxIter": 15},
}
KINDS = ["Landed", "High Rise", "Commercial", "RSKU", None]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(240):
        colour, size = rng.choice(["red", "blue", "green", None]), rng.choice([1.0, 2.0, 3.0, None])
        label = int((colour == "red") ^ (rng.random() < 0.1))
        data.append((i, f"c{i % 50}", f"{2010 + i % 9}-06-01", colour, size, i % 7 == 0, label, rng.choice(KINDS)))
    df = spark.createDataFrame(
        data, "sales_id long, customer string, day string, colour string, size double, flag boolean, "
        "label int, repeat_phase_property_type string",
    )
    return stage(df.withColumn("spa_date", F.to_timestamp("day")).drop("day"))


COLUMNS = ["label", "spa_date", "colour", "size", "flag"]


@pytest.fixture(scope="module")
def encoded(rows):
    part = rows.select("sales_id", "label", "colour", "size", "flag")
    encoder = fit_encoder(part, exclude=["sales_id", "label"])
    return encoder, stage(encode(encoder, part))


def test_encoding(spark, encoded):
    encoder, _ = encoded
    assert feature_names(encoder) == [
        "size", "colour_Missing", "colour_blue", "colour_green", "colour_red", "flag_false", "flag_true"
    ]
    new = spark.createDataFrame(
        [(None, None, None), ("pink", 9.0, True)], "colour string, size double, flag boolean"
    )
    a, b = [r[0] for r in encode(encoder, new).select(vector_to_array(FEATURES)).collect()]
    assert 1.5 < a[0] < 2.5 and a[1:] == [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    assert b == [9.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]  # an unseen colour is all zeros


def test_empty_numeric_column_is_left_out(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "c string, x double")
    assert feature_names(fit_encoder(df)) == ["c_a", "c_b"]


@pytest.mark.parametrize("name", MODEL_NAMES)
def test_every_model(spark, encoded, tmp_path, name):
    encoder, data = encoded
    params = dict(PARAMS.get(name, {}))
    member = fit_member(name, data, "label", "sales_id", params)
    scored = member.score(data, "p").select("sales_id", "label", "p").collect()
    assert len(scored) == 240 and all(0 <= r.p <= 1 for r in scored)
    right = sum((r.p >= 0.5) == (r.label == 1) for r in scored)
    assert right > 190
    member.save(str(tmp_path / name))
    again = Member.load(spark, name, str(tmp_path / name)).score(data, "p").collect()
    assert {r.sales_id: round(r.p, 9) for r in again} == {r.sales_id: round(r.p, 9) for r in scored}
    table = {r.feature: r.importance for r in importances(member, data, feature_names(encoder), "sales_id").collect()}
    assert len(table) == 7
    assert max(table, key=table.get) == "colour_red"
    if name in ("decision_tree", "random_forest", "gradient_boosting"):
        assert sum(table.values()) == pytest.approx(1)


def test_unknown_model(encoded):
    with pytest.raises(ValueError):
        fit_member("oracle", encoded[1], "label", "sales_id")
    with pytest.raises(ValueError):
        PurchaseModel(model="oracle")
    with pytest.raises(ValueError):
        TypeModel(types=["castle"])


def test_soft_vote(spark):
    df = spark.createDataFrame([(0.6, 0.6), (0.2, 0.9), (0.9, 0.4)], "a double, b double")
    out = soft_vote(df, ["a", "b"], 0.6).collect()
    assert [r[PREDICTED] for r in out] == [1, 0, 1]
    assert out[1][PROBABILITY] == pytest.approx(0.55)


def test_one_hot_null_is_no_class(spark):
    df = spark.createDataFrame([("Landed",), (None,)], "k string")
    assert [tuple(r)[1:] for r in one_hot_labels(df, "k", {"a": "Landed", "b": "X"}).collect()] == [(1, 0), (0, 0)]


def test_ensemble_and_cascade(spark, rows, tmp_path):
    settings = PurchaseModel(columns=COLUMNS, splits=2, clamp=True, params=PARAMS["random_forest"])
    model = train_ensemble(rows, settings, "customer")
    assert len(model.members) == 2 and len(model.reports) == 2
    assert {r["class"] for r in model.reports[0].collect()} >= {"accuracy", "macro avg", "weighted avg"}
    predictions, metrics = evaluate(model, rows, "customer", "label", 0.6)
    m = metrics.first()
    assert m.tp + m.tn + m.fp + m.fn == 240 and m.accuracy > 0.8
    assert predictions.columns == ["customer", PROBABILITY, PREDICTED, "truth label"]

    model.save(str(tmp_path / "rp"))
    loaded = Ensemble.load(spark, str(tmp_path / "rp"), "random_forest", 2)
    a = sorted(r[PROBABILITY] for r in loaded.score(rows, 0.6).collect())
    assert a == pytest.approx(sorted(r[PROBABILITY] for r in predictions.collect()))
    with pytest.raises(FileNotFoundError):
        Ensemble.load(spark, str(tmp_path / "rp"), "random_forest", 3)
    saved = spark.read.parquet(str(tmp_path / "rp" / "feature_importance_1")).collect()
    assert len(saved) == 7

    types = train_types(
        rows, TypeModel(columns=["colour", "size"], params=PARAMS["random_forest"]), "customer"
    )
    save_types(types, str(tmp_path / "pt"))
    types = load_types(spark, str(tmp_path / "pt"), TypeModel())
    assert list(types) == ["landed", "high_rise", "commercial"]
    for scored, metrics in evaluate_types(types, rows, "customer").values():
        assert scored.count() == rows.where("coalesce(repeat_phase_property_type, '') <> 'RSKU'").count()
    scored, by_type = score_cascade(model, types, rows, "customer", threshold=0.6)
    buyers = scored.where(F.col(PREDICTED) == 1).count()
    assert 0 < buyers < 240 and all(t.count() == buyers for t in by_type.values())
    with pytest.warns(UserWarning):
        score_cascade(model, {}, rows, "customer")


def test_too_few_zeros(rows):
    positive = rows.withColumn("label", F.lit(1))
    with pytest.raises(ValueError, match="without replacement"):
        train_ensemble(positive, PurchaseModel(columns=COLUMNS, splits=1), "customer")


def test_too_many_categories_are_an_error(spark):
    rows = spark.range(3000).selectExpr("cast(id as string) as name", "id % 3 as x")
    with pytest.raises(ValueError, match="name"):
        fit_encoder(rows, max_categories=1000)
    fit_encoder(rows, max_categories=4000)


def test_hashed_categories(spark):
    """A column of 100,000 values: nothing of them is kept, and its slots count as one column."""
    rows = spark.range(100_000).selectExpr("id", "concat('name', id) as name", "id % 3 as x", "cast(id % 2 as int) as label")
    encoder = fit_encoder(rows, exclude=["id", "label"], max_categories=1000, hash_width=256)
    names = feature_names(encoder)
    assert len(names) == 257 and names[0] == "x" and names[1:] == [f"name#{i}" for i in range(256)]
    new = spark.createDataFrame([(1, "never seen", 2, 1), (2, None, None, 0)], "id long, name string, x long, label int")
    for r in encode(encoder, new).collect():
        assert len(r.features) == 257 and sum(r.features.toArray()[1:]) == 1
    train = encode(encoder, rows.limit(2000))
    member = fit_member("decision_tree", train, "label", "id", {"maxDepth": 3})
    table = importance_by_column(importances(member, train, names, "id"))
    assert {r.feature for r in table.collect()} == {"x", "name"}


def rings(spark):
    import math

    rows = []
    for i in range(600):
        angle, radius = i * 2.399, (1.0 if i % 2 else 3.0) + 0.3 * math.sin(i)
        rows.append((i, radius * math.cos(angle), radius * math.sin(angle), i % 2))
    return spark.createDataFrame(rows, "sales_id long, a double, b double, label int")


def test_curved_margins(spark, tmp_path):
    """Rings that no line parts; the same scores after a save."""
    rows = rings(spark)
    train = encode(fit_encoder(rows, exclude=["sales_id", "label"]), rows).persist()

    def right(member):
        return member.score(train, "p").where("(p >= 0.5) = (label = 1)").count() / 600

    assert right(fit_member("svm", train, "label", "sales_id")) < 0.7
    curved = fit_member("svm", train, "label", "sales_id", {"curves": 200})
    assert right(curved) > 0.95
    curved.save(str(tmp_path / "svm"))
    loaded = Member.load(spark, "svm", str(tmp_path / "svm"))
    assert loaded.kernel == curved.kernel
    a, b = ([r.p for r in m.score(train, "p").orderBy("sales_id").collect()] for m in (curved, loaded))
    assert a == b
    found = {r.feature: r.importance for r in importances(curved, train, ["a", "b"], "sales_id").collect()}
    assert set(found) == {"a", "b"} and min(found.values()) > 0.1
    with pytest.raises(ValueError, match="curves"):
        fit_member("decision_tree", train, "label", "sales_id", {"curves": 10})


@pytest.mark.parametrize("name", ["mlp", "knn"])
def test_importance_on_arrays(spark, monkeypatch, name):
    """The slots tried on batches agree with rows scored one by one by Spark."""
    rows = rings(spark).withColumn("c", F.lit(1.5))
    train = encode(fit_encoder(rows, exclude=["sales_id", "label"]), rows).persist()
    member = fit_member(name, train, "label", "sales_id", {"maxIter": 30} if name == "mlp" else None)
    fast = {r.slot: r.importance for r in models.permutation_importance(member, train, 3, "sales_id", 2).collect()}
    monkeypatch.setattr(models, "array_scorer", lambda *_: None)
    slow = {r.slot: r.importance for r in models.permutation_importance(member, train, 3, "sales_id", 2).collect()}
    assert fast == pytest.approx(slow) and fast[2] == 0 and fast[0] > 0


def test_members_side_by_side(spark, rows, monkeypatch):
    settings = PurchaseModel(model="decision_tree", columns=COLUMNS, splits=2, clamp=True, params=PARAMS["decision_tree"])
    scored = []
    for at_once in (1, 4):
        monkeypatch.setattr(purchase, "AT_ONCE", at_once)
        model = train_ensemble(rows, settings, "customer")
        scored.append(sorted((r.customer, r[PROBABILITY]) for r in model.score(rows, 0.6).collect()))
    assert scored[0] == scored[1]
    with pytest.raises(ZeroDivisionError):
        purchase._side_by_side(spark, lambda i: spark.range(i).count() // (i - 2), [1, 2, 3])


def test_stored_reports_and_a_failing_save(spark, rows, tmp_path, monkeypatch):
    settings = PurchaseModel(columns=COLUMNS, splits=2, clamp=True, params=PARAMS["random_forest"])
    model = train_ensemble(rows, settings, "customer")
    path = str(tmp_path / "rp")
    model.save(path)
    loaded = Ensemble.load(spark, path, "random_forest", 2)
    for a, b in ((model.reports, loaded.reports), (model.importances, loaded.importances)):
        assert [sorted(map(tuple, t.collect())) for t in a] == [sorted(map(tuple, t.collect())) for t in b]

    def lost(self, folder):
        raise OSError("disk")

    monkeypatch.setattr(Member, "save", lost)
    with pytest.raises(OSError):
        model.save(path)
    assert Ensemble.load(spark, path, "random_forest", 2).score(rows, 0.6).count() == rows.count()


def test_fit_uses_all_cores_whatever_the_files(spark, monkeypatch):
    """Rows that come in one part are dealt to all cores, and a deep forest does not walk its trees anew each pass."""
    seen = {}

    class Fake:
        def __init__(self, **settings):
            seen.update(settings)

        def setWeightCol(self, name):
            return self

        def fit(self, frame):
            seen["parts"] = frame.rdd.getNumPartitions()
            seen["rows"] = sorted(r.id for r in frame.select("id").collect())

    monkeypatch.setitem(models.ESTIMATORS, "random_forest", (Fake, None))
    rows = spark.range(400).coalesce(1).select("id", (F.col("id") % 2).alias("label"), array_to_vector(F.array(F.col("id").cast("double"))).alias(FEATURES))
    fit_member("random_forest", rows, "label", "id")
    assert seen["parts"] >= min(4, spark.sparkContext.defaultParallelism) and seen["cacheNodeIds"]
    assert seen["rows"] == list(range(400))
