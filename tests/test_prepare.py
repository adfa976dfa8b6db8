import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans.clean import clean
from ledgerlens.plans.extract import extract, label_next_purchase
from ledgerlens.plans.features import GROUPS, add_features, bin_values, group_values
from ledgerlens.plans.prepare import prepare, scoring_rows, with_label
from ledgerlens.plans.settings import Preparation
from ledgerlens.session import stage
from property_rows import COLUMNS, MAPPINGS, NAMES, SCHEMA, make_lookups, make_sales, plain_clean, text

SETTINGS = Preparation(columns=COLUMNS)


@pytest.fixture(scope="module")
def raw(spark):
    return stage(spark.createDataFrame(make_sales(), SCHEMA))


@pytest.fixture(scope="module")
def lookups(spark):
    return make_lookups(spark)


@pytest.fixture(scope="module")
def cleaned(raw, lookups):
    one_view = raw.where("date_type = 'spa_date_type'").drop("date_type")
    out, report = clean(one_view, lookups)
    return stage(out), report.collect(), [r.asDict() for r in one_view.collect()]


def test_extract_joins_views_and_thins(raw):
    done = extract(raw, SETTINGS)
    sales = done.sales
    rows = [dict(zip(NAMES, r)) for r in make_sales()]
    sold = [r for r in rows if r["project_country"] == "Malaysia" and r["last_sales_status"] == "Sold"]
    priced = {r["sales_id"] for r in sold if r["date_type"] == "spa_month_type"}
    by_key = {}
    for r in sold:
        if r["date_type"] == "spa_date_type" and r["sales_id"] in priced and r["contact_nric_masked"]:
            by_key.setdefault(r["contact_nric_masked"], []).append((r["spa_date"], r["sales_id"]))
    groups = {k: list(v) for k, v in by_key.items()}
    want = set()
    for items in by_key.values():
        items.sort()
        while items:
            run = [x for x in items if (x[0] - items[0][0]).days <= 30]
            want.add(run[-1][1])
            items = items[len(run):]
    assert {r.sales_id for r in sales.collect()} == want
    assert done.evaluation is None
    joined = sum(len(v) for v in groups.values())
    assert done.report.first().n == joined - len(want)
    # the customer id is named once even when it is in the column list too
    again = Preparation(columns=[*COLUMNS, "contact_nric_masked"])
    assert extract(raw, again).sales.columns.count("contact_nric_masked") == 1


def test_missing_columns_are_named(raw):
    with pytest.raises(ValueError, match="spa_date"):
        extract(raw.drop("spa_date"), SETTINGS)


def test_cleaning_matches_loop(cleaned):
    out, report, rows = cleaned
    want, dropped = plain_clean(rows)
    got = {r.sales_id: r.asDict() for r in out.collect()}
    assert set(got) == {r["sales_id"] for r in want}
    for r in want:
        for c, v in r.items():
            if isinstance(v, float):
                assert got[r["sales_id"]][c] == pytest.approx(v), (r["sales_id"], c)
            else:
                assert got[r["sales_id"]][c] == v, (r["sales_id"], c)
    assert {r["column"]: r.n for r in report} == dict(dropped)
    assert sum(dropped.values()) > 5


def test_prices_are_filled(cleaned):
    out = cleaned[0]
    assert out.where("derived_non_land_posted_list_price is null").isEmpty()


def test_groups_and_report(cleaned, lookups):
    out, report = group_values(add_features(cleaned[0]), lookups.mappings)
    assert out.count() == cleaned[0].count()
    lost = {(r["column"], r.value) for r in report.collect()}
    for r in out.collect():
        for column, name, target, normalise in GROUPS:
            table = {text(k) if normalise else k: v for k, v in MAPPINGS[name]}
            want = table.get(text(r[column]), "UNKNOWN")
            if name == "annual_income" and r.derived_contact_identification_type == "REG NO.":
                want = "NOT APPLICABLE"
            assert r[target] == want
            if text(r[column]) not in table:
                assert (column, text(r[column])) in lost
    with pytest.raises(ValueError, match="race"):
        group_values(cleaned[0], {k: v for k, v in lookups.mappings.items() if k != "race"})


def test_features(cleaned):
    rows = add_features(cleaned[0]).collect()
    first = {}
    for column in ("project_name", "phase"):
        for r in rows:
            if r[column] is not None:
                key = (column, r[column])
                first[key] = min(first.get(key, dt.datetime.max), r.spa_date)
    for r in rows:
        age = r.spa_date.year - first.get(("project_name", r.project_name), dt.datetime(1, 1, 1)).year
        assert r.derived_township_maturity == ("NEW" if age < 5 else "DEVELOPING" if age <= 10 else "MATURED")
        limit = {"LANDED": 3, "RSKU": 3, "HIGH RISE": 4, "COMMERCIAL": 2, "INDUSTRIAL": 2}
        age = r.spa_date.year - first[("phase", r.phase)].year
        want = "IN PROGRESS" if age < limit[r.derived_phase_property_type] else "COMPLETED"
        assert r.derived_completion_status == want


def test_bins(cleaned):
    out = bin_values(add_features(cleaned[0]), dropped_sales=[1001, 1002])
    assert not {1001, 1002} & {r.sales_id for r in out.select("sales_id").collect()}
    assert out.where("derived_built_up_area_sqft_category is null").isEmpty()
    assert out.where("derived_age_equal_category = 'NOT APPLICABLE'").isEmpty()
    # companies hold one age, so two of its edges coincide
    assert out.where("derived_age = -1").select("derived_age_equal_category").distinct().count() == 1


def test_whole_preparation(raw, lookups, tmp_path):
    settings = Preparation(columns=COLUMNS, evaluation=("2019-01-01", "2020-12-31"), save_dir=str(tmp_path))
    done = prepare(raw, lookups, settings)
    assert done.rows.where("spa_date >= '2019-01-01'").isEmpty()
    assert not done.evaluation.where("spa_date < '2019-01-01'").count()
    assert {p.name for p in tmp_path.iterdir()} == {
        "extraction", "label", "clean", "features", "group", "bin", "eval_slice"
    }
    assert {r.issue for r in done.report.collect()} == {
        "recent purchases removed", "null rows removed", "no mapping target"
    }
    again = prepare(raw.limit(0), lookups, replace(settings, resume=True))
    assert again.rows.count() == done.rows.count() > 50
    assert again.evaluation.count() == done.evaluation.count() and again.report.isEmpty()
    with pytest.raises(ValueError, match="save_dir"):
        prepare(raw, lookups, replace(SETTINGS, resume=True))
    positives = done.rows.where("label = 1").count()
    assert scoring_rows(done.rows).count() == done.rows.count() - positives
    assert scoring_rows(done.rows.drop("label")).count() == done.rows.count()
    late = with_label(done.rows.drop("label", *[c for c in done.rows.columns if c.startswith("repeat_")])
                      .drop("purchase_no", "purchase_count"), "contact_nric_masked")
    assert set(late.columns) == set(done.rows.columns)


def test_labels(spark):
    rows = [
        ("a", 1, dt.datetime(2020, 1, 1), "Landed", 5.0), ("a", 2, dt.datetime(2021, 1, 1, 9), "High Rise", None),
        ("b", 3, dt.datetime(2020, 1, 1), "Landed", 6.0), ("a", 4, None, None, 7.0),
    ]
    df = spark.createDataFrame(
        rows, "k string, sales_id long, spa_date timestamp_ntz, phase_property_type string, "
        "non_land_posted_selling_price double",
    ).withColumn("spa_stamp_date", F.col("spa_date"))
    out = {r.sales_id: r for r in label_next_purchase(df, "k").collect()}
    end = dt.date(2022, 12, 31)
    assert out[1].label == 1 and out[1].repeat_sales_id == "2" and out[1].repeat_spa_date == dt.date(2021, 1, 1)
    assert out[1].repeat_non_land_posted_selling_price is None
    # the next purchase has no date or type, yet there is one
    assert out[2].label == 1 and out[2].repeat_spa_date is None and out[2].repeat_phase_property_type is None
    assert out[4].label == 0 and out[4].purchase_no == 3
    assert (out[3].label, out[3].repeat_sales_id, out[3].repeat_spa_stamp_date) == (0, "NOT APPLICABLE", end)


def test_rows_stay_packed_from_one_join_to_the_next(raw, lookups):
    """No join or window of the cleaning and the grouping passes on a plain wide row."""
    one_view = raw.where("date_type = 'spa_date_type'").drop("date_type")
    cleaned = clean(one_view, lookups)[0]
    grouped, _ = group_values(cleaned, lookups.mappings, features=True)
    for df in (cleaned, grouped):
        plan = df._jdf.queryExecution().optimizedPlan()
        joins = [plan.p(i) for i in range(plan.treeString().count("\n")) if plan.p(i) is not None and plan.p(i).nodeName() == "Join"]
        assert joins
        assert max(j.output().size() for j in joins) < len(one_view.columns) / 2


def test_features_with_the_groups_are_those_on_their_own(cleaned, lookups):
    apart, lost = group_values(add_features(cleaned[0]), lookups.mappings)
    together, lost_too = group_values(cleaned[0], lookups.mappings, features=True)
    assert apart.columns == together.columns
    assert sorted(map(str, apart.collect())) == sorted(map(str, together.collect()))
    assert sorted(map(str, lost.collect())) == sorted(map(str, lost_too.collect()))


def test_preparation_compiles_no_whole_stages_and_puts_the_setting_back(raw, lookups, monkeypatch):
    import ledgerlens.plans.prepare as module

    name, seen = "spark.sql.codegen.wholeStage", []
    before = raw.sparkSession.conf.get(name)
    plain = module.stage
    monkeypatch.setattr(module, "stage", lambda df, label: seen.append(df.sparkSession.conf.get(name)) or plain(df, label))
    prepare(raw, lookups, SETTINGS)
    assert seen and set(seen) == {"false"}
    assert raw.sparkSession.conf.get(name) == before


def test_mean_areas_come_with_the_statistics(raw, lookups, monkeypatch):
    """One pass over the rows before they are written, not one for the statistics and one for the areas."""
    import ledgerlens.plans.clean as module

    labels, plain = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, label: labels.append(label) or plain(df, label))
    clean(raw.where("date_type = 'spa_date_type'").drop("date_type"), lookups)
    assert labels == ["statistics"]
