from dataclasses import replace

import pytest

from ledgerlens.plans import manifest, prepare as phases
from ledgerlens.plans.prepare import prepare
from ledgerlens.plans.settings import Preparation
from ledgerlens.session import path_exists, stage, staged_dir
from property_rows import COLUMNS, SCHEMA, make_lookups, make_sales

PERIOD = ("2019-01-01", "2020-12-31")


@pytest.fixture(scope="module")
def raw(spark):
    return stage(spark.createDataFrame(make_sales(300, 7), SCHEMA))


@pytest.fixture(scope="module")
def whole(spark, raw):
    done = prepare(raw, make_lookups(spark), Preparation(columns=COLUMNS, evaluation=PERIOD))
    return rows(done.rows), rows(done.evaluation)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


class Killed(Exception):
    pass


@pytest.mark.parametrize("phase", manifest.PHASES)
def test_goes_on_behind_the_last_finished_phase(spark, raw, whole, tmp_path, monkeypatch, phase):
    settings = Preparation(columns=COLUMNS, evaluation=PERIOD, save_dir=str(tmp_path))
    real, written = manifest.write, []

    def stopped(spark, save_dir, name, facts):
        if name == phase:
            raise Killed  # its table is there, its manifest is not
        real(spark, save_dir, name, facts)

    monkeypatch.setattr(manifest, "write", stopped)
    with pytest.raises(Killed):
        prepare(raw, make_lookups(spark), settings)
    monkeypatch.setattr(manifest, "write", real)
    write = phases.write_stage
    monkeypatch.setattr(phases, "write_stage", lambda df, folder, name: written.append(name) or write(df, folder, name))
    done = prepare(raw, make_lookups(spark), replace(settings, resume=True))
    first = manifest.PHASES.index(phase)
    assert written == [*(["eval_slice"] if not first else []), *manifest.PHASES[first:]]
    assert (rows(done.rows), rows(done.evaluation)) == whole


def test_refuses_what_has_changed(spark, raw, tmp_path):
    lookups = make_lookups(spark)
    settings = Preparation(columns=COLUMNS, evaluation=PERIOD, save_dir=str(tmp_path))
    prepare(raw, lookups, settings)
    again = replace(settings, resume=True)
    assert prepare(raw, lookups, again).report.isEmpty()
    changed = {
        "extraction settings": (raw, lookups, replace(again, thin_days=10)),
        "dropped sales": (raw, lookups, replace(again, dropped_sales=[5])),
        "input schema": (raw.withColumn("more", raw["phase"]), lookups, again),
        "input files": (stage(raw.limit(50)), lookups, again),
        "override and range lookups": (raw, replace(lookups, city=lookups.city.limit(1)), again),
        "mapping tables": (raw, replace(lookups, mappings={**lookups.mappings, "race": lookups.mappings["race"].limit(1)}), again),
    }
    for fact, (table, tables, how) in changed.items():
        with pytest.raises(ValueError, match=fact):
            prepare(table, tables, how)
    # without resume it starts anew
    anew = prepare(raw, lookups, replace(settings, thin_days=10))
    assert not anew.report.isEmpty()
    with pytest.raises(ValueError, match="extraction settings"):
        prepare(raw, lookups, again)


def test_a_later_phase_of_an_earlier_run_does_not_count(spark, raw, tmp_path, monkeypatch):
    settings = Preparation(columns=COLUMNS, evaluation=PERIOD, save_dir=str(tmp_path))
    prepare(raw, make_lookups(spark), settings)

    def stopped(*_):
        raise Killed

    monkeypatch.setattr(phases, "clean_observed", stopped)
    with pytest.raises(Killed):
        prepare(raw, make_lookups(spark), settings)
    assert path_exists(spark, f"{tmp_path}/bin/_SUCCESS")
    facts = manifest.gather(raw, make_lookups(spark), settings)
    assert manifest.last_finished(spark, str(tmp_path), facts) == "label"


def test_leaves_only_the_tables_that_are_read(spark, raw):
    import os

    folder = staged_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    done = prepare(raw, make_lookups(spark), Preparation(columns=COLUMNS))
    left = {n.rpartition("-")[0] for n in set(os.listdir(folder)) - before}
    assert left == {"group", "unmapped"}
    assert done.rows.count() > 0 and done.report.count() > 0
