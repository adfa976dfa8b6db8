from concurrent.futures import ThreadPoolExecutor

import pytest

from ledgerlens.operators.lookup import update_mapping
from ledgerlens.session import path_exists, read_text, release, stage, staged_dir, staging, tidied, with_callers_staging, write_text
from ledgerlens.sources.sinks import new_run_id
from ledgerlens.sources.versions import commit, current, read_table, replace_table


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_take_turns(spark, tmp_path):
    path = str(tmp_path / "table")
    assert current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_table(spark, path)
    for n in range(1, 5):
        replace_table(spark.range(n), path)
        assert rows(read_table(spark, path)) == [(i,) for i in range(n)]
        # one version and its pointer
        assert {p.name for p in tmp_path.iterdir() if not p.name.startswith(".")} == {"table" if n % 2 else "table.next", "table.current"}


def test_a_failing_write_keeps_the_old_version(spark, tmp_path):
    path = str(tmp_path / "model")
    commit(spark, path, lambda to: spark.range(3).write.parquet(to))

    def broken(to):
        spark.range(9).write.parquet(f"{to}/half")
        raise OSError("disk")

    for _ in range(2):
        with pytest.raises(OSError):
            commit(spark, path, broken)
        assert read_table(spark, path).count() == 3
    commit(spark, path, lambda to: spark.range(4).write.parquet(to))
    assert read_table(spark, path).count() == 4


def test_a_folder_without_pointer_is_a_version(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.range(2).write.parquet(path)
    assert current(spark, path) == path
    replace_table(read_table(spark, path).union(spark.range(5, 6)), path)  # read while it is replaced
    assert rows(read_table(spark, path)) == [(0,), (1,), (5,)]
    assert not path_exists(spark, path)


def test_mapping_is_written_back(spark, tmp_path):
    path = str(tmp_path / "mapping")
    old = spark.createDataFrame([("Ipoh", "PERAK"), ("Johor", None)], "clean string, target string")
    replace_table(old, path)
    new = spark.createDataFrame([("johor ", "south"), ("kl", "centre")], "clean string, target string")
    assert rows(update_mapping(spark, path, new, "clean", "target")) == [("Ipoh", "PERAK"), ("JOHOR", "SOUTH"), ("KL", "CENTRE")]
    with pytest.raises(Exception):
        update_mapping(spark, path, new.selectExpr("raise_error('lost') as clean", "target"), "clean", "target")
    assert read_table(spark, path).count() == 3


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "note")
    assert read_text(spark, path) is None
    for text in ("one", "two é\n", ""):
        write_text(spark, path, text)
        assert read_text(spark, path) == text


def test_staged_tables_are_deleted(spark):
    with staging() as outer:
        with staging() as block:
            a, b = stage(spark.range(3), "a"), stage(spark.range(4), "b")
            kept = b.join(a.groupBy().count(), b["id"] >= 0).select("id")
            c = stage(spark.range(5), "c")
            block.keep(kept)
        assert not path_exists(spark, c._staged_path)
        assert kept.count() == 4
        outer.keep(b)
    assert not path_exists(spark, a._staged_path) and path_exists(spark, b._staged_path)
    release(b, kept)
    assert not path_exists(spark, b._staged_path)
    with pytest.raises(KeyError), staging() as block:
        d = stage(spark.range(1), "d")
        block.keep(d)
        raise KeyError
    assert not path_exists(spark, d._staged_path) and staged_dir(spark)


def test_run_ids_keep_apart():
    ids = []
    for _ in range(50):
        ids.append(new_run_id())
        while new_run_id() == ids[-1]:
            pass
    assert sorted(set(ids)) == ids and all(len(i) == 15 for i in ids)


def test_threads_stage_into_the_callers_block(spark):
    def both(other):
        return stage(spark.range(2)), other

    @tidied
    def made():
        with ThreadPoolExecutor(2) as pool:
            found = list(pool.map(with_callers_staging(both), range(3)))
        made.tables = [t for t, _ in found]
        return found[0][0].where("id > 0")

    assert made().count() == 1
    assert [path_exists(spark, t._staged_path) for t in made.tables] == [True, False, False]
