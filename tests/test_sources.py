import pytest

from ledgerlens.operators.quality import REPORT_SCHEMA, drop_report, require_columns
from ledgerlens.plans.settings import NA_TOKENS
from ledgerlens.sources.sinks import append_report, new_run_id, write_result, write_stage
from ledgerlens.sources.tables import (
    cast_failures, normalise_na, read_column_list, read_csv, read_lookups, read_mapping, read_or_compute,
    read_override, read_sales,
)


def put(path, content):
    path.write_text(content)
    return str(path)


def test_csv_with_tokens_and_casts(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'b,a,c,extra\nN/A,1,"x, ""y""",9\n2.5,zz,NOT APPLICABLE,9\n,3,null,9\n')
    out = read_csv(spark, path, "a long, b double, c string").collect()
    assert [tuple(r) for r in out] == [
        (1, None, 'x, "y"'), (None, 2.5, "NOT APPLICABLE"), (3, None, None)
    ]
    with pytest.raises(ValueError, match="nope"):
        read_csv(spark, path, "nope long")
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "none.csv"), "a long")


def test_csv_keeps_line_breaks_and_tells_bad_records(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'a,b,c\n1,"two\nlines",5\n2.0,"q ""x"", y",x7\n3.5,,-2.\n')
    out = read_csv(spark, path, "a long, b string, c int")
    assert [tuple(r) for r in out.collect()] == [(1, "two\nlines", 5), (2, 'q "x", y', None), (None, None, -2)]
    failed = cast_failures(spark, path, "a long, b string, c int").collect()
    assert sorted(map(tuple, failed)) == [("a", "3.5", 1), ("c", "x7", 1)]
    for name, line in (("more", "1,2,3,4"), ("less", "1,2")):
        path = put(tmp_path / f"{name}.csv", f"a,b,c\n1,2,3\n{line}\n")
        for split in (True, False):
            with pytest.raises(Exception, match="bad record"):
                read_csv(spark, path, "a long, c int", multi_line=split).collect()


def test_saved_override_with_a_gap_still_matches(spark, tmp_path):
    path = put(tmp_path / "o.csv", "sales_id,derived_contact_city\n7.0,Klang\n,Ipoh\n9.0,\n")
    out = read_override(spark, path, "derived_contact_city")
    assert [tuple(r) for r in out.collect()] == [(7, "Klang"), (None, "Ipoh"), (9, None)]


def test_sales_key_is_text(spark, tmp_path):
    path = put(tmp_path / "s.csv", "sales_id,nric,buyer_dob\n1,0007,\n2,12,1990-01-01\n")
    out = read_sales(spark, path, "nric", "sales_id long, nric string, buyer_dob string")
    assert [r.nric for r in out.collect()] == ["0007", "12"]
    path = put(tmp_path / "t.csv", "sales_id,nric\n1,0007\n")
    with pytest.raises(ValueError, match="buyer_dob"):
        read_sales(spark, path, "nric", "sales_id long, nric string")
    spark.createDataFrame([(7, "N/A")], "nric long, buyer_dob string").write.parquet(str(tmp_path / "p"))
    r = read_sales(spark, str(tmp_path / "p"), "nric", fmt="parquet").first()
    assert (r.nric, r.buyer_dob) == ("7", None)


def test_lists_and_mappings(spark, tmp_path):
    assert read_column_list(spark, put(tmp_path / "c.csv", "column_name\nspa_date\nphase\n")) == ["spa_date", "phase"]
    m = read_mapping(spark, put(tmp_path / "m.csv", "raw,clean,count,map\na,A,3.0,X\nb,B,,Y\n"))
    assert [tuple(r) for r in m.collect()] == [("a", "A", 3.0, "X"), ("b", "B", None, "Y")]
    with pytest.raises(ValueError):
        read_mapping(spark, put(tmp_path / "bad.csv", "raw,clean\na,A\n"))


def test_lookups(spark, tmp_path):
    over = {
        "id_type": put(tmp_path / "1.csv", "sales_id,derived_id_type\n1,NRIC No.\n"),
        "nationality": put(tmp_path / "2.csv", "sales_id,derived_nationality\n1,OTHERS\n"),
        "city": put(tmp_path / "3.csv", "sales_id,derived_contact_city\n1,Klang\n"),
    }
    ranges = put(
        tmp_path / "r.csv",
        "project_name,phase,build_type,min_area_transformed_to_sqft,max_area_transformed_to_sqft,mean_sqft,"
        "min_area_transformed_to_sqm,max_area_transformed_to_sqm\nP,1,Shop,1,2,1.5,0.1,0.2\n",
    )
    mapping = put(tmp_path / "m.csv", "raw,clean,count,map\na,A,3.0,X\n")
    out = read_lookups(spark, over, ranges, {"race": mapping})
    assert out.city.first().derived_contact_city == "Klang"
    assert out.area_range.first().mean_sqft == 1.5 and out.mappings["race"].count() == 1


def test_tokens_leave_other_columns(spark):
    df = spark.createDataFrame([(t, 1) for t in NA_TOKENS] + [("ok", 2)], "a string, b int")
    assert normalise_na(df).where("a is not null").count() == 1


def test_resume(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def compute():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert read_or_compute(spark, path, compute).count() == 3
    assert len(calls) == 1
    read_or_compute(spark, path, compute, resume=False)
    assert len(calls) == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    for fmt in ("parquet", "csv"):
        for _ in range(2):
            assert write_stage(df, str(tmp_path), fmt, fmt).collect() == df.collect()
    for run in ("r1", "r2"):
        write_result(df, str(tmp_path / "out"), "eval", run)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["mode"], r.run_id) for r in out.collect()} == {("eval", "r1"), ("eval", "r2")}
    with pytest.raises(ValueError):
        write_result(df, str(tmp_path / "out"), "train", "r")
    assert len(new_run_id()) == 15


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), ("x", None), (None, None), ("y", 2)], "a string, b int")
    report = drop_report(df, ["a", "b"], "s")
    assert {r["column"]: r.n for r in report.collect()} == {"a": 2, "b": 1}
    for run in ("r1", "r2"):
        append_report(report, str(tmp_path / "report"), run)
    stored = spark.read.schema(f"{REPORT_SCHEMA}, run_id string").parquet(str(tmp_path / "report"))
    assert sorted((r.run_id, r["column"]) for r in stored.collect()) == [(x, c) for x in ("r1", "r2") for c in ("a", "b")]
    with pytest.raises(ValueError, match="zz"):
        require_columns(df, ["a", "zz"], "here")
