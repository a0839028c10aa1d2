"""Files, headers, manifest and JDBC options."""

from dataclasses import fields

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from worklink.operators.stats import pending_outputs
from worklink.sinks import runlog
from worklink.sinks.tables import BOM, align_to_headers, target_root, write_table
from worklink.plans.pipeline import by_side
from worklink.sources.files import Bundle, list_tables, load_bundle, read_table, table_name
from worklink.sources.jdbc import environment_sources, slice_predicates


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("KA", "1", 'a "b"\n,c', ["x"]), ("UP", "2", None, None)],
        "state string, id string, t string, l array<string>")
    path = write_table(df, str(tmp_path), "t", "csv", bom=True)
    back = read_table(spark, path, "csv")
    assert {r["state"] for r in back.collect()} == {"KA", "UP"}
    first = back.filter("state = 'KA'").first()
    assert first["t"] == 'a "b"\n,c' and first["l"] == '["x"]'
    assert back.columns[0].lstrip(BOM) == "id"


def test_missing_table_is_empty(spark, tmp_path):
    df = read_table(spark, str(tmp_path / "none"), columns=["a", "b"], missing_ok=True)
    assert df.columns == ["a", "b"] and df.isEmpty()


def test_headers(spark):
    df = spark.createDataFrame([("", "x")], "a string, b string")
    out = align_to_headers(df, ["c", "a", "", ""])
    assert out.columns == ["c", "a", "b"] and out.first().asDict() == {"c": None, "a": None, "b": "x"}


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "m")
    expected = spark.createDataFrame([(s, n) for s in ("KA", "UP") for n in "ab"], "state string, name string")

    def todo():
        return {tuple(r) for r in pending_outputs(expected, runlog.read_manifest(spark, path), ["state", "name"]).collect()}

    assert runlog.read_manifest(spark, path).isEmpty()
    runlog.record_done(spark.createDataFrame([("KA", 3), ("UP", 0)], "state string, n_rows long"), path, "a")
    assert todo() == {("KA", "b"), ("UP", "b")}
    runlog.forget(spark, path, ["KA"])
    assert todo() == {("KA", "a"), ("KA", "b"), ("UP", "b")}


def test_publish_goes_on_after_a_failure(spark):
    def broken():
        raise ValueError("no table")

    written, errors = runlog.publish_all(
        {"a": lambda: spark.range(1), "b": broken}, lambda df, name: None)
    assert list(written) == ["a"] and errors == ["b: ValueError: no table"]
    with pytest.raises(ValueError):
        runlog.publish_all({"b": broken}, lambda df, name: None, (ValueError,))


def test_a_write_of_one_state_keeps_the_other(spark, tmp_path):
    both = spark.createDataFrame([("KA", 1), ("UP", 2)], "state string, n int")
    path = write_table(both, str(tmp_path), "t")
    write_table(both.filter("state = 'KA'").withColumn("n", F.lit(7)), str(tmp_path), "t", only_given=True)
    assert {(r.state, r.n) for r in spark.read.parquet(path).collect()} == {("KA", 7), ("UP", 2)}
    write_table(both.filter("state = 'KA'"), str(tmp_path), "t")
    assert {(r.state, r.n) for r in spark.read.parquet(path).collect()} == {("KA", 1)}


def test_columns_folders_and_bundles(spark, tmp_path):
    rows = spark.createDataFrame([("KA", "1", "x"), ("UP", "2", "y")], "state string, id string, v string")
    for name in ("ka_seeker/profile_clean", "up_seeker/profile_clean"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.csv").write_text("id,v\n1,x\n")
    assert read_table(spark, str(tmp_path), "csv", columns=["v"], recursive=True).collect() == [Row(v="x"), Row(v="x")]
    assert {r.name for r in list_tables(spark, str(tmp_path)).collect()} == {"ka_seeker_profile", "up_seeker_profile"}
    root = str(tmp_path / "bundle")
    for f in fields(Bundle):
        if f.name != "member_provider":
            write_table(rows, root, f.name)
    bundle = load_bundle(spark, root, ["KA"])
    assert bundle.member_provider is None and [r.id for r in bundle.profile.collect()] == ["1"]
    write_table(rows, root, "member_provider")
    assert load_bundle(spark, root).member_provider.count() == 2


def test_database_tables_as_the_run_takes_them(spark):
    sided = spark.createDataFrame([("KA", "seeker", "1"), ("KA", "provider", "2")], "state string, side string, id string")
    plain = spark.createDataFrame([("KA", "3")], "state string, id string")
    out = by_side({"user": sided, "member": sided, "organization": sided, "profile": plain})
    assert set(out) == {"user_seeker", "user_provider", "member_seeker", "member_provider", "org_seeker", "org_provider", "profile"}
    assert [r.id for r in out["org_provider"].collect()] == ["2"]


def test_names_and_targets(value):
    assert value(table_name(F.lit("/x/ka_seeker/profile_clean.csv"))) == "ka_seeker_profile"
    assert target_root("/r/", test=True) != target_root("/r")


def test_jdbc_sources():
    side = {"port": 1, "dbname": "d", "user": "u", "password": "p"}
    creds = {s: {"host_prod": "prod", "host_uat": "uat", "seeker": side, "provider": side} for s in ("ka", "up")}
    hosts = {(s.state, s.side): s.url for s in environment_sources(creds, "uat")}
    assert "uat" in hosts["KA", "seeker"] and "prod" in hosts["UP", "provider"] and len(hosts) == 4
    slices = slice_predicates("id", 3)
    assert len(slices) == 3 and sum("IS NULL" in s for s in slices) == 1
