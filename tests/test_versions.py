"""Tables whose states are replaced as a whole."""

import pytest
from pyspark.sql import functions as F

from worklink.sinks import versions
from worklink.sinks.tables import CSV, writable
from worklink.sources.files import read_table

STATES = ["KA", "UP"]


def rows(spark, *values):
    return spark.createDataFrame(list(values), "state string, id string, n int")


def held(spark, path, states=None):
    return sorted((r.state, r.n) for r in versions.read_current(spark, path, states).collect())


def test_a_state_that_became_empty_reads_as_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    first = versions.replace_states(rows(spark, ("KA", "1", 1), ("KA", "2", 2), ("UP", "3", 3), ("XX", "4", 4)), path, "r1", STATES)
    assert first == {"KA": 2, "UP": 1} and held(spark, path) == [("KA", 1), ("KA", 2), ("UP", 3)]
    assert versions.replace_states(rows(spark, ("UP", "5", 5)), path, "r2", STATES) == {"KA": 0, "UP": 1}
    assert held(spark, path) == [("UP", 5)] and held(spark, path, ["KA"]) == []
    # a run of one state that has no rows leaves the other alone
    assert versions.replace_states(rows(spark).limit(0), path, "r3", ["UP"]) == {"UP": 0}
    assert held(spark, path) == [] and versions.read_current(spark, path).columns == ["state", "id", "n"]
    versions.replace_states(rows(spark, ("KA", "6", 6)), path, "r4", ["KA"])
    assert held(spark, path) == [("KA", 6)]
    assert read_table(spark, path, "parquet", columns=["n"]).collect()[0].n == 6


def test_a_run_that_breaks_off_leaves_the_old_table_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_states(rows(spark, ("KA", "1", 1), ("UP", "2", 2)), path, "r1", STATES)
    broken = rows(spark, ("KA", "3", 3), ("UP", "4", 4)).withColumn(
        "n", F.when(F.col("state") == "UP", F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        versions.replace_states(broken.repartition(2, "state"), path, "r2", STATES)
    assert held(spark, path) == [("KA", 1), ("UP", 2)]
    # written, but the run ended before the pointer was set
    versions.write_run(rows(spark, ("KA", "5", 5)), path, "r3", STATES)
    assert held(spark, path) == [("KA", 1), ("UP", 2)]
    versions.replace_states(rows(spark, ("KA", "6", 6)), path, "r4", ["KA"])
    assert held(spark, path) == [("KA", 6), ("UP", 2)]
    assert {p.name for p in tmp_path.glob("t/_run=*")} == {"_run=r1", "_run=r4"}  # folders of broken runs are gone


def test_two_runs_do_not_both_commit_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    frame = rows(spark, ("KA", "1", 1))
    versions.replace_states(frame, path, "r1", ["KA"])
    versions.replace_states(frame, path, "r2", ["KA"])
    monkeypatch.setattr(versions, "_numbers", lambda spark, path: [1])  # what a run saw that started before r2
    with pytest.raises(RuntimeError, match="version 2"):
        versions.replace_states(frame, path, "r3", ["KA"])
    monkeypatch.undo()
    assert versions.current(spark, path)["runs"] == {"KA": "r2"}


def test_old_folders_go_once_no_pointer_names_them(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        versions.replace_states(rows(spark, ("KA", "1", i)), path, f"r{i}", ["KA"])
    assert {p.name for p in tmp_path.glob("t/_run=*")} == {"_run=r3", "_run=r4"} and held(spark, path) == [("KA", 4)]


def test_csv_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([("KA", 'a "b"\n,c', ["x"]), ("UP", None, None)], "state string, t string, l array<string>")
    out = writable(frame, "csv", stringify=True)
    assert versions.replace_states(out, path, "r1", STATES, "csv", **CSV) == {"KA": 1, "UP": 1}
    got = {r.state: r for r in versions.read_current(spark, path).collect()}
    assert got["KA"].t == 'a "b"\n,c' and got["KA"].l == '["x"]'


def test_a_column_run_is_a_column_like_others(spark, tmp_path):
    path, frame = str(tmp_path / "t"), rows(spark, ("KA", "1", 1)).withColumn("run", F.lit("mine"))
    versions.replace_states(frame, path, "r1", ["KA"])
    assert versions.read_current(spark, path).first().run == "mine"
    with pytest.raises(ValueError, match="_run"):
        versions.replace_states(frame.withColumn("_run", F.lit(1)), path, "r2", ["KA"])


def test_nothing_committed(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, str(tmp_path / "none"))
    assert read_table(spark, str(tmp_path / "none"), columns=["a"], missing_ok=True).isEmpty()
