"""Tables whose states are replaced as a whole, or not at all (SNK-01..SNK-04, SNK-10, FLT-08, AGG-07).

A table is a folder with one folder per run, `_run=<id>/state=<state>`, and a pointer that names the valid run of every
state. A write adds a folder of its own and then, in one rename, a new pointer. Until then
readers see the old table, whatever happened to the run; from then on they see the new rows of all its
states, none where a state received no rows. States that are not of the run keep theirs. Rows are counted while they are written.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTERS = "_current"  # numbered pointers; the highest one counts
KEPT = 2  # pointers whose folders stay, so that a reader that has just opened a table can finish


def _files(spark: SparkSession, path: str):
    """The file system of a path and the class of its paths."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    return jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _listed(spark: SparkSession, path: str) -> list[str]:
    fs, jvm_path = _files(spark, path)
    return sorted(f.getPath().getName() for f in fs.globStatus(jvm_path(f"{path}/*")) or [])


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in _listed(spark, f"{path}/{POINTERS}") if n.isdigit()]


def _pointer(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(spark.read.text(f"{path}/{POINTERS}/{number:09d}", wholetext=True).first().value)


def current(spark: SparkSession, path: str) -> dict | None:
    """The newest pointer {"runs": {state: run}, "schema": ..., "format": ...}; None where nothing was ever committed."""
    numbers = _numbers(spark, path)
    return _pointer(spark, path, numbers[-1]) if numbers else None


def write_run(df: DataFrame, path: str, run: str, states: Sequence[str], fmt: str = "parquet", **options) -> dict[str, int]:
    """First step: the rows of a run in a folder of its own; returns rows per state, counted on the way.

    Rows of other states than the run's are not written. Nothing is visible before `point`. A column `_run` would
    clash with the folders.
    """
    if "_run" in df.columns:
        raise ValueError("a table that is replaced by states cannot have a column _run")
    rows = df.filter(F.col("state").isin(*states))
    counted = Observation()
    rows = rows.observe(counted, F.count(F.lit(1)).alias("n"), *[
        F.count(F.when(F.col("state") == s, 1)).alias(f"n{i}") for i, s in enumerate(states)])
    rows.write.mode("errorifexists").partitionBy("state").options(**options).format(fmt).save(f"{path}/_run={run}")
    metrics = counted.get
    return {s: metrics[f"n{i}"] for i, s in enumerate(states)}


def point(spark: SparkSession, path: str, run: str, states: Sequence[str], schema: T.StructType, fmt: str = "parquet",
          options: dict | None = None) -> None:
    """Second step: the run's folder becomes the valid one of its states, by one rename. Folders no pointer names go.

    Two runs that commit at once do not both succeed: the number of a pointer can be given once.
    """
    numbers = _numbers(spark, path)
    old = _pointer(spark, path, numbers[-1]) if numbers else {"runs": {}}
    new = {"runs": old["runs"] | {s: run for s in states}, "schema": json.loads(schema.json()), "format": fmt, "options": options or {}}
    number = (numbers[-1] if numbers else 0) + 1
    fs, jvm_path = _files(spark, path)
    draft, final = jvm_path(f"{path}/{POINTERS}/_draft-{run}"), jvm_path(f"{path}/{POINTERS}/{number:09d}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(new).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"{path}: another run committed version {number}")
    kept = [_pointer(spark, path, n) for n in numbers[-(KEPT - 1):]] + [new]
    named = {f"_run={r}" for p in kept for r in p["runs"].values()}
    for folder in _listed(spark, path):
        if folder.startswith("_run=") and folder not in named:
            fs.delete(jvm_path(f"{path}/{folder}"), True)
    for n in numbers[: -(KEPT - 1)]:
        fs.delete(jvm_path(f"{path}/{POINTERS}/{n:09d}"), False)


def replace_states(df: DataFrame, path: str, run: str, states: Sequence[str], fmt: str = "parquet", **options) -> dict[str, int]:
    """Both steps: exactly the states of a run are replaced; returns the rows of each, 0 for one that became empty."""
    counts = write_run(df, path, run, states, fmt, **options)
    point(df.sparkSession, path, run, states, df.schema, fmt, {k: str(v) for k, v in options.items()})
    return counts


def read_current(spark: SparkSession, path: str, states: Sequence[str] | None = None) -> DataFrame:
    """The valid rows of a table, or of some of its states; a state without rows gives none."""
    pointer = current(spark, path)
    if pointer is None:
        raise FileNotFoundError(f"{path}: nothing was committed")
    schema = T.StructType.fromJson(pointer["schema"])
    fs, jvm_path = _files(spark, path)
    folders = [f"{path}/_run={run}/state={s}" for s, run in sorted(pointer["runs"].items()) if states is None or s in states]
    folders = [f for f in folders if fs.exists(jvm_path(f))]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path).options(**pointer["options"]).format(pointer["format"])
    return reader.load(folders).select(*[f"`{c}`" for c in schema.names])
