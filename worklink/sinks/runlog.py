"""Run log, run history and the manifest of finished outputs (SNK-06..SNK-08)."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklink.operators.stats import row_counts
from worklink.sources.files import read_table
from pyspark.sql import types as T

MANIFEST_SCHEMA = "state string, name string, done boolean, n_rows long"
STAMP = "%Y-%m-%d %H:%M UTC"


def counts_row(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """(name, n_rows) as one row with a column per name; a table not counted has 0."""
    return counts.groupBy().agg(*[
        F.coalesce(F.max(F.when(F.col("name") == n, F.col("n_rows"))), F.lit(0)).alias(n)
        for n in names
    ])


def run_log_row(counts: DataFrame, names: Sequence[str], started: datetime,
                finished: datetime | None = None, errors: Sequence[str] = ()) -> DataFrame:
    """SNK-06: time stamp, duration in seconds, the counts and the failed tables."""
    finished = finished or datetime.now(timezone.utc)
    return counts_row(counts, names).select(
        F.lit(finished.strftime(STAMP)).alias("run_timestamp"),
        F.lit(round((finished - started).total_seconds())).alias("duration_s"),
        *names, F.lit(" | ".join(errors)).alias("errors"),
    )


def state_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n_rows) with names like ka_profile, from one scan per table."""
    return reduce(DataFrame.unionByName, [
        df.groupBy("state").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.concat(F.lower("state"), F.lit(f"_{t}")).alias("name"), "n_rows")
        for t, df in tables.items()
    ])


def counted(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """(name, n_rows) with names like ka_profile, from rows per table and state that were counted while writing."""
    rows = [(f"{s.lower()}_{t}", n) for t, of_state in counts.items() for s, n in of_state.items()]
    return spark.createDataFrame(rows, "name string, n_rows long")


def state_names(states: Sequence[str], tables: Sequence[str]) -> list[str]:
    return [f"{s.lower()}_{t}" for s in states for t in tables]


def history_row(tables: dict[str, DataFrame] | DataFrame, states: Sequence[str], when: datetime | None = None,
                names: Sequence[str] = ()) -> DataFrame:
    """SNK-08: per state the rows of each table; counts (name, n_rows) may be given instead of tables, with the tables' names."""
    given = isinstance(tables, DataFrame)
    names = state_names(states, list(names) if given else list(tables))
    when = when or datetime.now(timezone.utc)
    return counts_row(tables if given else state_counts(tables), names).select(
        F.lit(when.strftime(STAMP)).alias("run_timestamp"), *names)


def publish_all(tables: dict[str, Callable[[], DataFrame]], write: Callable[[DataFrame, str], object],
                fatal: tuple[type[Exception], ...] = ()):
    """SNK-05: writes every table; one that fails is noted and the run goes on, unless the error is a `fatal` one.

    Returns what `write` gave for each written table, and for each that failed its name and the
    error, whose traceback goes to the log `worklink`.
    """
    written, errors = {}, []
    for name, make in tables.items():
        try:
            written[name] = write(make(), name)
        except fatal:
            raise
        except Exception as error:
            logging.getLogger("worklink").exception("table %s was not written", name)
            errors.append(f"{name}: {type(error).__name__}: {str(error).strip().splitlines()[0] if str(error).strip() else ''}")
    return written, errors


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """SNK-07: outputs recorded so far; empty before the first run."""
    schema = T.StructType.fromDDL(MANIFEST_SCHEMA)
    return read_table(spark, path, "parquet", schema, missing_ok=True)


def done_counts(spark: SparkSession, path: str, name: str, states: Sequence[str]) -> dict[str, int]:
    """SNK-07: rows per state of a finished output, as the manifest knows them; 0 where it is not finished."""
    rows = read_manifest(spark, path).filter((F.col("name") == name) & F.col("done") & F.col("state").isin(*states)).collect()
    return {s: 0 for s in states} | {r.state: r.n_rows for r in rows}


def record_done(counts: DataFrame, path: str, name: str) -> None:
    """SNK-07: appends a finished output, one row per state of `counts` (state, n_rows)."""
    rows = counts.select("state", F.lit(name).alias("name"), F.lit(True).alias("done"), F.col("n_rows").cast("long").alias("n_rows"))
    rows.coalesce(1).write.mode("append").partitionBy("state").parquet(path)


def forget(spark: SparkSession, path: str, states: Sequence[str]) -> None:
    """SNK-07: a run that does not resume starts the manifest of its states anew."""
    (spark.createDataFrame([(s, "", False, 0) for s in states], MANIFEST_SCHEMA).coalesce(1)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("state").parquet(path))


def append_row(row: DataFrame, path: str) -> None:
    """SNK-06, SNK-08."""
    row.coalesce(1).write.mode("append").parquet(path)


__all__ = [
    "append_row", "counted", "counts_row", "done_counts", "forget", "history_row", "publish_all", "read_manifest",
    "record_done", "row_counts", "run_log_row", "state_counts", "state_names",
]
