"""File sources (SRC-05..SRC-12)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklink.operators.flags import parse_denylist
from worklink.operators.matching import only_states
from worklink.session import path_exists
from worklink.sinks.versions import POINTERS, read_current

# multi-line because JSON text may hold line breaks
CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "encoding": "UTF-8"}


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_table(spark: SparkSession, path: str, fmt: str = "csv",
               schema: T.StructType | None = None, columns: Sequence[str] | None = None,
               missing_ok: bool = False, recursive: bool = False) -> DataFrame:
    """SRC-05..SRC-07, SRC-09, SRC-11: a table, or an empty one where none is expected.

    CSV comes as text columns unless a schema is given, so digit strings keep
    their form. Only the columns asked for are read. Of a table that a run has committed
    (`sinks.versions`) the valid rows are read.
    """
    if path_exists(spark, f"{path}/{POINTERS}"):
        df = read_current(spark, path)
        return df if columns is None else df.select(*columns)
    if missing_ok and not path_exists(spark, path):
        return spark.createDataFrame([], schema or text_schema(columns or []))
    reader = spark.read
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.format(fmt).load(path)
    except AnalysisException:
        if not missing_ok:  # a file without content has no schema to infer
            raise
        df = spark.createDataFrame([], schema or text_schema(columns or []))
    if columns is not None:
        df = df.select(*columns)
    return df


def read_denylist(spark: SparkSession, path: str) -> DataFrame:
    """SRC-08: (kind, value) of a line-oriented file."""
    return parse_denylist(spark.read.text(path))


def table_name(path: Column) -> Column:
    """SRC-10: `<folder>_<stem without _clean>` of a file path."""
    folder = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    stem = F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1)
    return F.concat(folder, F.lit("_"), F.replace(stem, F.lit("_clean"), F.lit("")))


def list_tables(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """SRC-10: (name, path) of every file below a folder; file contents stay unread."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(root).select("path")
    )
    return files.select(table_name(F.col("path")).alias("name"), "path")


@dataclass(frozen=True)
class Bundle:
    """SRC-12: the cleaned tables of all states, told apart by column `state`."""

    profile: DataFrame
    user_seeker: DataFrame
    member_seeker: DataFrame
    org_seeker: DataFrame
    job_posting: DataFrame
    job_application: DataFrame
    user_provider: DataFrame
    org_provider: DataFrame
    member_provider: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        held = {f.name: getattr(self, f.name) for f in fields(self)}
        return {n: df for n, df in held.items() if df is not None}

    def states(self, states: Sequence[str] | None) -> "Bundle":
        return Bundle(**{n: only_states(df, states) for n, df in self.tables().items()})


def load_bundle(spark: SparkSession, root: str, states: Sequence[str] | None = None,
                fmt: str = "parquet") -> Bundle:
    """SRC-12: tables below `root`, partitioned by state; other states are not read."""
    # members of the provider side are optional
    names = [f.name for f in fields(Bundle) if f.default is not None or path_exists(spark, f"{root}/{f.name}")]
    bundle = Bundle(**{n: read_table(spark, f"{root}/{n}", fmt) for n in names})
    return bundle.states(states)
