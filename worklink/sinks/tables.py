"""Table sinks and header alignment (SNK-01..SNK-05, SNK-09, SNK-10, PRJ-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "\ufeff"
NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def nested_to_json(df: DataFrame) -> DataFrame:
    """SNK-01: nested columns as JSON text."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, NESTED)]
    return df.withColumns({c: F.to_json(F.col(c)) for c in nested}) if nested else df


def all_text(df: DataFrame) -> DataFrame:
    """SNK-05: every column as text, null as ''."""
    plain = nested_to_json(df)
    return plain.select(*[
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in plain.columns
    ])


def align_to_headers(df: DataFrame, headers: Sequence[str]) -> DataFrame:
    """PRJ-10: columns in the order of the destination's headers.

    Headers without a column are null, '' is null, blank headers at the end are
    dropped and columns the destination lacks are appended.
    """
    wanted = list(headers)
    while wanted and wanted[-1] == "":
        wanted.pop()
    wanted += [c for c in df.columns if c not in wanted]
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}

    def cell(c: str):
        if c not in df.columns:
            return F.lit(None).cast("string").alias(c)
        value = F.col(f"`{c}`")
        return (F.nullif(value, F.lit("")) if c in texts else value).alias(c)

    return df.select(*[cell(c) for c in wanted])


def with_headers(df: DataFrame, published: dict[str, str], headers: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """SNK-04, PRJ-10: report columns under published headers, in the order of the destination's `headers`.

    Headers without a column are null, '' is null, blank headers at the end are dropped and
    columns the destination lacks are appended. `keep` names columns that stay in front as they are. Some
    headers differ by case only, so the result can be written with `spark.sql.caseSensitive` on.
    """
    wanted = list(headers)
    while wanted and wanted[-1] == "":
        wanted.pop()
    column_of = {h: c for c, h in published.items()}
    wanted += [h for h in column_of if h not in wanted]
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}

    def cell(header: str):
        column = column_of.get(header)
        if column is None:
            return F.lit(None).cast("string").alias(header)
        return (F.nullif(F.col(column), F.lit("")) if column in texts else F.col(column)).alias(header)

    return df.select(*keep, *[cell(h) for h in wanted])


def target_root(root: str, test: bool = False) -> str:
    """SNK-09: test runs write next to the production tables, never into them."""
    return f"{root.rstrip('/')}/{'test' if test else 'prod'}"


CSV = {"header": True, "multiLine": True, "escape": '"', "encoding": "UTF-8"}  # for writing and reading


def writable(df: DataFrame, fmt: str = "parquet", stringify: bool = False, bom: bool = False, parts: Sequence[str] = ("state",)) -> DataFrame:
    """The columns as a format takes them: nested ones as JSON text for CSV, all as text where asked for.

    `bom` marks CSV as UTF-8 for spreadsheets.
    """
    out = all_text(df) if stringify else df
    if fmt == "csv":
        out = nested_to_json(out)
        if bom:
            first = next(c for c in out.columns if c not in parts)
            out = out.withColumnRenamed(first, BOM + first)
    return out


def write_table(df: DataFrame, root: str, name: str, fmt: str = "parquet",
                partition_by: Sequence[str] = ("state",), stringify: bool = False,
                bom: bool = False, only_given: bool = False) -> str:
    """SNK-01..SNK-05, SNK-10: overwrites `<root>/<name>`, one folder per state.

    With `only_given` the folders of states that `df` does not hold stay as they are; `versions.replace_states`
    replaces the states of a run exactly, also those that received no rows. A stage must not overwrite the
    path it reads from: give each stage a root of its own.
    """
    path = f"{root.rstrip('/')}/{name}"
    parts = [c for c in partition_by if c in df.columns]
    writer = writable(df, fmt, stringify, bom, parts).write.mode("overwrite").partitionBy(*parts)
    if parts:
        writer = writer.option("partitionOverwriteMode", "dynamic" if only_given else "static")
    if fmt == "csv":
        writer = writer.options(**CSV)
    writer.format(fmt).save(path)
    return path
