"""Application statistics, counts and distinct values (AGG-05..AGG-07, AGG-09, SET-01, SET-04)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklink.functions.text import age_days, as_text, clean_str, timestamp_of


def timestamp_column(df: DataFrame, name: str) -> Column:
    """A timestamp column as it is, a text one through the accepted formats."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return timestamp_of(F.col(name))
    return F.col(name).cast("timestamp")


def as_of_date(as_of=None) -> Column:
    """The day ages are counted to: a parameter, today when none is given."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def application_stats(apps: DataFrame, key: str, as_of: Column, keep: tuple[str, ...] = ("state",)) -> DataFrame:
    """AGG-05, AGG-06, AGG-13: one pass over the applications, one row per key.

    `key` is a column of `apps`; rows without a key are left out. Counts of
    decisions come from application_status, ages of open, closed and archived
    applications from status.
    """
    decided = F.lower(as_text(F.col("application_status")))
    status = F.lower(as_text(F.col("status")))
    applied = timestamp_column(apps, "applied_at")
    rows = apps.filter(F.col(key).isNotNull()).select(
        *keep, key, decided.alias("decided"), status.alias("s"), applied.alias("applied")
    )

    def oldest(value: str) -> Column:
        return F.min(F.when(F.col("s") == value, F.col("applied")))

    return (
        rows.groupBy(*keep, key)
        .agg(
            F.count(F.lit(1)).alias("applications"),
            F.count_if(F.col("decided") == "shortlisted").alias("shortlisted"),
            F.count_if(F.col("decided") == "rejected").alias("rejected"),
            F.max("applied").alias("last_applied"),
            oldest("open").alias("oldest_open"),
            oldest("closed").alias("oldest_closed"),
            oldest("archived").alias("oldest_archived"),
        )
        .select(
            *keep, key, "applications", "shortlisted", "rejected", "last_applied",
            age_days(F.col("last_applied"), as_of).alias("last_applied_age"),
            age_days(F.col("oldest_open"), as_of).alias("application_pending_from"),
            age_days(F.col("oldest_closed"), as_of).alias("shortlisted_age"),
            age_days(F.col("oldest_archived"), as_of).alias("rejected_age"),
        )
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """AGG-07: (name, n_rows) per table."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("name"), "n_rows")
        for t, df in tables.items()
    ])


def distinct_values(tables: list[DataFrame], cols: list[str]) -> DataFrame:
    """AGG-09, SET-01: distinct trimmed non-blank values over columns and tables.

    One scan per table: its columns become rows of an array.
    """
    parts = [
        df.select(F.explode(F.array(*[clean_str(F.col(c)) for c in cols if c in df.columns])).alias("value"))
        for df in tables if any(c in df.columns for c in cols)
    ]
    return reduce(DataFrame.unionByName, parts).filter(F.col("value").isNotNull()).distinct()


def pending_outputs(expected: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """SNK-07, SET-04: expected outputs the manifest does not hold as done."""
    return expected.join(manifest.filter("done").select(*keys).distinct(), keys, "left_anti")
