"""Relational sources over JDBC (SRC-01..SRC-04)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklink.constants import PROVIDER_TABLES, SEEKER_TABLES

CONNECT_TIMEOUT_S = 30


@dataclass(frozen=True)
class Source:
    """One database: a state and a side of the market."""

    state: str
    side: str  # seeker or provider
    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"
    slices: int = 1  # parallel reads per table
    slice_key: str = "id"

    @property
    def tables(self) -> tuple[str, ...]:
        """SRC-02, SRC-03."""
        return SEEKER_TABLES if self.side == "seeker" else PROVIDER_TABLES


def slice_predicates(key: str, slices: int) -> list[str]:
    """WHERE clauses that cut a table with text keys into even slices.

    Keys are texts, so there is no numeric range to cut; a hash spreads them
    evenly. Rows without a key go with the first slice.
    """
    hashed = f"mod(abs(mod(hashtext(\"{key}\"), {slices})), {slices})"
    return [
        f'{hashed} = {i}' + (f' OR "{key}" IS NULL' if i == 0 else "") for i in range(slices)
    ]


def read_jdbc_table(spark: SparkSession, source: Source, table: str) -> DataFrame:
    """SRC-01: a whole table, every column, with its state and side."""
    properties = {
        "user": source.user, "password": source.password, "driver": source.driver,
        "loginTimeout": str(CONNECT_TIMEOUT_S), "fetchsize": "10000",
    }
    predicates = slice_predicates(source.slice_key, source.slices) if source.slices > 1 else None
    df = spark.read.jdbc(source.url, f'"{table}"', predicates=predicates, properties=properties)
    return df.withColumns({"state": F.lit(source.state), "side": F.lit(source.side)})


def environment_sources(credentials: dict, env: str = "prod", driver_url=None) -> list[Source]:
    """SRC-04: sources per state and side; only KA has more than one environment."""
    make_url = driver_url or (lambda host, port, db: f"jdbc:postgresql://{host}:{port}/{db}")
    out = []
    for state, creds in credentials.items():
        host = creds[f"host_{env if state.upper() == 'KA' else 'prod'}"]
        for side in ("seeker", "provider"):
            c = creds[side]
            out.append(Source(
                state.upper(), side, make_url(host, c["port"], c["dbname"]),
                c["user"], c["password"], slices=c.get("slices", 1),
            ))
    return out


def read_jdbc_tables(spark: SparkSession, sources: Sequence[Source],
                     read=read_jdbc_table) -> dict[str, DataFrame]:
    """SRC-01..SRC-04: one table per name, all states and sides in it."""
    parts: dict[str, list[DataFrame]] = {}
    for source in sources:
        for table in source.tables:
            parts.setdefault(table, []).append(read(spark, source, table))
    return {
        t: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
        for t, dfs in parts.items()
    }
