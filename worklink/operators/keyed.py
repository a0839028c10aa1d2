"""Keyed de-duplication and joins that survive a hot key (WIN-01, WIN-02, AGG-03, AGG-04, JN-*)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worklink.session import stage

FIRST_BY = ("created_at", "id")  # what makes a row the first of its key
TASK_ROWS = 1_000_000  # result rows of a product join that one task makes


def first_per_key(df: DataFrame, keys: list[str], rest: list[str] = (), first_by: tuple[str, ...] = FIRST_BY) -> DataFrame:
    """WIN-01: one row per key with the columns `rest` (default: all others), the first by created_at and id.

    Of `first_by` the columns that exist count; equal rows are ordered by the rest, nulls last.
    The filter on the row number lets Spark keep one row per key and task before the
    shuffle, so a key held by a third of the rows costs a row per task.
    """
    rest = list(rest) or [c for c in df.columns if c not in keys]
    order = [c for c in first_by if c in df.columns and c not in keys]
    order += [c for c in rest if c not in order]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order]))
    return df.withColumn("_row", number).filter("_row = 1").select(*keys, *rest)


def first_org_per_user(members: DataFrame) -> DataFrame:
    """AGG-03: the first organisation that is not null per user, by created_at and id, then by the smallest organisation."""
    keys = [c for c in ("state", "side") if c in members.columns] + ["user_id"]
    named = members.dropna(subset=["user_id"])
    known = first_per_key(named.dropna(subset=["organization_id"]), keys, ["organization_id"])
    return named.select(*keys).distinct().join(known, keys, "left")


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join whose left side may hold a hot key, or many null keys.

    Adaptive execution splits a skewed partition by the tasks that wrote it, so one key's rows
    reach many tasks; it can do so where both sides come straight from a shuffle of the join. A hash
    of the key among the join keys makes that so even if a side is already grouped by the key. It is the first of them, as
    a sort compares the start of its first key as a number: a hash tells rows apart there, a state's name does not.
    """
    keys = [F.xxhash64(*[F.col(c) for c in on]).alias("_h"), F.col("*")]
    return left.select(*keys).join(right.select(*keys), ["_h", *on], how).drop("_h")


@dataclass(frozen=True)
class Pieces:
    """How a product join is cut: its result rows, and the pieces of each key with more than a task's share, by hash."""

    rows: int
    hot: dict[int, int]


def key_rows(df: DataFrame, on: list[str], rows: Column | None = None) -> DataFrame:
    """One side of a product join as `result_sizes` reads it: the hash of each row's key, and how many rows it stands for."""
    number = F.lit(1).cast("long") if rows is None else rows.cast("long")
    return df.select(F.xxhash64(*[F.col(c) for c in on]).alias("_h"), number.alias("_rows"))


def result_sizes(joins: dict[str, tuple[DataFrame, DataFrame]], task_rows: int = TASK_ROWS) -> dict[str, Pieces]:
    """The pieces of several product joins, counted in one pass over the keys of all their sides.

    A join is a pair of `key_rows`. Exact; only keys whose result exceeds a task's share reach the driver, at most
    one for every `task_rows` result rows.
    """
    sides = [side.select(F.lit(name).alias("join"), "_h", *[(F.col("_rows") if i == j else F.lit(0).cast("long")).alias(f"_{j}") for j in (0, 1)])
             for name, both in joins.items() for i, side in enumerate(both)]
    keys = reduce(DataFrame.unionByName, sides).groupBy("join", "_h").agg((F.sum("_0") * F.sum("_1")).alias("_n"))
    hot = F.when(F.col("_n") > task_rows, F.struct("_h", F.ceil(F.col("_n") / F.lit(float(task_rows))).cast("int").alias("pieces")))
    found = keys.groupBy("join").agg(F.sum("_n").alias("rows"), F.collect_list(hot).alias("hot")).collect()
    return {name: Pieces(0, {}) for name in joins} | {r.join: Pieces(r.rows, {h["_h"]: h.pieces for h in r.hot}) for r in found}


def product_join(left: DataFrame, right: DataFrame, on: list[str], spread: list[str], task_rows: int = TASK_ROWS,
                 sizes: Pieces | None = None) -> DataFrame:
    """Inner join of two sides that both hold many rows of a key, so that the result is much larger than the input.

    The join has as many tasks as its result asks for. A key whose result is more than a task's share is cut into
    pieces: the left rows go to a piece by a hash of the `spread` columns (never at random: a task that
    runs again must send its rows to the same place), the right rows to all pieces of their key. Lazy
    with `sizes` from `result_sizes`; without, one counting job runs at once.
    """
    if sizes is None:
        sizes = result_sizes({"join": (key_rows(left, on), key_rows(right, on))}, task_rows)["join"]
    parts = -(-sizes.rows // task_rows)
    if parts <= 1:
        return left.join(right, on)
    keys = list(on)
    if sizes.hot:
        pieces = _pieces_of(F.xxhash64(*[F.col(c) for c in on]), sizes.hot)
        left = left.withColumn("_piece", F.pmod(F.xxhash64(*spread), pieces).cast("int"))
        right = right.withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        keys.append("_piece")
    return left.repartition(parts, *keys).join(right.repartition(parts, *keys), keys).drop("_piece")


def _pieces_of(key: Column, hot: dict[int, int]) -> Column:
    """The pieces of a key's hash. Few keys are hot: the others leave at a set lookup."""
    of = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    return F.when(key.isin(*hot), F.element_at(of, key)).otherwise(1)


def duplicate_groups(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG-04: composite keys held by more than one row, with their size."""
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") > 1)
    )


def mark_duplicates(df: DataFrame, keys: dict[str, Column], name: str = "duplicate",
                    keep: list[str] = ()) -> DataFrame:
    """WIN-02, RUL-24: 'Yes' for rows whose composite key occurs more than once.

    Pre-aggregated and joined back instead of a window, so that a key held by a
    third of the rows is never sorted in one task.
    """
    cols = [f"_k{i}" for i in range(len(keys))]
    keyed = df.withColumns({
        c: F.coalesce(e.cast("string"), F.lit("")) for c, e in zip(cols, keys.values())
    })
    marked = skew_join(keyed, duplicate_groups(keyed, [*keep, *cols]), [*keep, *cols])
    flag = F.when(F.col("group_size") > 1, "Yes").otherwise("No")
    return marked.withColumn(name, flag).drop("group_size", *cols)


def ranked(df: DataFrame, by: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """SRT-01: adds each row's place (from 1) among the rows of the same `by`, in `order`.

    The table is sorted over ranges of (by, order), each range numbers its own rows, and the rows in the ranges
    before are added, so no task sees more than its range. `order` should end in a key, as equal rows cannot be
    split. Only rows per range and `by` reach the driver. Eager: the sorted ranges are stored with their numbers, so
    the rows are shuffled and sorted once.
    """
    dealt = df.repartitionByRange(*[F.col(c) for c in by], *order).sortWithinPartitions(*[F.col(c) for c in by], *order)
    # the id of a task and the number of a row in it
    at = F.monotonically_increasing_id()
    ranges = stage(dealt.withColumn("_at", at))
    ranges = ranges.withColumns({"_range": F.shiftright("_at", 33).cast("int"), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)})
    counts = ranges.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("count"), F.min("_at").alias("_first")).collect()
    before, seen = [], {}
    for row in sorted(counts, key=lambda r: r["_range"]):
        group = tuple(row[c] for c in by)
        before.append((*group, row["_range"], seen.get(group, 0) - row["_first"] + 1))
        seen[group] = seen.get(group, 0) + row["count"]
    starts = df.sparkSession.createDataFrame(before, ranges.select(*by, "_range").withColumn("_before", F.lit(0).cast("long")).schema)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*by, "_range")]
    placed = ranges.alias("l").join(F.broadcast(starts.alias("r")), reduce(lambda a, b: a & b, same))
    return placed.select(*[F.col(f"l.{c}").alias(c) for c in df.columns], (F.col("l._at") + F.col("_before")).alias(name))
