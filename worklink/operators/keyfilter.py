"""A broadcast filter of keys: which rows of a large table can meet a smaller one (RUL-02, JN-23).

The hashes of the smaller side's keys are aggregated into bitmaps, one bit each. A row whose bit is
not set meets nothing and never moves; the few others are joined exactly. The bitmaps are as large as the number of
keys asks for and never larger than `MOST_BITS`; beyond that more rows pass, and results stay the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16  # about one row in 16 passes that meets nothing
BUCKET_BITS = 32_768  # of one bitmap of the built-in aggregate: 4 kB
MOST_BITS = 1 << 27  # 16 MB: the bound of what is broadcast


@dataclass(frozen=True)
class KeyFilter:
    """Bitmaps (_bucket, _bits) over `size` hash places."""

    bitmaps: DataFrame
    size: int

    @classmethod
    def of(cls, keys: DataFrame, cols: Sequence[str], n_keys: int, most_bits: int = MOST_BITS) -> KeyFilter:
        """The filter of the keys in `cols`; `n_keys`, their number or a guess, only sets its size."""
        size = BUCKET_BITS
        while size < min(n_keys * BITS_PER_KEY, most_bits):
            size *= 2
        place = _place([F.col(c) for c in cols], size)
        rows = keys.select(_bucket(place).alias("_bucket"), _position(place).alias("_position"))
        return cls(rows.groupBy("_bucket").agg(F.bitmap_construct_agg("_position").alias("_bits")), size)

    def mark(self, df: DataFrame, cols: Sequence[Column], name: str) -> DataFrame:
        """Adds a boolean column: false only for rows whose key is not among the filter's."""
        placed = df.withColumn("_place", _place(cols, self.size))
        joined = placed.join(F.broadcast(self.bitmaps), _bucket(F.col("_place")) == F.col("_bucket"), "left")
        position = _position(F.col("_place")).cast("int")
        byte = F.conv(F.hex(F.substring("_bits", F.shiftright(position, 3) + 1, F.lit(1))), 16, 10).cast("int")
        bit = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), position.bitwiseAND(7)))
        return joined.withColumn(name, F.coalesce(bit > 0, F.lit(False))).drop("_place", "_bucket", "_bits")


def _place(cols: Sequence[Column], size: int) -> Column:
    return F.xxhash64(*cols).bitwiseAND(F.lit(size - 1))


def _bucket(place: Column) -> Column:
    return F.shiftright(place, 15).cast("int")


def _position(place: Column) -> Column:
    return place.bitwiseAND(BUCKET_BITS - 1)
