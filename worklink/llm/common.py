"""Helpers shared by the operators: scratch tables, batches of texts, bounded caches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; where it is unset, one next to the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch").rstrip("/")


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Queries inside the block delete their shuffle files at their end instead of when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result that is used several times as a table in the shared folder and read it.

    Losing an executor then costs a re-read. The planner knows the size of the
    table, so it broadcasts small ones by itself. The folder goes when the driver ends, the shuffle files of the
    write as soon as it is done: nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_cleared(spark):
        df.write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def released(*frames: DataFrame | None) -> None:
    """Delete tables that `stored` wrote, once everything that reads them has been written itself."""
    for df in frames:
        if df is not None and getattr(df, "stored_at", None):
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def short_batches(spark: SparkSession) -> None:
    """Documents are long rows: hand fewer of them to Python at a time than the default of 10,000."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that an operator reads, so other columns cannot clash."""
    short_batches(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def crc_mod(column: Column, divisor: int) -> Column:
    """crc32 of an id as text, modulo `divisor`; null for a null id."""
    return F.pmod(F.crc32(column.cast("string")), F.lit(divisor))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a batch's texts (null: empty) as one array, and the n + 1 offsets into it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    ends = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(ends) or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), ends - (ends[0] if len(ends) else 0)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def per_text(work: Callable[[str], tuple], schema: pa.Schema) -> Callable:
    """A `mapInArrow` function: (doc_id, text) rows to doc_id and the values `work` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [work(text or "") for text in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) or [()] * (len(schema) - 1)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(schema[0].type), *arrays], schema=schema)

    return run


class Recent(dict):
    """A bounded memo: two generations of at most `limit` entries, short keys only.

    A worker keeps it inside a broadcast value, so it outlives a task.
    """

    def __init__(self, make: Callable, limit: int = 200_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def keep_rows(docs: DataFrame, column: str, mask: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows, whole and unchanged, for whose values of `column` the mask is true; nothing is shuffled."""
    short_batches(docs.sparkSession)
    place = docs.columns.index(column)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(mask(batch.column(place)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
