"""Session settings the library relies on."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # projections wider than this compile to many small methods instead of one stage
    # method, which for flattened documents would exceed the JVM's limit
    "spark.sql.codegen.maxFields": "60",
    # the JVM interprets a method beyond this many bytes of code for ever: such stages, too, take small methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # JSON with a repeated key: the last one wins
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that lacks them.

    They hold for the whole session: a precondition of the library, which an application
    may as well set itself when it builds the session.
    """
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def case_sensitive(spark: SparkSession):
    """Column names that differ by case only are different ones inside the block."""
    key = "spark.sql.caseSensitive"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("worklink")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("WORKLINK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, which need not have it installed. Call it once per session on a cluster.

    Functions travel with a job by themselves; values that are broadcast as objects of the package's classes do not.
    """
    package, held = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    path = f"{scratch(spark, 'package')}/{package.name}.zip"  # in the shared folder, where executors fetch it
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(jvm_path, True)
    out.write(bytearray(held.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(path)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; where none is named, one in the warehouse, which executors share too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder; it goes when the driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def stage(df: DataFrame) -> DataFrame:
    """Materialise a result that is used several times, as a table in the shared checkpoint folder.

    Losing an executor costs a re-read and never a re-run of the steps above, and the planner knows
    the table's size, so it broadcasts small ones by itself.
    """
    path = scratch(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_setting(spark: SparkSession, key: str) -> int:
    """A setting such as 10485760b, 10m or -1 in bytes."""
    text = spark.conf.get(key).strip().lower().removesuffix("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    return int(text[:-1]) * scale[text[-1]] if text[-1:] in scale else int(text)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder, or anything a pattern names, is there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jvm_path))


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one where there is none yet."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
