"""Shared storage for results that are read more than once."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share; a session without one (a test) gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="riskloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to shared storage and read back: later steps don't compute it again, and lost executors don't lose it."""
    return stored_at(df, fresh_path(df.sparkSession, name))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """``stored`` at a path that the caller can give to ``removed``."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, *paths: str) -> None:
    """Delete what ``stored_at`` wrote there: for results that no later step reads, also none that is tried again."""
    for path in (spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch of whole texts.
BATCH = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH`` bytes where the session leaves their size at Spark's 64 MiB: a worker holds several copies of one."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name).removesuffix("b") == str(64 << 20):
        spark.conf.set(name, str(BATCH))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``, the place of each row in a total order from 0: ranges are sorted apart and counted, not gathered."""
    part = free_name(df, "_part")
    parted = stored(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "numbered")
    rows = parted.groupBy(part).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(part, F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    return parted.withColumn(name, place).join(rows, part).withColumn(name, F.col("_before") + F.col(name)).drop(part, "_before")
