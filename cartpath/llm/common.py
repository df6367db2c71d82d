"""Small helpers that several operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpath import session
from cartpath.session import configure, work_path

__all__ = ["body", "durable", "longs", "read_table", "ready", "release", "rows_of", "work_path", "written"]
# What is exchanged for a table that is then written is of no use to anything else.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ready(spark: SparkSession) -> SparkSession:
    """Set the session up, and let Python workers import this package from where the driver found it.

    On a cluster that has the package in another place, or ships it with ``--py-files``, that place is found as well.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    return configure(spark)


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The given columns of one table; other columns never reach a plan."""
    return ready(spark).read.parquet(f"{folder}/{name}.parquet").select(*columns)


def body(text: str = "text"):
    """A text column as UTF-8 bytes, null as empty: bytes that are not UTF-8 then pass through Arrow unharmed."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


@contextmanager
def _cleaning(spark: SparkSession) -> Iterator[None]:
    """Plans made in here leave no exchanged files once they have run; Spark else keeps them until the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` as a Parquet table in the shared folder: computed once, and not again when an executor is lost."""
    spark = rows.sparkSession
    path = work_path(spark, purpose)
    with _cleaning(spark):
        rows.write.parquet(path)
    table = spark.read.schema(rows.schema).parquet(path)
    table._written_at = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete the files of tables that :func:`written` gave, once all that reads them has itself been written."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._written_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def durable(rows: DataFrame) -> DataFrame:
    """Cut the lineage of ``rows`` by a reliable checkpoint, which outlives lost executors."""
    with _cleaning(rows.sparkSession):
        return session.durable(rows.select("*"))


def longs(values: np.ndarray) -> pa.Array:
    """64-bit patterns as an Arrow array of signed longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def rows_of(batches: Iterator[pa.RecordBatch], size: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``size`` rows, so that what is derived from a slice stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


Query = Callable[[SparkSession, str], DataFrame]
