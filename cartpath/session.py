"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. Event times are UTC, so dates and whole-second
# differences must not depend on where the driver runs.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Only settable when a session starts. Recording the Python call site of every column expression
# doubles the time it takes to build a query.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(name: str = "cartpath", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys are given with ``__`` for each dot."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **START_SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall back to a
    temporary folder; on a cluster the setting has to be there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cartpath-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def work_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def durable(rows: DataFrame) -> DataFrame:
    """Cut the lineage of ``rows`` by a reliable checkpoint, which outlives lost executors."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` as a Parquet table in the shared folder: computed once, and not again when an executor is lost."""
    path = work_path(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
