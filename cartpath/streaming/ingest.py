"""Streaming ingestion of event files into bronze, and of topic messages into event files."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartpath.operators.events import with_lineage
from cartpath.sources.evolution import merge_schemas, same_types, schema_ddl
from cartpath.sources.schemas import CORRUPT, EVENT_DDL
from cartpath.sources.topics import decode_events
from cartpath.streaming.records import BLOCK, PATH, decode_records, records

# Fixed value: events per landing file. It is a parameter below: large streams want larger files.
EVENTS_PER_FILE = 100
FILES_PER_BATCH = 1_000
# Without it, a file that arrives with a time more than a week older than the newest is left out.
OLDEST_FILE = "36500d"

LANDING = "events_landing"
EVENTS = "events"
QUARANTINE = "events_quarantine"
REJECTED = "_rejected"
BATCH = "_batch"


@dataclass(frozen=True)
class EventFiles:
    """New lines of event files in any form, as a stream, with the schema of the events in them."""

    lines: DataFrame
    schema: str

    def decoded(self, lines: DataFrame) -> DataFrame:
        """The events of a batch of lines with lineage; what is no event is kept in ``_corrupt_record``."""
        return with_lineage(decode_records(records(lines), self.schema, CORRUPT, "_id"), F.col(PATH)).drop(PATH)

    def columns(self) -> T.StructType:
        none = self.lines.sparkSession.createDataFrame([], f"value string, {PATH} string")
        return with_lineage(decode_records(none, self.schema, CORRUPT, "_id"), F.col(PATH)).drop(PATH).schema


def event_stream(
    spark: SparkSession,
    folder: str,
    multi_line: bool | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    schema: str = EVENT_DDL,
) -> DataFrame | EventFiles:
    """New event files of a folder as a stream with lineage, for :func:`ingest_events`.

    By default a file may hold one event per line, or JSON arrays of events, indented or not, and one
    folder both; files of either form are split over tasks however large one is. With
    ``multi_line`` false every line is an event by itself, which saves looking for the form and gives a
    plain stream of events. With true a file is one JSON value, read by one task; of a file with
    several values only the first is read. What is no event is kept in ``_corrupt_record``.
    """
    reader = spark.readStream.options(
        maxFilesPerTrigger=files_per_batch, maxFileAge=OLDEST_FILE, recursiveFileLookup=True
    )
    path = F.col("_metadata.file_path")
    if multi_line:
        files = reader.schema(f"{schema}, {CORRUPT} string").json(
            folder, multiLine=True, columnNameOfCorruptRecord=CORRUPT
        )
        return with_lineage(files, path)
    lines = reader.text(folder).where(F.length(F.trim("value")) > 0)
    if multi_line is None:
        block = F.col("_metadata.file_block_start")
        return EventFiles(lines.select("value", path.alias(PATH), block.alias(BLOCK)), schema)
    lines = lines.select("value", path.alias(PATH))
    return with_lineage(decode_events(lines, schema, (PATH,)), F.col(PATH)).drop(PATH)


def finish(query: StreamingQuery) -> None:
    """Wait for a stream that ends by itself; raises what it failed with."""
    query.awaitTermination()
    failure = query.exception()
    if failure is not None:
        raise failure


class Landing:
    """The landing table of a schema: one folder, whose partitions are the batches written so far.

    A batch becomes visible when its partitions are added to the table, after its files are complete;
    one that is run again is written over, or left alone if it was added before. Accepted and
    rejected rows are partitions of their own, and ``events`` and ``events_quarantine`` are views of
    them, so a scan of either prunes the other. When the schema grows, in columns or inside structs, a
    table definition with the merged schema is put over the same files and the views change to it;
    older rows have NULL in what is new. A type that does not fit is refused before anything is
    written.
    """

    def __init__(self, spark: SparkSession, schema: str):
        self.spark, self.schema = spark, schema
        location = spark.catalog.getDatabase(schema).locationUri.rstrip("/")
        self.folder = f"{location}/{LANDING}"
        names = [t.name for t in spark.catalog.listTables(schema, f"{LANDING}*")]
        versions = [int(m[1] or 1) for n in names if (m := re.fullmatch(rf"{LANDING}(?:_(\d+))?", n))]
        self.version = max(versions, default=0)

    @property
    def table(self) -> str:
        return f"{self.schema}.{LANDING}" + (f"_{self.version}" if self.version > 1 else "")

    def partitions(self) -> list[str]:
        """The partitions as SQL text."""
        if not self.version:
            return []
        found = [dict(p.split("=") for p in row[0].split("/")) for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()]
        return [self._partition(p[BATCH], p[REJECTED]) for p in found]

    @staticmethod
    def _partition(batch: str, rejected: str) -> str:
        return f"PARTITION ({BATCH}='{batch}', {REJECTED}={rejected})"

    def grow(self, given: T.StructType) -> list[str]:
        """Let the table hold columns of the given schema as well; returns the columns that changed."""
        own = [T.StructField(BATCH, T.StringType()), T.StructField(REJECTED, T.BooleanType())]
        data = T.StructType([f for f in given.fields if f.name not in (BATCH, REJECTED)])
        if not self.version:
            changed = [f.name for f in data.fields]
            merged = data
        else:
            known = T.StructType([f for f in self.spark.table(self.table).schema.fields if f.name not in (BATCH, REJECTED)])
            merged = merge_schemas(known, data)
            before = {f.name: f.dataType for f in known.fields}
            changed = [f.name for f in merged.fields if f.name not in before or not same_types(before[f.name], f.dataType)]
        if changed:
            held, former = self.partitions(), self.table
            self.version += 1
            columns = schema_ddl(T.StructType([*merged.fields, *own]))
            self.spark.sql(f"CREATE TABLE {self.table} ({columns}) USING parquet PARTITIONED BY ({BATCH}, {REJECTED}) LOCATION '{self.folder}'")
            if held:
                self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {' '.join(held)}")
            self._set_views()
            if self.version > 1:
                self.spark.sql(f"DROP TABLE {former}")  # its definition: the files belong to the folder
        return changed

    def _set_views(self) -> None:
        columns = [c for c in self.spark.table(self.table).columns if c not in (BATCH, REJECTED)]
        events = ", ".join(f"`{c}`" for c in columns if c != CORRUPT)
        everything = ", ".join(f"`{c}`" for c in columns)
        views = {EVENTS: (events, f"NOT {REJECTED}"), QUARANTINE: (everything, REJECTED)}
        for name, (listed, which) in views.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.schema}.{name} AS SELECT {listed} FROM {self.table} WHERE {which}")

    def add(self, rows: DataFrame, batch: str) -> None:
        """Write one batch and add it to the table, unless it was added before."""
        mine = [self._partition(batch, flag) for flag in ("false", "true")]
        if mine[0] in self.partitions():
            return
        marked = rows.withColumn(REJECTED, F.col("_id").isNull())
        marked.write.mode("overwrite").partitionBy(REJECTED).parquet(f"{self.folder}/{BATCH}={batch}")
        self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {' '.join(mine)}")
        self.spark.catalog.refreshTable(self.table)


def _identity(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a stream, which it notes in its checkpoint before the first batch."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def ingest_events(stream: DataFrame | EventFiles, schema: str, checkpoint: str) -> None:
    """Append everything that has arrived to the landing table of bronze, each file once, then stop.

    The checkpoint makes a rerun add nothing and a restart go on where it stopped; several streams may
    feed one table.
    """
    files = stream if isinstance(stream, EventFiles) else None
    source = files.lines if files else stream
    spark = source.sparkSession
    landing = Landing(spark, schema)
    landing.grow(files.columns() if files else source.schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = files.decoded(batch) if files else batch
        landing.add(rows, f"{_identity(spark, checkpoint)}-{batch_id:010d}")

    finish(
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_event_files(events: DataFrame, folder: str, per_file: int = EVENTS_PER_FILE) -> None:
    """Events as JSON files, one event per line and at most ``per_file`` in a file; no exchange."""
    events.write.mode("overwrite").option("maxRecordsPerFile", per_file).json(folder)


DONE = "_done"


def _finished(spark: SparkSession, folder: str) -> bool:
    """Whether a batch was written into ``folder`` to its end, by the mark that is left after it."""
    try:
        return not spark.read.schema("batch bigint").parquet(f"{folder}/{DONE}").isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def batch_events(messages: DataFrame, folder: str, checkpoint: str, per_file: int = EVENTS_PER_FILE) -> None:
    """Write a stream of messages to event files, also the last ones that fill no whole file.

    The text of each message is kept as it is, on one line: line breaks only occur between the
    tokens of a JSON text. Nothing is parsed here; :func:`event_stream` does that once and
    quarantines what is no event. Each micro-batch has a folder of its own, below one that names the
    checkpoint's identity, so that streams may share ``folder``. A batch that is run again after it
    was finished is not written again, so a restart neither loses nor doubles a message.
    """
    spark = messages.sparkSession
    text = F.regexp_replace(F.col("value").cast("string"), r"[\r\n]+", " ")
    lines = messages.where(F.col("value").isNotNull()).select(text.alias("value"))

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{folder}/stream-{_identity(spark, checkpoint)}/batch-{batch_id:010d}"
        if not _finished(spark, target):
            batch.write.mode("overwrite").option("maxRecordsPerFile", per_file).text(target)
            spark.range(batch_id, batch_id + 1).toDF("batch").coalesce(1).write.mode("overwrite").parquet(f"{target}/{DONE}")

    finish(
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
