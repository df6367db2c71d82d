"""CSV files to bronze tables, and the listing of a landing folder."""

from __future__ import annotations

import time
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpath.operators.events import with_lineage
from cartpath.sources.evolution import schema_ddl
from cartpath.sources.tables import ensure_schema
from cartpath.sources.versions import REJECTED, REJECTED_TEXT, VersionedTable

LOAD_RESULT = "file string, table string, status string, rows bigint, rejected bigint, error string, seconds double"


# How retail files quote. A quote in a quoted value is doubled, and blanks belong to the value.
QUOTING = {"header": "true", "quote": '"', "escape": '"'}


def breaks_lines(spark: SparkSession, path: str) -> bool:
    """Whether quoted values of a file go on over a line break: then some line has an odd number of quotes.

    The lines are looked at by as many tasks as the file has blocks.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTING["quote"]), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_csv(
    spark: SparkSession, path: str, schema: str | None = None, multi_line: bool | None = None, corrupt: str | None = None
) -> DataFrame:
    """A CSV file with a header. Without a schema, types are inferred, which reads the file once more.

    An empty value is NULL, quoted or not. Quoted values may hold line breaks; a file where some do
    (``multi_line``, found out by :func:`breaks_lines` if left out) is read by one task, any other is split
    over tasks. ``corrupt`` names a column for the text of rows that do not fit: those with another
    number of fields, or a value that is none of its type; it is NULL in all others.
    """
    multi_line = breaks_lines(spark, path) if multi_line is None else multi_line
    reader = spark.read.options(**QUOTING).option("multiLine", multi_line)
    if not schema:
        inferred = reader.option("inferSchema", True).csv(path)
        if not corrupt:
            return inferred
        schema = schema_ddl(inferred.schema)
    if not corrupt:
        return reader.schema(schema).csv(path)
    options = {"columnNameOfCorruptRecord": corrupt, "enforceSchema": "true"}
    return reader.options(**options).schema(f"{schema}, `{corrupt}` string").csv(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV files with a header that :func:`read_csv` reads back, blanks and line breaks included."""
    rows.write.options(**QUOTING, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def load_counted(
    spark: SparkSession, path: str, table: str, schema: str | None = None, multi_line: bool | None = None
) -> tuple[int, int]:
    """Replace a bronze table by a CSV file with lineage columns; returns the rows written and those rejected.

    Rejected rows are kept beside the table with the text of their line (``VersionedTable.rejects``).
    """
    source = F.lit(path.rstrip("/").rsplit("/", 1)[-1])
    rows = read_csv(spark, path, schema, multi_line, REJECTED_TEXT)
    marked = with_lineage(rows, source).withColumn(REJECTED, F.col(REJECTED_TEXT).isNotNull())
    return VersionedTable(spark, table).overwrite_accepted(marked)


def load_csv(
    spark: SparkSession, path: str, table: str, schema: str | None = None, multi_line: bool | None = None
) -> int:
    """:func:`load_counted`, giving the rows written alone."""
    return load_counted(spark, path, table, schema, multi_line)[0]


def load_files(
    spark: SparkSession,
    folder: str,
    target: str,
    files: Mapping[str, str],
    schemas: Mapping[str, str] | None = None,
    at_once: int = 4,
) -> DataFrame:
    """Load each file of ``files`` (file name to table) into schema ``target``, ``at_once`` of them at a time.

    Each file is a job of its own, so a small one does not wait for a large one before it. A missing file
    is skipped and a failing one does not stop the others; the result has one row per file, in the
    order given, with status ``loaded``, ``skipped`` or ``failed``, the rows loaded and rejected, and its
    own seconds. ``schemas`` gives a DDL per table.
    """
    ensure_schema(spark, target)

    def load(file: str, table: str) -> tuple:
        started = time.monotonic()
        rows = rejected = error = None
        try:
            rows, rejected = load_counted(spark, f"{folder}/{file}", f"{target}.{table}", (schemas or {}).get(table))
            status = "loaded"
        except AnalysisException as e:
            missing = e.getCondition() == "PATH_NOT_FOUND"
            status, error = ("skipped", "file not found") if missing else ("failed", str(e))
        except Exception as e:  # noqa: BLE001 - one bad file must not stop the others
            status, error = "failed", str(e)
        return file, table, status, rows, rejected, error, round(time.monotonic() - started, 3)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(lambda item: load(*item)), files.items()))
    return spark.createDataFrame(results, LOAD_RESULT)


def load_tally(results: DataFrame) -> DataFrame:
    """Files, rows and seconds per status."""
    sums = (F.sum(c).alias(c) for c in ("rows", "rejected", "seconds"))
    return results.groupBy("status").agg(F.count("*").alias("files"), *sums)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, modification time and length of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "modificationTime", "length")
    )
