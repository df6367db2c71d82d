"""Catalog tables: scans, writes with their row count, load history, counts, JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from cartpath.session import durable
from cartpath.sources.versions import Contract, VersionedTable, is_layer

JDBC_BATCH = 10_000


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{at}")


def scan(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """A table as it is now, or as it was in one of the versions that are kept."""
    return spark.table(table) if version is None else VersionedTable(spark, table).at(version)


def write_table(
    rows: DataFrame, table: str, mode: str = "overwrite", partition_by: tuple[str, ...] = (), contract: Contract | None = None
) -> int:
    """Write a table and return its rows, counted while they are written.

    Readers see all of the write or nothing of it, and a write that fails or breaks its ``contract``
    changes nothing. Overwriting replaces the schema too. The write is noted in the history table of
    the schema, and the last versions stay readable.
    """
    target = VersionedTable(rows.sparkSession, table)
    if mode == "append":
        return target.append(rows, contract)
    return target.overwrite(rows, partition_by, contract)


def upsert(changes: DataFrame, table: str, keys: Sequence[str], newest: str, partition: str) -> int:
    """Insert or update rows of a partitioned table by key; the row with the larger ``newest`` wins.

    A NULL key is a key like others, and a NULL ``newest`` is older than any other value. Of equally
    new rows a change wins, and of several changes the one with the largest values. Rows whose key is
    not in ``changes`` stay as they are, repeated ones included. Only partitions that hold a changed
    key, before or after, are read whole and written again, and all of them are replaced in one step.
    Returns the rows written.
    """
    spark = changes.sparkSession
    target = VersionedTable(spark, table)
    target.adopt()
    current = spark.table(table)
    columns = current.columns
    changed = changes.select(*keys).distinct().withColumnsRenamed({k: f"_{k}" for k in keys})
    same_key = reduce(lambda a, b: a & b, (current[k].eqNullSafe(changed[f"_{k}"]) for k in keys))
    held = current.join(changed, same_key, "left_semi")
    moved = changes.select(F.col(partition).alias("_at")).union(held.select(partition)).distinct()
    touched = durable(moved)
    untouched = current.join(touched, current[partition].eqNullSafe(touched["_at"]), "left_semi").join(
        changed, same_key, "left_anti"
    )
    # The newest row of a key is an aggregate, which combines any number of copies before its
    # exchange. A struct is never NULL, so undated rows take part.
    tie = [f.name for f in current.schema.fields if isinstance(f.dataType, AtomicType)]
    merged = (
        held.withColumn("_change", F.lit(False))
        .unionByName(changes.select(*columns, F.lit(True).alias("_change")))
        .groupBy(*(F.col(k).alias(f"_{k}") for k in keys))
        .agg(F.max_by(F.struct(*columns), F.struct(newest, "_change", *tie)).alias("_row"))
        .select("_row.*")
    )
    values = [row[0] for row in touched.toLocalIterator()]
    return target.replace_partitions(untouched.unionByName(merged), values, "upsert")


def write_history(spark: SparkSession, table: str) -> DataFrame:
    """The writes of one table, oldest first, numbered from 0."""
    return VersionedTable(spark, table).history().select("version", "written_at", "operation", "rows")


def count_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, all in one query."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def table_counts(spark: SparkSession, schema: str) -> DataFrame:
    """Row count of every table and view of a schema; layers count with the table they are part of."""
    names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary and not is_layer(t.name)]
    return count_rows({name: spark.table(f"{schema}.{name}") for name in names})


def read_jdbc(
    spark: SparkSession, url: str, table: str, split: tuple[str, int, int, int] | None = None, **options: str
) -> DataFrame:
    """A database table; ``split`` is (column, lowest, highest, partitions) for a parallel read."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split:
        column, low, high, partitions = split
        reader = reader.options(
            partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=partitions
        )
    return reader.load()


def write_jdbc(rows: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace a database table, in batches of 10,000 rows per statement."""
    rows.write.format("jdbc").mode("overwrite").options(
        url=url, dbtable=table, batchsize=JDBC_BATCH, **options
    ).save()
