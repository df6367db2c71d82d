"""Tables that change in one step and keep their earlier versions.

What a user reads is a view. Every write makes a table of its own (a layer) under a new name and then
replaces the view, which is one catalog operation: readers see the old rows or the new ones, and a write
that fails leaves nothing behind that anyone reads. A version is a list of layers. Overwriting starts
a new list, appending adds a layer, and replacing some partitions adds a layer with their rows and
leaves these partitions out of the layers before. Layers are plain Parquet tables of the catalog.
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartpath.sources.evolution import schema_ddl

HISTORY = "_load_history"
HISTORY_DDL = "table string, operation string, rows bigint, written_at timestamp, layers string"
# Versions that stay readable, the current one included.
KEPT_VERSIONS = 3
# With more layers than this a version is written anew as one.
MOST_LAYERS = 8
# A partition column that spreads rows for replacement alone; the view does not show it.
BUCKET = "_bucket"
# A partition column that tells rejected rows, with the text of each; the view shows the others alone.
REJECTED, REJECTED_TEXT = "_rejected", "_corrupt_record"
_LAYER = re.compile(r"__\d{6}_[0-9a-f]{8}$")
_PROPERTY = "layers"
_NOTING = threading.Lock()


@dataclass(frozen=True)
class Layer:
    """A table, and the partitions of it that a later layer has replaced (SQL literals)."""

    table: str
    without: tuple[str, ...] = ()


class ContractError(ValueError):
    """What a write was refused for, one line per breach."""


@dataclass(frozen=True)
class Contract:
    """What the rows of a table have to be: columns and types (DDL), columns without NULL, and keys no two rows share."""

    columns: str
    required: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()

    def misfits(self, schema: T.StructType) -> list[str]:
        """Columns that lack, are not declared, or have another type."""
        declared = T._parse_datatype_string(self.columns)
        given = {f.name: f.dataType.simpleString() for f in schema.fields}
        wanted = {f.name: f.dataType.simpleString() for f in declared.fields}
        lines = [f"column {n} is missing" for n in wanted if n not in given]
        lines += [f"column {n} is not declared" for n in given if n not in wanted]
        return lines + [f"column {n} is {given[n]}, not {k}" for n, k in wanted.items() if n in given and given[n] != k]

    def counts(self) -> list[Column]:
        """Metrics that ride on the write."""
        return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self.required]

    def breaches(self, metrics: dict, written: DataFrame) -> list[str]:
        """What is wrong with the rows that were written; only keys need a look at them."""
        lines = [f"{metrics[f'null_{c}']} rows have no {c}" for c in self.required if metrics[f"null_{c}"]]
        if self.keys:
            repeated = written.groupBy(*self.keys).agg(F.count("*").alias("_n")).where("_n > 1")
            row = repeated.agg(F.count("*").alias("n"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")).first()
            if row.n:
                lines.append(f"{row.n} keys ({', '.join(self.keys)}) are shared by {row.rows} rows")
        return lines


def is_layer(name: str) -> bool:
    return bool(_LAYER.search(name))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal(value, kind: T.DataType) -> str:
    return "NULL" if value is None else f"CAST({_quoted(str(value))} AS {kind.simpleString()})"


class VersionedTable:
    """One table of a schema, by its name ``schema.name``."""

    def __init__(self, spark: SparkSession, table: str, keep: int = KEPT_VERSIONS):
        self.spark, self.table, self.keep = spark, table, keep
        self.schema, self.name = table.rsplit(".", 1)

    # --- reading -----------------------------------------------------------------------------------

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def _is_view(self) -> bool:
        return self.exists() and self.spark.catalog.getTable(self.table).tableType == "VIEW"

    def layers(self) -> list[Layer]:
        """The layers of the current version."""
        if not self._is_view():
            return []
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.table}").where(F.col("key") == _PROPERTY).collect()
        return _read_layers(found[0]["value"]) if found else []

    def whole(self) -> DataFrame:
        """The rows of now with the bucket of each, by which a scan is pruned."""
        layers = self.layers()
        return self.spark.sql(self._select(layers, self._partition_of(layers), hidden=True))

    def history(self) -> DataFrame:
        """The writes, oldest first, numbered from 0; layers of the last ones can still be read."""
        writes = self.spark.table(f"{self.schema}.{HISTORY}").where(F.col("table") == self.name)
        return writes.withColumn("version", F.row_number().over(Window.partitionBy("table").orderBy("written_at")) - 1)

    def at(self, version: int) -> DataFrame:
        """The rows of an earlier version."""
        found = self.history().where(F.col("version") == version).select("layers").collect()
        if not found or not found[0]["layers"]:
            raise LookupError(f"{self.table} has no version {version}")
        layers = _read_layers(found[0]["layers"])
        lost = [layer.table for layer in layers if not self.spark.catalog.tableExists(f"{self.schema}.{layer.table}")]
        if lost:
            raise LookupError(f"version {version} of {self.table} is older than the versions that are kept")
        return self.spark.sql(self._select(layers, self._partition_of(layers)))

    # --- writing -----------------------------------------------------------------------------------

    def overwrite(self, rows: DataFrame, partition_by: Sequence[str] = (), contract: Contract | None = None) -> int:
        layer, n = self._write(rows, partition_by, contract)
        self._switch([layer], "overwrite", n)
        return n

    def overwrite_accepted(self, rows: DataFrame) -> tuple[int, int]:
        """Overwrite by rows with REJECTED and REJECTED_TEXT; returns how many were accepted and how many rejected.

        Both kinds are written and counted in one pass.
        """
        layer, seen = Layer(self._new_name()), Observation()
        flagged = F.count_if(F.col(REJECTED))
        counted = rows.observe(seen, (F.count(F.lit(1)) - flagged).alias("accepted"), flagged.alias("rejected"))
        counted.write.partitionBy(REJECTED).saveAsTable(f"{self.schema}.{layer.table}")
        counts = seen.get
        self._switch([layer], "overwrite", counts["accepted"])
        return counts["accepted"], counts["rejected"]

    def append(self, rows: DataFrame, contract: Contract | None = None) -> int:
        """Add rows; a table that does not exist yet begins with them."""
        held = self.adopt()
        partition = self._partition_of(held)
        layer, n = self._write(rows, (partition,) if partition else (), contract, held)
        self._switch(self._compacted([*held, layer]), "append", n)
        return n

    def replace_partitions(
        self, rows: DataFrame, values: Iterable, operation: str = "replace", contract: Contract | None = None
    ) -> int:
        """Put ``rows`` in place of the partitions with the given values.

        The rows may be made from the table itself. They must lie in these partitions; one that gets no
        rows is empty afterwards. Files of other partitions are neither read nor written.
        """
        held = self.adopt()
        partition = self._partition_of(held)
        kind = self.spark.table(f"{self.schema}.{held[0].table}").schema[partition].dataType
        gone = tuple(_literal(v, kind) for v in values)
        layer, n = self._write(rows, (partition,), contract, held)
        kept = [Layer(x.table, tuple(dict.fromkeys((*x.without, *gone)))) for x in held]
        self._switch(self._compacted([*kept, layer]), operation, n)
        return n

    # --- how ---------------------------------------------------------------------------------------

    def adopt(self) -> list[Layer]:
        """The layers of now; a plain table of this name becomes the first layer, once.

        A partitioned one is copied for that, since not every catalog takes the places of partitions
        along when a table is renamed.
        """
        if self.exists() and not self._is_view():
            layer = Layer(self._new_name())
            partition = next((c.name for c in self.spark.catalog.listColumns(self.table) if c.isPartition), None)
            if partition:
                self.spark.table(self.table).write.partitionBy(partition).saveAsTable(f"{self.schema}.{layer.table}")
                self.spark.sql(f"DROP TABLE {self.table}")
            else:
                self.spark.sql(f"ALTER TABLE {self.table} RENAME TO {self.schema}.{layer.table}")
            self._set_view([layer])
        return self.layers()

    def _new_name(self) -> str:
        numbers = [int(layer.table[-15:-9]) for layer in self.layers()]
        return f"{self.name}__{max(numbers, default=0) + 1:06d}_{uuid.uuid4().hex[:8]}"

    def _write(
        self, rows: DataFrame, partition_by: Sequence[str], contract: Contract | None, beside: Sequence[Layer] = ()
    ) -> tuple[Layer, int]:
        misfits = contract.misfits(rows.schema) if contract else []
        if beside:
            known = self.spark.table(f"{self.schema}.{beside[0].table}").schema
            columns = schema_ddl(known)
            misfits += [m for m in Contract(columns).misfits(rows.schema) if m not in misfits]
        if misfits:
            raise ContractError("\n".join(misfits))
        layer, seen = Layer(self._new_name()), Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *(contract.counts() if contract else []))
        writer = counted.write.partitionBy(*partition_by) if partition_by else counted.write
        writer.saveAsTable(f"{self.schema}.{layer.table}")
        metrics = seen.get
        breaches = contract.breaches(metrics, self.spark.table(f"{self.schema}.{layer.table}")) if contract else []
        if breaches:
            self.spark.sql(f"DROP TABLE {self.schema}.{layer.table}")
            raise ContractError("\n".join(breaches))
        return layer, metrics["rows"]

    def _partition_of(self, layers: Sequence[Layer]) -> str | None:
        if not layers:
            return None
        columns = self.spark.catalog.listColumns(f"{self.schema}.{layers[0].table}")
        return next((c.name for c in columns if c.isPartition), None)

    def rejects(self) -> DataFrame:
        """The rows of now that a load has rejected, with their text."""
        layers = self.layers()
        whole = self.spark.sql(self._select(layers, self._partition_of(layers), hidden=True))
        return whole.where(REJECTED).drop(REJECTED) if REJECTED in whole.columns else whole.where("false")

    def _select(self, layers: Sequence[Layer], partition: str | None, hidden: bool = False) -> str:
        names = self.spark.table(f"{self.schema}.{layers[0].table}").columns
        split = partition == REJECTED
        unseen = {BUCKET, *((REJECTED, REJECTED_TEXT) if split else ())}
        columns = ", ".join(f"`{c}`" for c in names if hidden or c not in unseen)
        accepted = f"NOT `{REJECTED}`" if split and not hidden else ""
        parts = []
        for layer in layers:
            conditions = [accepted] if accepted else []
            if layer.without:
                without = [f"`{partition}` IS NULL"] if "NULL" in layer.without else []
                values = [v for v in layer.without if v != "NULL"]
                without += [f"coalesce(`{partition}` IN ({', '.join(values)}), false)"] if values else []
                conditions.append(f"NOT ({' OR '.join(without)})")
            kept = f" WHERE {' AND '.join(conditions)}" if conditions else ""
            parts.append(f"SELECT {columns} FROM {self.schema}.{layer.table}{kept}")
        return " UNION ALL ".join(parts)

    def _set_view(self, layers: Sequence[Layer]) -> None:
        noted = _quoted(_write_layers(layers))
        select = self._select(layers, self._partition_of(layers))
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.table} TBLPROPERTIES ('{_PROPERTY}' = {noted}) AS {select}")

    def _compacted(self, layers: list[Layer]) -> list[Layer]:
        if len(layers) <= MOST_LAYERS:
            return layers
        partition = self._partition_of(layers)
        whole = self.spark.sql(self._select(layers, partition, hidden=True))
        return [self._write(whole, (partition,) if partition else (), None)[0]]

    def _switch(self, layers: list[Layer], operation: str, rows: int) -> None:
        self.adopt()
        self._set_view(layers)
        note_write(self.spark, self.table, operation, rows, _write_layers(layers))
        self._forget()

    def _forget(self) -> None:
        """Drop the layers that only versions older than the kept ones have."""
        writes = self.history().where("layers IS NOT NULL").orderBy(F.desc("version")).limit(4 * self.keep).collect()
        named = [{layer.table for layer in _read_layers(w["layers"])} for w in writes]
        kept = set().union(*named[: self.keep])
        for layer in sorted(set().union(*named) - kept):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.schema}.{layer}")


def _write_layers(layers: Sequence[Layer]) -> str:
    return json.dumps([[x.table, *x.without] for x in layers])


def _read_layers(text: str) -> list[Layer]:
    return [Layer(table, tuple(without)) for table, *without in json.loads(text)]


def note_write(spark: SparkSession, table: str, operation: str, rows: int | None, layers: str | None = None) -> None:
    """Append one row to the load history of the table's schema."""
    schema, name = table.rsplit(".", 1)
    entry = spark.createDataFrame([(name, operation, rows, layers)], "table string, operation string, rows bigint, layers string")
    noted = entry.withColumn("written_at", F.current_timestamp()).select("table", "operation", "rows", "written_at", "layers")
    with _NOTING:  # two appends to one Parquet table at a time would undo each other
        noted.coalesce(1).write.mode("append").saveAsTable(f"{schema}.{HISTORY}")
