"""One-step replacement, earlier versions, contracts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartpath.sources import tables, versions
from cartpath.sources.versions import Contract, ContractError, VersionedTable


def layer_tables(spark, schema):
    return sorted(t.name for t in spark.catalog.listTables(schema) if versions.is_layer(t.name))


def ids(rows):
    return sorted(r.id for r in rows.select("id").collect())


def test_a_failed_write_leaves_the_old_rows(spark, schema):
    table = f"{schema}.things"
    tables.write_table(spark.range(5), table)
    failing = spark.range(9).withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="boom"):
        tables.write_table(failing, table)
    assert ids(tables.scan(spark, table)) == list(range(5))
    assert tables.write_table(spark.range(2), table) == 2
    assert ids(tables.scan(spark, table)) == [0, 1]


def test_a_reader_keeps_what_it_began_with(spark, schema):
    table = f"{schema}.things"
    tables.write_table(spark.range(5), table)
    reader = tables.scan(spark, table)
    tables.write_table(reader.where("id > 2"), table)  # made from the table itself
    assert ids(reader) == list(range(5))
    assert ids(tables.scan(spark, table)) == [3, 4]


def test_earlier_versions_stay_for_a_while(spark, schema):
    table = f"{schema}.things"
    for n in range(1, 7):
        tables.write_table(spark.range(n), table, "append" if n == 5 else "overwrite")
    history = tables.write_history(spark, table).orderBy("version").collect()
    assert [(r.version, r.rows) for r in history] == [(n - 1, n) for n in range(1, 7)]
    assert ids(tables.scan(spark, table, 5)) == list(range(6))
    assert ids(tables.scan(spark, table, 4)) == sorted([*range(4), *range(5)])
    assert ids(tables.scan(spark, table, 3)) == list(range(4))
    for version in (2, 0):
        with pytest.raises(LookupError, match="older than"):
            tables.scan(spark, table, version)
    with pytest.raises(LookupError, match="no version"):
        tables.scan(spark, table, 99)
    assert len(layer_tables(spark, schema)) == 3
    counts = {r.table_name: r.row_count for r in tables.table_counts(spark, schema).collect()}
    assert counts == {"things": 6, "_load_history": 6}


def test_many_layers_are_written_as_one(spark, schema):
    table = f"{schema}.things"
    for n in range(versions.MOST_LAYERS + 3):
        tables.write_table(spark.range(n, n + 1), table, "append")
    assert ids(tables.scan(spark, table)) == list(range(versions.MOST_LAYERS + 3))
    assert len(VersionedTable(spark, table).layers()) < versions.MOST_LAYERS


def test_partitions_are_replaced_and_others_not_read(spark, schema):
    table = f"{schema}.parts"
    rows = spark.range(12).withColumn("day", F.when(F.col("id") < 9, F.concat(F.lit("d'"), F.col("id") % 3)))
    tables.write_table(rows, table, partition_by=("day",))
    target = VersionedTable(spark, table)
    assert target.replace_partitions(spark.createDataFrame([(100, "d'1"), (101, None)], "id long, day string"), ["d'1", "d'2", None]) == 2
    assert ids(tables.scan(spark, table)) == [0, 3, 6, 100, 101]
    assert ids(tables.scan(spark, table, 0)) == list(range(12))
    plan = tables.scan(spark, table).where("day = \"d'0\"")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan

def test_a_plain_table_becomes_the_first_layer(spark, schema):
    table = f"{schema}.old"
    spark.range(3).write.saveAsTable(table)
    tables.write_table(spark.range(3, 5), table, "append")
    assert ids(tables.scan(spark, table)) == list(range(5))
    spark.range(2).withColumn("day", F.lit("a")).write.partitionBy("day").saveAsTable(f"{schema}.dated")
    tables.upsert(spark.createDataFrame([(1, "b"), (7, "b")], "id long, day string"), f"{schema}.dated", ["id"], "day", "day")
    assert sorted(map(tuple, tables.scan(spark, f"{schema}.dated").collect())) == [(0, "a"), (1, "b"), (7, "b")]


def test_contract(spark, schema):
    table = f"{schema}.held"
    contract = Contract("id bigint, name string", required=("id",), keys=("id",))
    good = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    assert tables.write_table(good, table, contract=contract) == 2

    def refused(rows, mode="overwrite"):
        with pytest.raises(ContractError) as error:
            tables.write_table(rows, table, mode, contract=contract)
        assert ids(tables.scan(spark, table)) == [1, 2]
        return str(error.value).split("\n")

    assert refused(spark.range(1).withColumn("other", F.lit(1))) == ["column name is missing", "column other is not declared"]
    assert refused(good.withColumn("id", F.col("id").cast("int"))) == ["column id is int, not bigint"]
    bad = spark.createDataFrame([(None, "a"), (4, "b"), (4, "c"), (None, "d"), (5, "e")], "id long, name string")
    assert refused(bad) == ["2 rows have no id", "2 keys (id) are shared by 4 rows"]
    with pytest.raises(ContractError, match="column more is not declared"):
        tables.write_table(good.withColumn("more", F.lit(1)), table, "append")
    assert len(layer_tables(spark, schema)) == 1
