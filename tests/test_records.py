"""Event files of any form, in one folder, whole or cut into blocks; schemas that grow at any depth."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sample import event

from cartpath.sources.evolution import SchemaConflict, merge_schemas, schema_ddl
from cartpath.sources.schemas import EVENT_DDL
from cartpath.streaming import ingest, records


def many(prefix, n):
    text = 'brace } in { a "text" \\'
    return [event(f"{prefix}{i:03d}", "01T10:00:00", "view", items=[("p", 1.0)], web={"webPageDetails": {"name": text}}) for i in range(n)]


FORMS = {
    "lines": lambda e: "\n".join(map(json.dumps, e)),
    "indented": lambda e: json.dumps(e, indent=2),
    "indented-4": lambda e: json.dumps(e, indent=4) + "\n",
    "compact": json.dumps,
    "one-a-line": lambda e: "[" + ",\n".join(map(json.dumps, e)) + "]",
    "joined": lambda e: json.dumps(e, indent=1).replace("},\n {", "}, {"),
    "objects": lambda e: "\n".join(json.dumps(x, indent=2) for x in e),
    "two-arrays": lambda e: json.dumps(e[:3], indent=2) + "\n\n" + json.dumps(e[3:], indent=2),
    "array-then-lines": lambda e: json.dumps(e[:-2], indent=2) + "\n" + "\n".join(map(json.dumps, e[-2:])),
}


def read_back(spark, schema, folder, checkpoint, **options):
    ingest.ingest_events(ingest.event_stream(spark, str(folder), **options), schema, str(checkpoint))
    events = spark.table(f"{schema}.events").select("_id", "web.webPageDetails.name", "_source_file").collect()
    return events, sorted(r[0] for r in spark.table(f"{schema}.events_quarantine").select("_corrupt_record").collect())


def test_every_form_in_one_folder(spark, schema, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    expected = {}
    for form, text in FORMS.items():
        made = many(f"{form}-", 11)
        (folder / f"{form}.json").write_text(text(made))
        expected |= {e["_id"]: f"{form}.json" for e in made}
    (folder / "empty.json").write_text("[]\n")
    (folder / "nothing.json").write_text("")
    events, rejected = read_back(spark, schema, folder, tmp_path / "cp")
    assert {r._id: r._source_file.rsplit("/", 1)[-1] for r in events} == expected and len(events) == len(expected)
    assert {r.name for r in events} == {'brace } in { a "text" \\'}
    assert rejected == []


def test_what_is_no_event_is_kept(spark, schema, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = many("a", 5)
    (folder / "trailing.json").write_text(json.dumps(good, indent=2) + "\ntrailing text\n" + '{"also": "none"}')
    (folder / "cut.json").write_text(json.dumps(many("b", 3), indent=2)[:-150])
    (folder / "lines.json").write_text("\n".join([json.dumps(many("c", 1)[0]), "half { an event", json.dumps(many("d", 1)[0]), "[1, 2]"]))
    (folder / "garbage.json").write_text("this is { no event")
    events, rejected = read_back(spark, schema, folder, tmp_path / "cp")
    assert {r._id for r in events} == {*(e["_id"] for e in good), "b000", "b001", "c000", "d000"}
    kept = [r for r in rejected if "b002" not in r]
    assert kept == sorted(["trailing text", '{"also": "none"}', "half { an event", "[1, 2]", "this is { no event"])
    assert sum('"_id": "b002"' in r for r in rejected) == 1


@pytest.mark.parametrize("hot_rows", [10**6, 20])
def test_a_large_array_is_cut_by_many_tasks(spark, tmp_path, hot_rows):
    """Blocks of a kilobyte: one array lies in over a hundred tasks, also in chunks of a few lines."""
    (tmp_path / "a.json").write_text(json.dumps(many("x", 200), indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        path, block = F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block")
        lines = spark.read.text(str(tmp_path / "a.json")).select("value", path, block)
        assert lines.rdd.getNumPartitions() > 50
        made = records.records(lines, hot_rows)
        decoded = records.decode_records(made, EVENT_DDL, "_corrupt_record", "_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r._id for r in decoded) == [f"x{i:03d}" for i in range(200)]
    assert {r._corrupt_record for r in decoded} == {None}


def test_an_element_without_end_is_left_line_by_line(spark, tmp_path):
    (tmp_path / "a.json").write_text("[\n" + json.dumps(many("x", 2)[0]) + ",\n{\n" + "\n".join(f'"k{i}": {i},' for i in range(300)))
    lines = spark.read.text(str(tmp_path / "a.json")).select("value", F.lit("p").alias("_path"), F.lit(0).alias("_block"))
    made = records.decode_records(records.records(lines, 20, 50), EVENT_DDL, "_corrupt_record", "_id").collect()
    assert [r._id for r in made if r._id] == ["x000"] and sum(r._id is None for r in made) == 301


def test_a_batch_that_runs_again_changes_nothing(spark, schema, tmp_path):
    rows = spark.createDataFrame([("1", None), ("2", None), (None, "bad")], "_id string, _corrupt_record string")
    landing = ingest.Landing(spark, schema)
    landing.grow(rows.schema)
    landing.add(rows.limit(1), "b-1")
    landing.add(rows, "b-1")
    assert spark.table(f"{schema}.events").count() == 1
    rows.write.parquet(f"{landing.folder}/_batch=b-2/_rejected=false")  # a batch that was lost before it was added
    assert spark.table(f"{schema}.events").count() == 1
    landing.add(rows, "b-2")
    assert spark.table(f"{schema}.events").count() == 3 and spark.table(f"{schema}.events_quarantine").count() == 1


def test_fields_grow_inside_structs_arrays_and_maps(spark, schema, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([event("1", "01T10:00:00", "view", items=[("p", 1.0)], environment={"type": "browser"})], indent=2))
    ingest.ingest_events(ingest.event_stream(spark, str(folder)), schema, str(tmp_path / "cp"))
    grown = EVENT_DDL.replace("deviceCategory:string", "deviceCategory:string, app:struct<version:string>")
    grown = grown.replace("quantity:int", "quantity:bigint, discount:double").replace("primary:boolean", "primary:boolean, since:string")
    later = event("2", "01T10:00:00", "view", environment={"type": "app", "app": {"version": "7"}})
    later["productListItems"] = [{"SKU": "q", "quantity": 2**40, "discount": 0.5}]
    later["identityMap"] = {"customerId": [{"id": "c", "since": "2020"}]}
    (folder / "b.json").write_text(json.dumps([later], indent=2))
    ingest.ingest_events(ingest.event_stream(spark, str(folder), schema=grown), schema, str(tmp_path / "cp"))
    columns = ["_id", "environment.app.version", "productListItems.quantity", "productListItems.discount", "identityMap['customerId'].since"]
    expected = [("1", None, [1], [None], [None]), ("2", "7", [2**40], [0.5], ["2020"])]
    assert sorted(map(tuple, spark.table(f"{schema}.events").selectExpr(*columns).collect())) == expected
    # An older producer goes on with the older schema.
    (folder / "c.json").write_text(json.dumps(event("3", "01T10:00:00", "view", items=[("p", 1.0)])))
    ingest.ingest_events(ingest.event_stream(spark, str(folder)), schema, str(tmp_path / "cp"))
    assert sorted(map(tuple, spark.table(f"{schema}.events").selectExpr(*columns).collect())) == [*expected, ("3", None, [1], [None], [None])]
    assert [t.name for t in spark.catalog.listTables(schema) if t.name.startswith("events_landing")] == ["events_landing_2"]


def test_a_type_conflict_is_refused_with_its_path(spark, schema, tmp_path):
    ingest.Landing(spark, schema).grow(spark.createDataFrame([], EVENT_DDL).schema)
    other = EVENT_DDL.replace("payments:array<struct<paymentType:string>>", "payments:array<struct<paymentType:int>>")
    before = spark.table(f"{schema}.events").schema
    with pytest.raises(SchemaConflict, match=r"commerce\.order\.payments\[\]\.paymentType: int does not fit string"):
        ingest.ingest_events(ingest.event_stream(spark, str(tmp_path), schema=other), schema, str(tmp_path / "cp"))
    assert spark.table(f"{schema}.events").schema == before


def test_merging_keeps_the_wider_type_and_odd_names(spark):
    known = T._parse_datatype_string("a int, `b c` struct<x: float, `y-z`: map<string, int>>, n void")
    given = T._parse_datatype_string("A bigint, `b c` struct<x: double, `y-z`: map<string, tinyint>, w: array<int>>, n string, new date")
    merged = merge_schemas(known, given)
    assert merged.simpleString() == "struct<a:bigint,b c:struct<x:double,y-z:map<string,int>,w:array<int>>,n:string,new:date>"
    assert spark.createDataFrame([], schema_ddl(merged)).schema == merged
    assert merge_schemas(given, known).fields[0].dataType == T.LongType()
    with pytest.raises(SchemaConflict, match="key"):
        merge_schemas(T._parse_datatype_string("m map<int, int>"), T._parse_datatype_string("m map<string, int>"))
