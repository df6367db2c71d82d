"""Streaming ingestion: each file once, rejects kept aside, batches without loss."""

from __future__ import annotations

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from sample import event

from cartpath.operators.events import flatten, with_lineage
from cartpath.sources.schemas import EVENT_DDL
from cartpath.sources.topics import decode_events
from cartpath.streaming import ingest


def land(folder: Path, name: str, events: list) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(events, indent=2))


def names(rows):
    return sorted(r._id for r in rows.select("_id").collect())


def test_array_files_restart_and_rejects(spark, schema, tmp_path):
    folder, checkpoint = tmp_path / "events", str(tmp_path / "checkpoint")

    def run():
        ingest.ingest_events(ingest.event_stream(spark, str(folder), multi_line=True), schema, checkpoint)
        return spark.table(f"{schema}.events"), spark.table(f"{schema}.events_quarantine")

    land(folder, "a.json", [event("1", "01T10:00:00", "page"), event("2", "01T10:00:01", "buy", items=[("p", 2.0)])])
    (folder / "broken.json").write_text("this is { no event")
    events, rejected = run()
    assert names(events) == ["1", "2"]
    assert [r._corrupt_record for r in rejected.collect()] == ["this is { no event"]
    assert {r._source_file.rsplit("/", 1)[-1] for r in events.collect()} == {"a.json"}

    events, rejected = run()
    assert names(events) == ["1", "2"] and rejected.count() == 1

    land(folder, "b.json", [event("3", "02T10:00:00", "view", unknown_field=1)])
    events, _ = run()
    assert names(events) == ["1", "2", "3"]
    assert "PartitionFilters: [isnotnull(_rejected" in events._jdf.queryExecution().executedPlan().toString()
    assert flatten(events).where("product_id = 'p'").count() == 1


def test_new_fields_are_added_to_the_table(spark, schema, tmp_path):
    folder, checkpoint = tmp_path / "events", str(tmp_path / "checkpoint")
    land(folder, "a.json", [event("1", "01T10:00:00", "page")])
    ingest.ingest_events(ingest.event_stream(spark, str(folder), multi_line=True), schema, checkpoint)
    land(folder, "b.json", [event("2", "01T10:00:00", "page", channel="app")])
    wider = ingest.event_stream(spark, str(folder), multi_line=True, schema=EVENT_DDL + ", channel string")
    ingest.ingest_events(wider, schema, checkpoint)
    assert {(r._id, r.channel) for r in spark.table(f"{schema}.events").collect()} == {("1", None), ("2", "app")}


def test_stream_failures_are_raised(spark, schema, tmp_path):
    folder = tmp_path / "events"
    land(folder, "a.json", [event("1", "01T10:00:00", "page")])
    failing = ingest.event_stream(spark, str(folder), multi_line=True).selectExpr("raise_error('boom') AS _id")
    with pytest.raises(Exception, match="boom"):
        ingest.ingest_events(failing, schema, str(tmp_path / "checkpoint"))


def test_an_old_file_that_arrives_late_is_read(spark, schema, tmp_path):
    folder, checkpoint = tmp_path / "events", str(tmp_path / "checkpoint")
    for name, id, time in (("new.json", "1", None), ("late.json", "2", 1_000_000_000)):
        land(folder, name, [event(id, "01T10:00:00", "page")])
        if time:
            os.utime(folder / name, (time, time))
        ingest.ingest_events(ingest.event_stream(spark, str(folder), multi_line=True), schema, checkpoint)
    assert names(spark.table(f"{schema}.events")) == ["1", "2"]


def test_topic_messages_to_files_of_at_most_100_events(spark, schema, tmp_path):
    made = [event(f"e{i:03d}", "01T10:00:00", "view", items=[("p", 1.0)], extra=i) for i in range(248)]
    texts = [json.dumps(e) for e in made[:200]] + [json.dumps(e, indent=2) for e in made[200:]]
    texts += ["this is\nno event", '{"also": "none"}']
    topic, out, checkpoint = (str(tmp_path / n) for n in ("topic", "out", "checkpoint"))

    def send(messages):
        rows = spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1)
        rows.select(F.encode("value", "UTF-8").alias("value")).write.mode("append").parquet(topic)

    def run():
        ingest.batch_events(spark.readStream.schema("value binary").parquet(topic), out, checkpoint)
        return [f.read_text().splitlines() for f in Path(out).rglob("*.txt")]

    send(texts)
    files = run()
    assert sorted(map(len, files)) == [50, 100, 100]
    assert {json.loads(line)["extra"] for f in files for line in f if "extra" in line} == set(range(248))
    assert sum(map(len, run())) == 250
    send([json.dumps(event("last", "01T10:00:00", "page")), None])
    assert sum(map(len, run())) == 251

    ingest.ingest_events(ingest.event_stream(spark, out), schema, str(tmp_path / "cp2"))
    assert names(spark.table(f"{schema}.events")) == [e["_id"] for e in made] + ["last"]
    rejected = spark.table(f"{schema}.events_quarantine").collect()
    assert {r._corrupt_record for r in rejected} == {"this is no event", '{"also": "none"}'}
    assert all(r._source_file.endswith(".txt") for r in rejected)


def test_undecodable_message_keeps_its_text(spark):
    row = decode_events(spark.createDataFrame([("no json",)], "value string")).first()
    assert row._id is None and row.web is None and row._corrupt_record == "no json"


def test_topic_straight_into_bronze(spark, schema, tmp_path):
    sent = spark.createDataFrame([(json.dumps(event("1", "01T10:00:00", "buy")),), ("garbage",)], "value string")
    sent.write.parquet(str(tmp_path / "topic"))
    messages = spark.readStream.schema("value string").parquet(str(tmp_path / "topic"))
    stream = with_lineage(decode_events(messages), F.lit("topic"))
    ingest.ingest_events(stream, schema, str(tmp_path / "checkpoint"))
    assert names(spark.table(f"{schema}.events")) == ["1"]
    assert [r._corrupt_record for r in spark.table(f"{schema}.events_quarantine").collect()] == ["garbage"]


def test_streams_share_a_folder_of_event_files(spark, tmp_path):
    for name in ("one", "two"):
        texts = [(json.dumps(event(f"{name}-{i}", "01T10:00:00", "page")),) for i in range(3)]
        spark.createDataFrame(texts, "value string").write.parquet(str(tmp_path / name))
    for name, checkpoint in (("one", "a"), ("two", "b"), ("two", "b")):
        messages = spark.readStream.schema("value string").parquet(str(tmp_path / name))
        ingest.batch_events(messages, str(tmp_path / "out"), str(tmp_path / checkpoint))
    lines = spark.read.option("recursiveFileLookup", True).text(str(tmp_path / "out")).collect()
    assert sorted(json.loads(r.value)["_id"] for r in lines) == [f"{n}-{i}" for n in ("one", "two") for i in range(3)]
