"""From landing files to gold tables, with the invariants that hold over all layers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartpath.plans.publish import Publisher
from cartpath.sources import testtables as given
from cartpath.sources.tables import ensure_schema, write_table
from cartpath.streaming import ingest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=[200_000, 5])
def published(spark, tmp_path_factory, request):
    base = tmp_path_factory.mktemp("publish")
    names = {layer: f"{layer}_{request.param}" for layer in ("bronze", "silver", "gold")}
    for name in names.values():
        ensure_schema(spark, name, str(base / name))
    ingest.write_event_files(given.bronze_events(spark, FOLDER).drop("_ingested_at", "_source_file"), str(base / "in"))
    ingest.ingest_events(ingest.event_stream(spark, str(base / "in"), multi_line=False), names["bronze"], str(base / "cp"))
    for table in ("customers", "orders", "products"):
        write_table(getattr(given, table)(spark, FOLDER), f"{names['bronze']}.{table}")
    publisher = Publisher(spark, **names, hot_rows=request.param)
    written = publisher.publish_silver()
    written.update(publisher.publish_gold())
    yield lambda name, layer="silver": spark.table(f"{names[layer]}.{name}"), written
    for name in names.values():
        spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_counts_of_all_tables(published):
    table, written = published
    assert written["session_events"] == 1000 and written["sessions"] == 397
    assert written["funnel_step_times"] == 397 and written["funnel_metrics"] == 4
    assert written["customer_journeys"] == 150 and written["customer_journey_sessions"] == 397
    assert len(table("sessions").columns) == 17 and len(table("session_events").columns) == 13
    assert len(table("customer_journeys").columns) == 38 and len(table("customer_journey_sessions").columns) == 19
    assert written["sessions_by_stage"] == 4 and len(written) == 9 + 13


def test_invariants(published):
    table, _ = published
    sessions, trail, journeys = table("sessions"), table("session_events"), table("customer_journeys")
    assert sessions.agg(F.sum("total_events")).first()[0] == trail.count() == 1000
    numbering = trail.groupBy("session_id").agg(
        F.count("*").alias("n"), F.max("event_sequence_num").alias("top"), F.count_distinct("event_sequence_num").alias("d")
    )
    assert numbering.where("n != top OR n != d").count() == 0
    entered = [r.sessions_entered for r in table("funnel_metrics").orderBy("funnel_step").collect()]
    assert entered == sorted(entered, reverse=True)
    assert journeys.count() == journeys.select("customer_id").distinct().count()
    converting = sessions.where("purchases > 0").count()
    assert journeys.agg(F.sum("converting_sessions")).first()[0] == converting
    shares = table("sessions_by_stage", "gold").agg(F.sum("pct_of_sessions")).first()[0]
    assert abs(shares - 100) < 0.05
    daily = table("funnel_daily").agg(F.sum("total_sessions"), F.sum("purchases")).first()
    assert tuple(daily) == (397, converting)
