"""Late events: after three batches every silver table is that of a rebuild."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from sample import event, flat_events

from cartpath.operators import funnel, journeys, sessions
from cartpath.plans.late import CUSTOMER_TABLES, SESSION_TABLES, LateSilver
from cartpath.sources.versions import BUCKET, VersionedTable

KINDS = ["page", "view", "add", "remove", "buy"]


def events(n=500, seed=8):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        session = rng.choice([None, "hot", *(f"s{k}" for k in range(70))])
        customer = rng.choice(["bot", None, *(f"c{k}" for k in range(25))])
        items = [(f"p{rng.randrange(9)}", rng.randrange(100) / 4)] if rng.random() < 0.8 else []
        made.append(event(f"e{i:04d}", f"{rng.randint(1, 9):02d}T{rng.randrange(24):02d}:00:00", rng.choice(KINDS), session, customer, items))
    return made


@pytest.fixture(scope="module")
def persons(spark):
    customers = spark.createDataFrame([(f"c{k}", f"c{k}", "city", "ST") for k in range(20)], "customer_id string, customer_unique_id string, customer_city string, customer_state string")
    orders = spark.createDataFrame([(f"o{k}", f"c{k % 7}", "delivered", "2024-01-02 00:00:00") for k in range(30)], "order_id string, customer_id string, order_status string, at string")
    return customers, orders.withColumn("order_purchase_timestamp", F.to_timestamp("at")).drop("at")


def texts(rows):
    names = sorted(c for c in rows.columns if c != "_ingested_at")
    return sorted(str(tuple(r)) for r in rows.select(*names).collect())


@pytest.mark.parametrize("hot_rows", [200_000, 15])
def test_late_batches_equal_a_rebuild(spark, schema, persons, hot_rows):
    made = events()
    silver = LateSilver(spark, schema, buckets=8, hot_rows=hot_rows)
    silver.publish(flat_events(spark, made[:400]), *persons)
    for batch in (made[400:440], made[440:441], made[441:]):
        silver.add(flat_events(spark, batch))
    flat = flat_events(spark, made).cache()
    whole = sessions.sessions(flat)
    ranked = journeys.ranked_sessions(whole)
    expected = {
        "sessions": whole,
        "session_products": sessions.session_products(flat),
        "session_events": sessions.session_events(flat),
        "funnel_step_times": funnel.funnel_step_times(flat),
        "funnel_metrics": funnel.funnel_metrics(whole),
        "funnel_daily": funnel.funnel_daily(whole),
        "customer_journeys": journeys.customer_journeys(ranked, *persons),
        "customer_journey_sessions": journeys.customer_journey_sessions(ranked),
    }
    for name, rows in expected.items():
        table = spark.table(f"{schema}.{name}")
        assert sorted(table.columns) == sorted(rows.columns), name
        assert texts(table) == texts(rows), name


def test_untouched_buckets_are_neither_read_nor_written(spark, schema, persons):
    made = events()
    silver = LateSilver(spark, schema, buckets=16)
    silver.publish(flat_events(spark, made[:-1]), *persons)

    def files(name):
        rows = VersionedTable(spark, f"{schema}.{name}").whole()
        return {f.split(f"{BUCKET}=")[1].split("/")[0]: f for f in rows.inputFiles()}, rows

    before = {name: files(name)[0] for name in (*SESSION_TABLES, *CUSTOMER_TABLES)}
    late = flat_events(spark, made[-1:])
    touched = silver.add(late)
    assert touched["session_buckets"] == 1 and 1 <= touched["customer_buckets"] <= 16
    mine = {str(b) for b in silver._buckets_of(late.select("session_id"))}
    for name in SESSION_TABLES:
        layers = VersionedTable(spark, f"{schema}.{name}").layers()
        assert len(layers) == 2 and len(layers[0].without) == 1
        written = spark.table(f"{schema}.{layers[1].table}")
        assert {str(r[0]) for r in written.select(BUCKET).distinct().collect()} <= mine
        assert set(before[name]) >= mine
    plan = silver.within("session_events", [3])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == plan.count("FileScan") and f"{BUCKET}#" in plan.split("PartitionFilters: [")[1]
    read = silver.within("session_events", [3]).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split(f"{BUCKET}=")[1].split("/")[0] for r in read} <= {"3"}


def test_nothing_late(spark, schema, persons):
    silver = LateSilver(spark, schema, buckets=2)
    flat = flat_events(spark, events(20))
    silver.publish(flat, *persons)
    assert silver.add(flat.limit(0)) == {"session_buckets": 0, "customer_buckets": 0}
    assert len(VersionedTable(spark, f"{schema}.sessions").layers()) == 1
