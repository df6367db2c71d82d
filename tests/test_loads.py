"""Rejected CSV rows, loads at a time, strict funnel, quantile sketches."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F
from sample import event, flat_events

from cartpath.operators import funnel, skew
from cartpath.sources import files, tables
from cartpath.sources.versions import VersionedTable

DDL = "id int, amount double, name string"


def load(spark, schema, path, ddl=DDL):
    counts = files.load_counted(spark, str(path), f"{schema}.t", ddl)
    loaded = [(r.id, r.amount, r.name) for r in tables.scan(spark, f"{schema}.t").collect()]
    rejected = [r[0] for r in VersionedTable(spark, f"{schema}.t").rejects().select("_corrupt_record").collect()]
    return counts, sorted(loaded, key=str), sorted(rejected)


def test_rejected_rows_are_counted_and_kept(spark, schema, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,amount,name\n1,2.5,a\nx,1,b\n3,,\n4,5,c,too many\n5,1\n6,no,d\n7,1,"a, ""quoted"" one"\n')
    counts, loaded, rejected = load(spark, schema, path)
    assert counts == (3, 4)
    assert loaded == sorted([(1, 2.5, "a"), (3, None, None), (7, 1.0, 'a, "quoted" one')], key=str)
    assert rejected == sorted(["x,1,b", "4,5,c,too many", "5,1", "6,no,d"])
    assert tables.scan(spark, f"{schema}.t").columns == ["id", "amount", "name", "_ingested_at", "_source_file"]
    assert tables.write_history(spark, f"{schema}.t").first().rows == 3
    # Without a schema only the number of fields can be wrong.
    counts, loaded, rejected = load(spark, schema, path, None)
    assert counts == (5, 2) and rejected == ["4,5,c,too many", "5,1"]


def test_a_table_without_rejects(spark, schema, tmp_path):
    (tmp_path / "t.csv").write_text("id,amount,name\n1,2.5,a\n")
    assert load(spark, schema, tmp_path / "t.csv") == ((1, 0), [(1, 2.5, "a")], [])
    tables.write_table(spark.range(2), f"{schema}.plain")
    assert VersionedTable(spark, f"{schema}.plain").rejects().count() == 0


def test_line_breaks_are_found(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b\n1,"x ""y"" z"\n2,"plain"\n' * 50)
    (tmp_path / "two.csv").write_text('a,b\n1,"x\ny"\n')
    assert not files.breaks_lines(spark, str(tmp_path / "one.csv"))
    assert files.breaks_lines(spark, str(tmp_path / "two.csv"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
    try:
        assert files.read_csv(spark, str(tmp_path / "one.csv"), "a string, b string").rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_load_at_a_time(spark, schema, tmp_path, monkeypatch):
    for n in range(8):
        (tmp_path / f"f{n}.csv").write_text("id\n" + "\n".join(map(str, range(n))))
    names = {f"f{n}.csv": f"t{n}" for n in range(9)}
    original = files.load_counted

    def slow(*args):
        time.sleep(1.5)
        return original(*args)

    monkeypatch.setattr(files, "load_counted", slow)
    schemas = {f"t{n}": "id int" for n in range(9)} | {"t3": "id no_such_type"}
    started = time.monotonic()
    results = files.load_files(spark, str(tmp_path), schema, names, schemas, at_once=9).collect()
    elapsed = time.monotonic() - started
    assert [(r.file, r.status, r.rows) for r in results] == [
        (f"f{n}.csv", *(("failed", None) if n == 3 else ("skipped", None) if n == 8 else ("loaded", n))) for n in range(9)
    ]
    assert elapsed < 0.7 * sum(r.seconds for r in results)
    history = {r.table: r.n for r in spark.table(f"{schema}._load_history").groupBy("table").agg(F.count("*").alias("n")).collect()}
    assert history == {f"t{n}": 1 for n in range(8) if n != 3}


KINDS = ["page", "view", "add", "buy", "remove"]


def chains(events, within):
    """Steps that each session reaches, every chain of events tried."""
    reached = {}
    for session in {e["web"]["webSession"]["ID"] for e in events}:
        mine = sorted((e["timestamp"], e["_id"], e["eventType"]) for e in events if e["web"]["webSession"]["ID"] == session and e["timestamp"])
        alive, steps = [(t, i, t) for t, i, k in mine if k.endswith("pageViews")], 0
        for suffix in ("productViews", "productListAdds", "purchases", None):
            if not alive:
                break
            steps += 1
            alive = [
                (t, i, begun)
                for t, i, k in mine
                for pt, pi, begun in alive
                if suffix and k.endswith(suffix) and (pt, pi) < (t, i) and (within is None or int(t[8:10]) * 24 + int(t[11:13]) - int(begun[8:10]) * 24 - int(begun[11:13]) <= within)
            ]
        reached[session] = steps
    return [sum(s >= n for s in reached.values()) for n in (1, 2, 3, 4)], len(reached)


@pytest.mark.parametrize("within", [None, 5])
@pytest.mark.parametrize("limit", [None, 20])
def test_strict_funnel_tries_every_chain(spark, within, limit):
    rng = random.Random(3)
    events = []
    for i in range(400):
        e = event(f"e{i:03d}", f"{rng.randint(1, 2):02d}T{rng.randrange(24):02d}:00:00", rng.choice(KINDS), rng.choice(["hot", "hot", None, *(f"s{k}" for k in range(40))]))
        events.append(e if rng.random() < 0.95 else {**e, "timestamp": None})
    flat = flat_events(spark, events)
    hot = None if limit is None else skew.hot_keys(flat, ["session_id"], limit)
    found = funnel.strict_funnel(flat, within and within * 3600, hot).orderBy("funnel_step").collect()
    expected, total = chains(events, within)
    assert [r.sessions_entered for r in found] == expected
    assert found[3].overall_conversion_rate_pct == round(100 * expected[3] / total, 2)
    assert expected[0] > expected[1] > expected[2] >= expected[3] and (within or expected[3])


def test_a_purchase_alone_reaches_no_step(spark):
    flat = flat_events(spark, [event("1", "01T10:00:00", "buy"), event("2", "01T11:00:00", "page", session="s2"), event("3", "01T10:00:00", "view", session="s2")])
    assert [r.sessions_entered for r in funnel.strict_funnel(flat).orderBy("funnel_step").collect()] == [1, 0, 0, 0]
    assert [r.sessions_entered for r in funnel.strict_funnel(flat.where("false")).collect()] == [0] * 4


def test_sketches_of_days_merge(spark):
    rng = random.Random(6)
    values = [(day, int(rng.lognormvariate(6, 2))) for day in range(1, 29) for _ in range(rng.randint(200, 900))]
    rows = spark.createDataFrame(values, "day int, seconds bigint").selectExpr(
        "make_timestamp(2024, 1, day, 10, 0, 0) AS ts_page_view", "seconds AS seconds_page_view_to_purchase"
    )
    undone = rows.limit(5).withColumn("seconds_page_view_to_purchase", F.lit(None).cast("bigint"))
    sketches = funnel.step_time_sketches(rows.unionByName(undone), k=512).cache()
    for first, last in ((1, 28), (3, 3), (5, 20), (20, 28)):
        own = sorted(s for d, s in values if first <= d <= last)
        row = funnel.sketched_quantiles(sketches.where(F.dayofmonth("session_date").between(first, last))).first()
        assert row.journeys == len(own)
        for value, rank in ((row.median_sec_full_journey, 0.5), (row.p90_sec_full_journey, 0.9)):
            below, upto = sum(s < value for s in own), sum(s <= value for s in own)
            error = 2.3 / 512**0.9 * len(own) + 1
            assert below - error <= rank * len(own) <= upto + error
    assert funnel.sketched_quantiles(sketches.where("false")).count() == 0
