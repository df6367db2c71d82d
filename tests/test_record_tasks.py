"""Lines of indented files over tasks: how many a task holds, and what is carried with each of them."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from cartpath.sources.schemas import EVENT_DDL
from cartpath.streaming import records


def lines_of(spark, files):
    """Lines (value, path, start of block) from texts by path, in one partition and in order."""
    rows = [(line, path, 0) for path, text in files for line in text.split("\n")]
    return spark.createDataFrame(rows, "value string, _path string, _block bigint").coalesce(1)


def array(name, n):
    return json.dumps([{"_id": f"{name}-{i}", "eventType": "view"} for i in range(n)], indent=2)


def test_more_lines_go_to_more_tasks(spark):
    few, many = (lines_of(spark, [(f"file-{k}", array(f"f{k}", 5)) for k in range(n)]) for n in (2, 60))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert records.records(few, lines_per_task=50).rdd.getNumPartitions() <= partitions + few.rdd.getNumPartitions()
    made = records.records(many, lines_per_task=50)
    held = made.groupBy(F.spark_partition_id()).count().collect()
    # 60 files of 22 lines, with 5 events and two brackets each: 27 tasks, of which hashing leaves some empty.
    assert made.rdd.getNumPartitions() >= 60 * 22 // 50 > partitions and max(row["count"] for row in held) <= 60
    assert sorted(r.value.count("_id") for r in made.collect()) == [0] * 120 + [1] * 300


def test_no_path_is_sorted_or_exchanged_with_a_line(spark):
    made = records.records(lines_of(spark, [(f"file-{k}", array(f"f{k}", 3)) for k in range(4)]))
    plan = made._jdf.queryExecution().executedPlan().toString()
    sorts = re.findall(r"Sort \[.*", plan)
    assert sorts and not any("_path" in line for line in sorts)
    assert not re.search(r"hashpartitioning\(_path", plan[plan.index("Window") :])


def test_files_over_the_limit_beside_small_ones(spark):
    files = [("large", array("l", 60)), *((f"small-{k}", array(f"s{k}", 2)) for k in range(30)), ("flat", '{"_id": "a"}\n{"_id": "b"}')]
    made = records.records(lines_of(spark, files), hot_rows=40, lines_per_task=40)
    found = records.decode_records(made, EVENT_DDL, "_corrupt_record", "_id").select("_id", "_path", "_corrupt_record").collect()
    expected = {(f"l-{i}", "large") for i in range(60)} | {(f"s{k}-{i}", f"small-{k}") for k in range(30) for i in range(2)}
    assert {(r._id, r._path) for r in found} == expected | {("a", "flat"), ("b", "flat")}
    assert len(found) == 122 and {r._corrupt_record for r in found} == {None}


def test_empty_lines_equal_files_and_absent_paths(spark):
    """Files of the same text stay apart; a line without a path is a record by itself; nothing comes of empty lines."""
    text = array("x", 2)
    made = records.records(
        lines_of(spark, [("a", text), ("b", text), (None, '{\n"_id": "n"\n}'), ("c", ""), ("d", "  \n\n"), ("e", "[\n]")]).unionByName(
            spark.createDataFrame([(None, "a", 0), (None, None, 0)], "value string, _path string, _block bigint")
        )
    )
    found = records.decode_records(made, EVENT_DDL, "_corrupt_record", "_id").collect()
    assert sorted((r._id, r._path) for r in found if r._id) == [("x-0", "a"), ("x-0", "b"), ("x-1", "a"), ("x-1", "b")]
    assert sorted(r._corrupt_record for r in found if not r._id) == sorted(["{", '"_id": "n"', "}"])
    assert {r._path for r in found if not r._id} == {None}
