"""Where lineage is cut: the shared folder comes from the session."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from cartpath.session import durable, shared_folder, work_path


def test_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert work_path(spark, "x").startswith(f"{named}/x-")
    assert durable(spark.range(3)).count() == 3
    assert named in spark.sparkContext.getCheckpointDir()


def test_a_cluster_without_the_setting_is_refused():
    context = SimpleNamespace(master="spark://host", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(conf={}, sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(cluster)


def test_times_are_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
