"""The shared work folder: required on a cluster, removed when released; size estimates without jobs."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from wideflow import session
from wideflow.sources.tables import scan_tasks, spread


def _fake(master, checkpoint=None):
    conf = SimpleNamespace(get=lambda *a: checkpoint if a[0] == "spark.checkpoint.dir" else None)
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf)
    return SimpleNamespace(sparkContext=sc, conf=conf)


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_folder_stops(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_dir(_fake(master))


def test_release_removes_scratch_folders(spark, monkeypatch):
    monkeypatch.setattr(session, "_USED", session.defaultdict(list))
    path = session.fresh_path(spark, "t-scratch")
    spark.range(5).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    session.release(spark)
    assert not os.path.exists(local)
    session.release(spark)


def test_spread_runs_nothing(spark):
    sc = spark.sparkContext
    sc.setJobGroup("spread-test", "spread")
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert scan_tasks(grouped) >= 1
    spread(grouped)
    assert list(sc.statusTracker().getJobIdsForGroup("spread-test")) == []
    sc.setLocalProperty("spark.jobGroup.id", None)
