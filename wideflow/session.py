"""Session construction and the shared work folder.

On a cluster the session comes from the caller; ``get_session`` is for local runs,
tests and the benchmark. ``work_dir`` reads ``spark.checkpoint.dir`` from the
session and only sets a local one when none is configured (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections import defaultdict

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from real sizes, coalesces
# small shuffle partitions and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A list of keys reaches Parquet's statistics key by key, not as one range from the least to the greatest.
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",
    # The load stages fuse scan, lookups, key building and the accept filter
    # into one generated method that can exceed HotSpot's 8000-byte JIT limit;
    # uncompiled, it runs interpreted and 2-3x slower. Let the JIT compile it.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "wideflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("WIDEFLOW_DRIVER_MEMORY", "16g"))
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written tables.

    Uses the checkpoint folder the cluster names in ``spark.checkpoint.dir``.
    When it is unset, a scratch folder is created and set in local mode only: on
    a cluster each executor would write to its own disk, so that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="wideflow-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared work folder."""
    base = work_dir(spark).rstrip("/")
    path = f"{base}/wideflow/{name}-{uuid.uuid4().hex[:12]}"
    _USED[spark.sparkContext.applicationId].append(path)
    return path


# Paths handed out per application, so that ``release`` can remove them.
_USED: dict[str, list[str]] = defaultdict(list)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system API (any store Spark can write)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Remove every scratch folder this application got from ``fresh_path``.

    For the end of a job: results that are still to be read must have been
    written elsewhere.
    """
    for path in _USED.pop(spark.sparkContext.applicationId, []):
        remove_path(spark, path)
