"""Session helpers: defaults for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", app: str = "quotefuse",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local jobs.

    On a cluster the deployment supplies master, memory, shuffle partitions
    and ``spark.checkpoint.dir``; nothing here overrides those.
    """
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         # error call-site capture costs ~4 extra py4j round trips per Column
         # call while a plan is built (3x the plan build time of wide plans)
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.sql.sources.partitionOverwriteMode", "dynamic"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch area the cluster names in spark.checkpoint.dir.

    Read from the session. Only a local session without one gets a fresh
    temporary folder; on a cluster that would be each machine's own disk, so
    there the setting is required.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines share (master {master})")
        d = tempfile.mkdtemp(prefix="quotefuse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    return f"{shared_dir(spark)}/quotefuse/{name}-{uuid.uuid4().hex[:12]}"
