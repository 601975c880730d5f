"""SparkSession helpers.

The library never assumes it owns the session: the functions here either
build one (CLI, bench, tests) or read settings from the one they are given.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings our jobs rely on. Only runtime SQL confs are listed here, so they
# can also be applied to a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimension tables are broadcast only through broadcast_if_small(); the
    # planner's own threshold stays at Spark's default.
    # Partition overwrite modes are set per write, never for the session.
}


def build_session(
    app_name: str = "meterflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session configured for meterflow jobs.

    ``master`` is only set when given: on a cluster it comes from
    spark-submit. The UI stays off: no job here needs a web server.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(RUNTIME_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.execution.arrow.pyspark.enabled"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # The checkpoint folder is resolved lazily (ensure_checkpoint_dir) by the
    # steps that need one, so jobs without checkpoints run on any cluster.
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Pin the runtime confs on a session we did not build (idempotent).

    A single round trip reads all current values; only differing ones are set.
    """
    current = spark.conf.getAll if hasattr(spark.conf, "getAll") else None
    values = current if isinstance(current, dict) else {k: spark.conf.get(k, None) for k in RUNTIME_CONF}
    for k, v in RUNTIME_CONF.items():
        if values.get(k) != v:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


class CheckpointDirMissing(RuntimeError):
    pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is; if it is missing there, this raises instead of inventing a
    machine-local folder the executors could not see. A local temporary
    folder is only made for a ``local[...]`` master (tests, single-machine
    runs).
    """
    d = checkpoint_dir(spark)
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise CheckpointDirMissing(
                "set spark.checkpoint.dir to a folder on shared storage (HDFS, object store)")
        d = tempfile.mkdtemp(prefix="meterflow-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder.

    Used for staged writes, landed bronze files and streaming checkpoints, so
    every intermediate lives where all executors (and a restarted driver)
    can see it.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/meterflow/{name}-{uuid.uuid4().hex[:12]}"
