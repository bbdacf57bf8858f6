"""Session helpers.

The engine never owns the caller's session; ``build_session`` is a
convenience for tests, the bench and command-line use.  Shared scratch space
(reliable checkpoints, round-trip writes) always comes from the cluster's
``spark.checkpoint.dir``; a private directory is created only when that
setting is unset, which is the local/test case.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession

# Settings that matter at scale; every one is a stock Spark option.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # No Python call-site capture per Column call: several fewer JVM round trips
    # each, which dominates plan building for wide rule sets.  Errors keep their
    # messages, without the Python call site.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[*]", app_name: str = "dqflow", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; created privately only if none is set."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else "connect"
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Local runs and tests only: no cluster-wide folder was configured.
        configured = tempfile.mkdtemp(prefix="dqflow-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_dir(spark)


_SCRATCH: "weakref.WeakKeyDictionary[SparkSession, list[str]]" = weakref.WeakKeyDictionary()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/dqflow-{purpose}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this session has made and tell how many; call it when no result
    that was built from them will be read any more (a lazy result reads them when it runs)."""
    paths, gone = _SCRATCH.pop(spark, []), 0
    for path in paths:
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True))
    return gone
