"""Session construction and the shared scratch location.

Cluster deployments supply their own session; ``configure`` only fills in the
settings the library relies on (UTC session zone, AQE) and never overrides a
value that is already set explicitly by the cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library's semantics depend on.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Performance defaults; applied only where the session has no value of its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # streaming aggregation state (the hourly rollup) kept in RocksDB, off the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[8]", app: str = "kwpulse",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster use the provided session + ``configure``."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**REQUIRED_CONF, **DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the queries rely on; leave cluster-tuned values alone."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in DEFAULT_CONF.items():
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # some settings are static on a given deployment
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when nothing is configured (local tests) a
    fresh folder is created and registered, so a cluster run never falls back
    to a machine-local path silently.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):  # several JVMs share no folder
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster run needs a shared folder")
        d = tempfile.mkdtemp(prefix="kwpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/kwpulse/{name}-{uuid.uuid4().hex[:12]}"
