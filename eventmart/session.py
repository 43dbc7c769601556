"""Session settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the library needs; all are session-scoped and safe to
# set on an existing session.
REQUIRED_CONF = {
    # Timestamps are event time in UTC; date/hour buckets depend on it.
    "spark.sql.session.timeZone": "UTC",
    # Upserts rewrite only the partitions they touch.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Sizing for large clusters (100 TB class).  The initial shuffle partition
# count is deliberately high; AQE coalesces it to ~advisory-size partitions
# at runtime, so small days stay small and big ones never exceed executor
# memory.  Scan splits of 256 MB keep tasks few without huge partitions.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # Broadcast only what AQE measured to be small at runtime.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


# The JVM compiles longer methods only with this option, which a running session cannot be given.
HUGE_METHODS = "-XX:-DontCompileHugeMethods"
METHOD_LIMIT = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def configure(spark: SparkSession) -> SparkSession:
    side = "driver" if spark.sparkContext.master.startswith("local[") else "executor"
    compiled = HUGE_METHODS in (spark.conf.get(f"spark.{side}.extraJavaOptions", None) or "")
    # Without the option a wide projection would run interpreted; under the limit Spark splits it into short methods.
    for key, value in (REQUIRED_CONF if compiled else REQUIRED_CONF | METHOD_LIMIT).items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = "local[*]", app: str = "eventmart", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """A session with the library's settings; ``cluster=True`` applies ``CLUSTER_CONF``
    (and leaves the master to spark-submit when ``master`` is None)."""
    builder = SparkSession.builder if master is None else SparkSession.builder.master(master)
    builder = (
        builder
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call-site capture for error messages walks the Python stack on every
        # Column call; jobs build plans with thousands of them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Checkpoints cut lineage before partition rewrites; drop them once unused.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    if cluster:
        for key, value in CLUSTER_CONF.items():
            builder = builder.config(key, value)
    # Wide projections compile to methods above the JIT's 8000-byte limit; let
    # the JIT compile them instead of interpreting them per row.
    java_opts = HUGE_METHODS
    extra = dict(extra or {})
    extra["spark.driver.extraJavaOptions"] = (java_opts + " " + extra.get("spark.driver.extraJavaOptions", "")).strip()
    extra["spark.executor.extraJavaOptions"] = (java_opts + " " + extra.get("spark.executor.extraJavaOptions", "")).strip()
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return configure(spark)


def state_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only when it is unset and the
    master is local (tests, laptops) a private temporary folder is created; on a
    cluster an unset value is an error because a node-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        root = tempfile.mkdtemp(prefix="eventmart-state-")
        sc.setCheckpointDir(root)
        return root
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused folder under the shared state root."""
    return f"{state_root(spark).rstrip('/')}/scratch/{tag}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage through a reliable checkpoint in the shared checkpoint folder.

    Used before a frame is written over the partitions it was read from, and
    for small intermediates that several branches read; a lost executor then
    never sends the job back to the original scan.  (Never a local checkpoint:
    executor-local blocks die with the executor.)
    """
    state_root(df.sparkSession)
    return df.checkpoint(eager=True)
