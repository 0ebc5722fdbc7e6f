"""Session settings and the shared folder used to cut lineage or stage tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "aerolake",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    ``master`` and ``shuffle_partitions`` are left to the cluster when None.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Read from the session; only a local-mode session without that setting
    gets a folder of its own (tests). On a cluster a machine-local folder
    would be lost with the host, so a missing setting is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return configured
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="aerolake-ckpt-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder; ``unique`` adds a fresh leaf.
    Paths without ``unique`` (fingerprint-keyed tables and models) are shared
    by every application that uses the same folder."""
    base = checkpoint_root(spark).rstrip("/")
    leaf = list(parts) + ([uuid.uuid4().hex] if unique else [])
    return "/".join([base, "aerolake", *leaf]) if leaf else base


def spread(df, min_partitions: int | None = None):
    """Give CPU-heavy per-row work (JSON parsing, tokenising) every core.

    A small input can arrive as one partition (one Parquet row group); it is
    then spread round-robin over ``min_partitions`` (default: the cluster's
    parallelism). A large input already has more partitions than cores and is
    returned unchanged, so no shuffle is added at scale.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (remote session): leave the plan as is
        return df
    return df.repartition(target) if current < target else df


class scan_split:
    """Scans planned inside give a task at most about this many bytes of files:
    ``with scan_split(spark, "16m"): model = pipeline.fit(df)``. For work that keeps
    what a task read (an iterative fit), so that the cluster's own, larger split
    does not decide how much that is."""

    KEY = "spark.sql.files.maxPartitionBytes"

    def __init__(self, spark: SparkSession, size: str):
        self.spark, self.size, self.old = spark, size, None

    def __enter__(self):
        self.old = self.spark.conf.get(self.KEY)
        self.spark.conf.set(self.KEY, self.size)
        return self

    def __exit__(self, *exc):
        self.spark.conf.set(self.KEY, self.old)
        return False


class state_partitions:
    """Start a stateful streaming query with its own partition count.

    A stateful query fixes its number of state partitions at its first start
    (it is kept in the checkpoint). Size it by the state it holds, not by the
    batch volume: ``with state_partitions(spark, n): query = writer.start()``.
    """

    def __init__(self, spark: SparkSession, n: int):
        self.spark, self.n, self.old = spark, int(n), None

    def __enter__(self):
        self.old = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", str(self.n))
        return self

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.shuffle.partitions", self.old)
        return False
