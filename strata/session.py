"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes
# (broadcast only when a side turns out small), coalesces small shuffle
# partitions and splits skewed ones.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


# Settings for a large cluster (1000 executors, ~100 TB inputs): start with
# many shuffle partitions and let AQE coalesce them to ~256 MB each, split
# scans into 256 MB splits, and treat a partition as skewed when it is 5x
# the median and over 1 GB. Runtime broadcast is capped at 64 MB: a side is
# broadcast only after its shuffle has shown it is that small.
CLUSTER_CONF = {
    **RUNTIME_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
}


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Apply runtime SQL settings to an existing session (e.g. CLUSTER_CONF)."""
    for k, v in conf.items():
        spark.conf.set(k, v)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "strata", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false"))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Only in a local session without the setting (unit tests) is a folder of
    our own chosen and registered: elsewhere executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root for one job's written tables."""
    return f"{shared_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"
