"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# What the jobs rely on.  Sizes suit executors with a few GB per core.  The number of shuffle
# partitions is the caller's: set `spark.sql.shuffle.partitions` to a few times the cores, AQE
# merges what is too small and splits skewed joins.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def apply_cluster_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Put the recommended settings on a session builder."""
    for key, value in CLUSTER_SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def use_utc(spark: SparkSession) -> None:
    """Dates, hours and text forms of timestamps follow the session zone; all jobs pin UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder named in `spark.checkpoint.dir`.

    Every node must see it, so a machine-local folder is accepted in local mode only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every node can reach")
        root = tempfile.mkdtemp(prefix="txnlake-")
    app = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/txnlake/{app}/{label}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Set some session settings for the length of a `with` block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
