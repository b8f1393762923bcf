"""Session construction and shared scratch space."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "assetflow",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the settings the library is designed around.

    AQE re-plans joins and coalesces/splits shuffle partitions at run time; the
    session zone is UTC so windows and dates do not depend on the host.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.maxMetadataStringLength": "1000",  # plans name a scan's filters in full
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Hour windows and calendar dates are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is the shared store the cluster names. Only when nothing is
    configured (local tests) is a fresh local folder created and registered.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # the setting cannot change at run time; register a folder with the context
        root = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the checkpoint root for one run's tables."""
    return f"{checkpoint_root(spark)}/assetflow/{name}-{uuid.uuid4().hex[:12]}"


def scale_settings(total_cores: int, scan_split_bytes: int = 256 * 1024 * 1024,
                   shuffle_target_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Settings for a large cluster, to pass as ``build_session(extra=...)``.

    * shuffle partitions start at three per core; AQE then merges small ones
      toward ``shuffle_target_bytes`` and splits skewed ones, so the count does
      not have to be tuned per input size (the heavy shuffles here run after a
      partial aggregate, so they are far smaller than the input);
    * scan tasks read ``scan_split_bytes`` of Parquet each;
    * streaming state lives in RocksDB instead of the JVM heap.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(8, 3 * int(total_cores))),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_target_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
