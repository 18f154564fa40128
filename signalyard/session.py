"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC session time (date truncation and
# window alignment must not depend on the host), AQE for runtime
# re-planning (coalescing, skew splits, broadcast conversion), and the
# Spark UI off (no listening port).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


TARGET_PARTITION_BYTES = 128 * 1024 * 1024

def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    Shuffle partitions: about one ``target_partition_bytes`` slice of input
    per partition, rounded up to whole waves of the cluster's cores (AQE
    then coalesces small ones and splits skewed ones); file splits of the
    same size; RocksDB for streaming state, which keeps large state off
    the JVM heap.  Pass the bytes that the job shuffles, where they are
    known to be fewer than its input (map output tracking grows with maps x
    reducers).  ``build_session(input_bytes=...)`` applies it."""
    cores = max(1, total_cores)
    waves = max(1, -(-input_bytes // (target_partition_bytes * cores)))
    return {
        "spark.sql.shuffle.partitions": str(waves * cores),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "signalyard", extra: dict | None = None,
                  input_bytes: int | None = None, total_cores: int = 8) -> SparkSession:
    """Local/test session. On a cluster, pass ``master=None`` and let the
    launcher supply master, memory and ``spark.checkpoint.dir``, and give
    ``input_bytes`` and ``total_cores`` to size the shuffles (cluster_conf)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if input_bytes is not None:
        conf.update(cluster_conf(input_bytes, total_cores))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


class NoSharedFolder(RuntimeError):
    """A cluster session without ``spark.checkpoint.dir``."""


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage, and it is an error
    if it did not: a folder on one machine would lose what other machines
    write.  In local mode (tests) an unset folder is a fresh scratch one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise NoSharedFolder(f"set spark.checkpoint.dir to a folder that all machines of {sc.master} share")
        d = tempfile.mkdtemp(prefix="signalyard-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their
    Python workers can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="signalyard-code-"), "signalyard_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("signalyard", os.path.relpath(path, here)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir, for written
    intermediate tables and stream checkpoints."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed
    once for all its readers, safe against lost executors, and with a size
    that Spark knows, so that it broadcasts the table if (and only if) the
    files are below ``spark.sql.autoBroadcastJoinThreshold``.  ``options`` are
    the writer's."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
