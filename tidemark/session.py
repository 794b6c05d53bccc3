"""SparkSession construction and the few session-level facts the operators rely on.

Everything here is plain Spark configuration: UTC session time, AQE on (runtime
coalescing, skew-join splitting, broadcast conversion based on *measured* shuffle
sizes), the RocksDB state store that ``transformWithState`` requires, and the UI
off. ``checkpoint_root`` reads the shared folder the cluster names in
``spark.checkpoint.dir``; only when that is unset (local tests) do we pick one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every session we build gets. They are safe on a cluster too: none of
# them pins memory or parallelism to this machine.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # transformWithState talks to its Python worker over a local socket; a unix
    # domain socket keeps that off TCP.
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the base configuration.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a cluster
    leave them ``None`` so the submitter's settings win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Runtime (SQL) settings the operators assume, for sessions we did not build."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    checkpoint_root(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Read from the session. Only for a local master, as in tests, and when it is unset do we choose a
    private folder and set it, so ``Dataset.checkpoint()`` works either way; a cluster
    must name a folder that all its machines share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Streaming checkpoints and materialised intermediate tables go here, never to
    a machine-local temp folder, so an executor loss cannot take them with it.
    """
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "tidemark", *parts, uuid.uuid4().hex])


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, whoever reads it, and safe from lost executors."""
    path = scratch_path(df.sparkSession, "kept", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_conf(total_cores: int, *, input_tb: float = 100.0) -> dict[str, str]:
    """Suggested settings for a large cluster (pass as ``extra`` to ``build_session``).

    * shuffle partitions: about 200 MB of shuffle per partition for the widest
      shuffle (the ``(key, block)`` row shuffle of the event columns), rounded up to
      a multiple of the core count; AQE coalesces small ones at runtime;
    * 256 MB scan splits and 256 MB AQE advisory size, so tasks stay spill-friendly;
    * skew join splitting on, at 5x the median and 512 MB;
    * scan blocks of 5M rows, and of 10M ids in arrival order, so a block fits a task
      whatever share of the rows its key holds.
    """
    est_shuffle_bytes = input_tb * 1e12 * 0.1  # the pruned event columns are about a tenth
    parts = max(total_cores, int(est_shuffle_bytes / 200e6))
    parts = ((parts + total_cores - 1) // total_cores) * total_cores
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.tidemark.scan.blockRows": "5000000",
        "spark.tidemark.scan.blockIds": "10000000",
        "spark.tidemark.streaming.shufflePartitions": str(total_cores),
    }


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench (``local[N]``)."""
    return build_session(master=f"local[{cores}]", shuffle_partitions=shuffle_partitions,
                         extra={"spark.driver.memory": os.environ.get("TIDEMARK_DRIVER_MEM", "16g")})
