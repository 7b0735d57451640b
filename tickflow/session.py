"""Session helpers: a tuned builder and the shared work folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS, S3, ...).  Only a local master (tests) may leave it unset; then one is
made under the system temp folder and removed when the process ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for an analytics session.  AQE coalesces the shuffle partitions at
# runtime, so ``shuffle_partitions`` is an upper bound sized for the cluster.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    master: str | None = None,
    app_name: str = "tickflow",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, replay files and stored tables.

    Reads ``spark.checkpoint.dir`` from the session.  Unset, a local session
    (tests) gets a folder of its own; any other raises, since executors on
    other machines cannot see a folder that only this one has.
    """
    configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            configured = tempfile.mkdtemp(prefix="tickflow-")
            atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared work folder for one run (nothing is made there yet)."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


MB = 1 << 20


def scale_conf(input_bytes: int, total_cores: int, state_partitions: int | None = None) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of parquet/Kafka input.

    * Scan splits: at least three waves of tasks over all cores, each split
      between 128 MB and 1 GB (100 TB on 4,000 cores -> 1 GB splits, ~100k
      tasks rather than ~800k at the 128 MB default).
    * Shuffle partitions: an upper bound of 3 per core; AQE coalesces them to
      ~128 MB each.  The window aggregates shuffle partial aggregates only, so
      post-shuffle data is small; the bound matters for the keyed-store reads.
    * Streaming state: the number of state partitions is frozen in the
      checkpoint at the first start, so it is set explicitly.
    """
    split = input_bytes // max(1, 3 * total_cores)
    split = min(max(split, 128 * MB), 1024 * MB)
    shuffle = max(8, 3 * total_cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.files.openCostInBytes": str(8 * MB),
        "spark.sql.shuffle.partitions": str(state_partitions or shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * MB),
    }
