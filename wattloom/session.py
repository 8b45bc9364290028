"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR_CONF = "spark.checkpoint.dir"

# Only settings that results depend on (time zone, ANSI) or that let Spark size
# shuffles and split skewed partitions itself. Nothing here fixes a partition
# count: AQE coalesces the initial number down to the data.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark estimates a parquet table by its compressed bytes. Decoded, columns of
    # readings take several times that; without the factor a fact table just under
    # the broadcast threshold is collected on the driver as a hash table.
    "spark.sql.sources.fileCompressionFactor": "5.0",
    # Shuffled days and months of buildings repeat themselves and grow about twentyfold as
    # rows of a hash table. AQE cuts partitions at this size, whatever the input; with 64 MB
    # an aggregation task would hold more than a gigabyte.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Layers are written several times over between raw and published.
    "spark.sql.parquet.compression.codec": "zstd",
    # A task that writes by month keeps the files of a year open instead of sorting its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on in an existing session."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wattloom")
        .config("spark.driver.memory", os.environ.get("WATTLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="wattloom-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for staged data that every executor can reach.

    The root is the folder the cluster names in ``spark.checkpoint.dir``. Only a
    local-mode session without that setting gets a temporary folder of its own;
    on a cluster a machine-local folder would be lost with its executor.
    """
    root = spark.conf.get(CHECKPOINT_DIR_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_DIR_CONF} must name a shared folder on a cluster"
            )
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of staged or outdated data, on any file system Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
