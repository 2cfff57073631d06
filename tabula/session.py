"""Session helpers.

The library never starts or configures a cluster; callers hand in a ready
``SparkSession``.  ``local_session`` exists for tests and the benchmark only.

Anything the library writes (round-trip files, lineage cuts) goes below the
shared folder named by ``spark.checkpoint.dir``.  That setting is read from
the session; a private folder is created only when it is unset *and* the
master is local (tests), never on a cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tabula", driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    """A local session configured like a small cluster: AQE on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, partition_bytes: int = 256 * 1024**2,
                 checkpoint_dir: str | None = None) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of input.

    * ``spark.sql.shuffle.partitions`` starts at one partition per
      ``partition_bytes`` of input (AQE coalesces small ones at run time), so a
      shuffle of the full width of the data still fits executor memory per
      task and spills rarely;
    * scans split files into ``partition_bytes`` pieces;
    * AQE with skew-join splitting is on, broadcasts stay at Spark's default
      threshold (the library broadcasts only checked or one-row sides);
    * ``spark.checkpoint.dir`` should name a shared folder (HDFS/S3/...).
    """
    parts = max(200, -(-int(input_bytes) // int(partition_bytes)))
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if checkpoint_dir:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    return conf


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Taken from ``spark.checkpoint.dir``.  If unset, a fresh private folder is
    made, but only on a local master; on a cluster a machine-local folder
    would be invisible to the other executors, so we refuse.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/...) before using operators that cut lineage or write scratch data")
    folder = tempfile.mkdtemp(prefix="tabula-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tabula-scratch/{name}-{uuid.uuid4().hex}"


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")



def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no plan needs any more."""
    if "/tabula-scratch/" not in path:
        raise ValueError(f"{path} is no scratch path")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
