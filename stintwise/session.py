"""Session helpers.

``local_session`` is for tests and the bench only; on a cluster the caller
owns the session.  Intermediate tables go to a fresh folder under the shared
directory that the cluster names in ``spark.checkpoint.dir``.  The library never
makes up such a directory: without the setting it raises one clear error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "stintwise", driver_memory: str = "8g",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """A local session; ``checkpoint_dir`` (a new temporary folder unless given) is its shared folder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="stintwise-local-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; an error if the session has none."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and "
                           "all executors share when the session is built")
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder under the shared directory; ``clear_scratch`` removes it."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    app = spark.conf.get("spark.app.id", "app")
    return f"{shared_dir(spark)}/stintwise-scratch/{app}"


def clear_scratch(spark: SparkSession) -> bool:
    """Remove the intermediate tables that this application wrote; results that read them must be done.

    True if there was anything to remove.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def reliable_checkpoint(df):
    """``df.checkpoint(eager=True)`` into the shared folder (never a local checkpoint)."""
    spark = df.sparkSession
    configured = shared_dir(spark)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server applies the setting itself
        sc = None
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return df.checkpoint(eager=True)


def materialize(df, name: str, compression: str | None = None):
    """Write ``df`` once as a parquet table in the shared folder and read it back.

    Cuts the lineage like a checkpoint; the table is columnar and its file
    sizes let the planner size joins against it.  The write runs at once, while
    the caller's plan is built.  ``compression`` is the session's unless given.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


STATUS_BYTES = 4 << 30      # driver memory that one shuffle's map statuses may take


def cluster_conf(input_bytes: int, total_cores: int, shuffled_bytes: int | None = None,
                 partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings for a large cluster, sized from the bytes the jobs read and shuffle.

    The shuffles carry a few columns after partial aggregation; ``shuffled_bytes`` is
    an eighth of the input unless given.  Shuffle partitions start at
    ``shuffled_bytes / partition_bytes`` (at least two per core) and AQE coalesces them
    at run time.  The status of one map task holds up to one bit per partition, so
    scan tasks and partitions are kept to ``STATUS_BYTES`` together; partitions then
    grow and spill, no work is left out.  Joins become broadcasts only by the size that AQE
    measures, not by that of compressed files.
    """
    shuffled_bytes = input_bytes // 8 if shuffled_bytes is None else shuffled_bytes
    scan_bytes = 2 * partition_bytes
    scan_tasks = max(1, input_bytes // scan_bytes)
    partitions = min(max(2 * total_cores, shuffled_bytes // partition_bytes), 8 * STATUS_BYTES // scan_tasks)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 << 20),
    }
