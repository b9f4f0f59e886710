"""Session helpers: a local session for tests/bench and checkpoint-dir lookup."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "adlumen", driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    """A local session with AQE on and the web UI off."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Directory used by `DataFrame.checkpoint()`.

    Uses what the cluster configured (`spark.checkpoint.dir`, or a dir already
    set on the context).  Only a local-mode session with nothing configured
    gets a fresh temporary folder; on a cluster a missing setting is an error,
    because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if not sc.master.startswith("local") and "://" not in configured and not configured.startswith("file:") \
                and sc._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
            raise RuntimeError(f"spark.checkpoint.dir {configured} names a local folder of each machine; give its "
                               "scheme (hdfs://, s3a://, or file:// for a folder that all machines mount)")
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="adlumen-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)"
    )


def scratch_path(spark, name: str) -> str:
    """A new path below the checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/adlumen-{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark):
    """Writes and one-row results inside delete their shuffle files as soon as they are done.

    Else these stay until the driver's JVM collects the frames, which may be long after
    the next step has written its own.  Not for a frame that is run again: it would make
    them anew.  A Spark version without the setting ignores it.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df, name: str, metrics=None, partition_by: str | None = None):
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but in one job and columnar; the
    folder is the shared one the cluster configured, so the table survives
    executor loss.  The write's shuffle files are gone when it returns.
    ``metrics`` (aggregate Columns) are collected during the
    same write through ``observe``.  ``partition_by`` names the last column: its
    values get folders of their own.  Returns ``(frame, path, metrics dict)``.
    """
    import uuid

    from pyspark.sql import Observation

    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = None
    if metrics:
        obs = Observation(f"adlumen_{name}_{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, *metrics)
    if partition_by:        # a table without rows leaves no file to read the schema from
        with shuffles_freed(spark):
            df.write.partitionBy(partition_by).parquet(path)
        return spark.read.schema(df.schema).parquet(path), path, (obs.get if obs else {})
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.parquet(path), path, (obs.get if obs else {})


def release_shuffles(spark) -> None:
    """Let Spark delete the shuffle files of frames that nobody holds any more.

    It does so once the driver's JVM has collected them, which may be long after
    the next large shuffle is written.  Best effort, as ``drop_materialized``.
    """
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # noqa: BLE001 - cleanup must not break a finished step
        pass


def write_bucketed(df, key: str, buckets: int, name: str):
    """Write ``df`` under the checkpoint folder as a table bucketed and sorted by
    ``key`` (one file a bucket), and read it back.

    Joins and aggregates on ``key`` of tables with equally many buckets need no
    shuffle.  The table's name is in the session's catalog only.
    """
    import uuid

    table = f"adlumen_{name}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
       .option("path", scratch_path(df.sparkSession, name)).saveAsTable(table))
    return df.sparkSession.table(table)


def drop_materialized(spark, path: str) -> None:
    """Delete a table written by ``materialize`` (Hadoop FileSystem API).

    Best effort: a table that cannot be deleted only costs space in the
    checkpoint folder, so a failure here never fails the job.
    """
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - cleanup must not break a finished step
        pass
