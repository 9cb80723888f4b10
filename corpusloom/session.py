"""Session helpers: settings and tables below the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "corpusloom", **settings: str) -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    The folder named by ``spark.checkpoint.dir`` is used wherever it is set. Only a
    local-mode session without it gets a temporary folder; a cluster without it is an
    error, since a folder on one machine would not survive a lost executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="corpusloom-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once below the checkpoint folder and go on from the written table.

    Used where several jobs or joins read what was derived from the text: keys and a few
    numbers per document, or counts. The table outlives lost executors, cuts the lineage
    and is read by column; it is removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/work/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = target.getFileSystem(spark._jsc.hadoopConfiguration())
    filesystem.mkdirs(target)
    filesystem.deleteOnExit(target)
    return path


def drop_materialized(spark: SparkSession) -> int:
    """Delete the tables that :func:`materialize` has written in this application so far.

    For long sessions, between jobs: results that are still to be computed from them can
    no longer be read. Returns how many there were.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/tables")
    filesystem = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not filesystem.exists(root):
        return 0
    dropped = len(filesystem.listStatus(root))
    filesystem.delete(root, True)
    return dropped
