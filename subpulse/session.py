"""Session settings and the one place that decides where scratch tables live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "subpulse", extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here expects.

    ``master`` and ``shuffle_partitions`` are left to the cluster unless given.
    AQE coalesces shuffle partitions, splits skewed join partitions and turns a
    sort-merge join into a broadcast join once the measured side is small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    if (master or "").startswith("local"):
        settings |= {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="subpulse-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's folder in the shared one.

    Results are read lazily, so scratch tables stay while the session may need
    them; the file system removes the application's folder when the driver ends.
    """
    context = spark.sparkContext
    root = f"{shared_dir(spark)}/scratch-{context.applicationId}"
    folder = context._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if files.mkdirs(folder):
        files.deleteOnExit(folder)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    This cuts the lineage, survives lost executors, and gives the planner the
    true size: a small result is broadcast by the planner's own threshold, a
    large one is shuffled.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
