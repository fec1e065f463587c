"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Removes the shuffle files of a write when it ends.
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The folder, below the application's, of the stages of the running job.
_job_folder: ContextVar[str] = ContextVar("job_folder", default="")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("topicmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.files.openCostInBytes", "1m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only a local session, where every task runs on this machine, may fall back
    to a temporary folder; a cluster without the setting is an error.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="topicmill-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; no two calls share one."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/{application}/{_job_folder.get()}{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and all below it, on any file system that Spark writes to."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


@contextmanager
def stages_of_job(spark: SparkSession) -> Iterator[None]:
    """Remove every table that is staged inside, also after a failure. What the job
    returns must be written elsewhere by then. A job inside a job shares its folder."""
    if _job_folder.get():
        yield
        return
    folder = f"job-{uuid.uuid4().hex}/"
    token = _job_folder.set(folder)
    try:
        yield
    finally:
        _job_folder.reset(token)
        remove_folder(spark, f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{folder}")


def staged(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result survives the loss of executors without recomputing its lineage,
    and a plan that reads it twice sees the same rows both times. Row groups of
    ``group_bytes`` let several tasks share a large file. The write's own shuffle
    files go at its end.
    """
    path = stage_path(df.sparkSession, name)
    add_to_stage(df, path, group_bytes)
    return read_stage(df.sparkSession, path, df.schema)


def add_to_stage(df: DataFrame, path: str, group_bytes: int | None = None, partition: str | None = None) -> None:
    """Write ``df`` beside what is at ``path``, and remove the write's own shuffle files."""
    writer = df.write if group_bytes is None else df.write.option("parquet.block.size", str(group_bytes))
    writer = writer if partition is None else writer.partitionBy(partition)
    conf = df.sparkSession.conf
    before = conf.get(_FILE_CLEANUP, "false")
    conf.set(_FILE_CLEANUP, "true")
    try:
        writer.mode("append").parquet(path)
    finally:
        conf.set(_FILE_CLEANUP, before)


def read_stage(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
