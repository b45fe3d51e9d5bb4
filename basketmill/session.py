"""The shared folder for written intermediate tables, and a session for one machine."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER_SETTING = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", staging: str | None = None) -> SparkSession:
    """A one-machine session for tests and timings; ``staging`` names its shared folder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("basketmill")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = (builder.config(FOLDER_SETTING, staging) if staging else builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a session inside one process may leave it unset; it then gets a folder of its own application.
    """
    folder = spark.conf.get(FOLDER_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"{FOLDER_SETTING} must name a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), f"basketmill-{spark.sparkContext.applicationId}")


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/basketmill/{spark.sparkContext.applicationId}"


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses; it goes when the application ends."""
    folder = _application_folder(spark)
    files, path = _file_system(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete all that this application has staged; frames that read it can no longer be used."""
    files, path = _file_system(spark, _application_folder(spark))
    files.delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of what was written.

    Later steps then agree on every value, however often an executor is lost, and read only
    the columns they need.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def entries_of(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """Names in a folder with the time of their last change in seconds; none if it is not there."""
    files, path = _file_system(spark, folder)
    found = files.listStatus(path) if files.exists(path) else ()
    return sorted((status.getPath().getName(), status.getModificationTime() / 1000) for status in found)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder, whose parent is made if need be; false if there is none."""
    files, path = _file_system(spark, source)
    if not files.exists(path):
        return False
    to = _file_system(spark, target)[1]
    files.mkdirs(to.getParent())
    if not files.rename(path, to):
        raise OSError(f"{source} cannot be moved to {target}")
    return True


def finished_batches(spark: SparkSession, sink: str) -> list[str]:
    """The ``batch_id=`` folders under ``sink`` whose write has ended, one per micro-batch."""
    files, path = _file_system(spark, f"{sink.rstrip('/')}/batch_id=*/_SUCCESS")
    found = files.globStatus(path)
    return sorted(status.getPath().getParent().toString() for status in found or ())
