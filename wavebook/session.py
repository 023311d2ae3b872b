"""Session for tests and benches, and the shared folder every executor can reach."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wavebook")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("WAVEBOOK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: Folders made up for sessions on one machine that name none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only made up when the setting is missing and the
    session runs on one machine, as in tests; on a cluster the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="wavebook-")
    return _LOCAL_FOLDERS[application]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/wavebook-{purpose}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """The rows written once to the shared folder and read back from there.

    Whatever follows reads the same rows, does not work them out again, and does not
    depend on the executors that produced them. The compression is the session's unless given.
    """
    path = new_folder(rows.sparkSession, purpose)
    rows.write.mode("errorifexists").parquet(path, compression=compression)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
