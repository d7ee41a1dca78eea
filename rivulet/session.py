"""Session defaults and the shared folder that jobs may write to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rivulet", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC times; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def check_folder(folder: str | None, master: str, hadoop, reached: Callable[[], bool] = lambda: False) -> None:
    """On any master but a local one the folder must be given, with a scheme or on a default file system
    that is not each machine's own. A plain path on such a one may be a mount that all share: ``reached`` says so."""
    if re.fullmatch(r"local(\[.*\])?", master):
        return
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if "://" not in folder and not folder.startswith("file:") and (hadoop.get("fs.defaultFS") or "file:").startswith("file:") and not reached():
        raise RuntimeError(f"spark.checkpoint.dir has no scheme, the default file system is local, and not all executors reach {folder}")


@cache
def reached_by_all(spark: SparkSession, folder: str) -> bool:
    """Whether what every core writes below ``folder`` is there for all others (runs two small jobs, once per session and folder).

    Executors that write to a disk of their own leave nothing that the driver commits, so their rows are missing.
    """
    n = spark.sparkContext.defaultParallelism
    path = f"{folder.rstrip('/')}/reached-{uuid.uuid4().hex}"
    spark.range(0, n, 1, n).write.parquet(path)
    written = spark.read.schema("id long").parquet(path)
    whole = written.count() == n
    release(written)
    return whole


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Where the setting is absent a local master gets a fresh temporary folder; on a cluster that
    would be visible to one machine only, so there it is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    check_folder(configured, context.master, context._jsc.hadoopConfiguration(), lambda: reached_by_all(spark, configured))
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="rivulet-"))
    return configured or context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as Parquet below the shared folder (this runs a job) and read it back.

    Lineage ends at the written files, which outlive lost executors, and later joins know
    their true size.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Remove what ``materialize`` wrote for these tables, once nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        jvm = spark.sparkContext._jvm
        folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
