"""Session settings and the one way this library cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HTML rows are wide: keep the batches sent to Python small in rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


def build_session(app_name: str = "cardfold", **settings: str) -> SparkSession:
    """A session with the settings the jobs are tuned for."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _fallback_dir() -> str:
    return tempfile.mkdtemp(prefix="cardfold-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the one given
    to ``setCheckpointDir``. Only a local master, where driver and tasks are one
    machine, may do without and gets a temporary folder."""
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if known:
        return known
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _fallback_dir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/cardfold/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Loops call this once per round: the plan stays short, a lost executor only
    repeats the current round, and readers still prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def supersede(old: DataFrame | None, df: DataFrame, label: str = "step") -> DataFrame:
    """``materialize(df)``, then delete the table that ``old`` reads.

    For loops: ``old`` is the table of the round before, which nothing reads once
    the new one is written.
    """
    new = materialize(df, label)
    if old is not None:
        hadoop = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs
        settings = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {name.rsplit("/", 1)[0] for name in old.inputFiles()}:
            path = hadoop.Path(folder)
            path.getFileSystem(settings).delete(path, True)
    return new
