"""Session settings and materialisation shared by the library."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings under which the library's results are defined; cluster sizes are left to the deployment.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def create_session(master: str | None = None, app: str = "textloom", **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` settings have underscores for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("_", "."): v for k, v in extra.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share; a temporary one only where none is named."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="textloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/textloom/{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """Cuts the lineage of ``df`` with a reliable checkpoint in the folder that all executors share."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt over all cores if their input has fewer splits than that, as small files do; else untouched.

    Worth it before work on whole texts. Large inputs have more splits than cores, so their texts are never shuffled.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
