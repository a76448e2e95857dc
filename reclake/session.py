"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "reclake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings this library relies on; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a fresh temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="reclake-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path never used before, in a folder of this application under the checkpoint root."""
    application = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark)}/reclake/{application}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; frames that read them can no longer be used."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/reclake/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; ``options`` are those of the writer.

    Cuts the lineage, survives the loss of executors, and gives later joins real table sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_packed(df: DataFrame, label: str, **options: str) -> DataFrame:
    """:func:`materialize` with files packed with zstd, which take less disk than those of the default and some more memory to write."""
    return materialize(df, label, compression="zstd", **options)
