"""Session settings and the shared scratch folder."""

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution re-plans at run time: it coalesces small shuffle
# partitions, splits skewed join partitions and turns a join into a broadcast
# join only when the measured size of one side is under the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods above 8000 bytes; split wide projections there.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(app_name: str = "cropspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _own_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="cropspark-", ignore_cleanup_errors=True)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Where none is set, a local session (one process, so every task sees its folders) gets a
    temporary one, which goes with the process; any other session has to set it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = _own_folder().name
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/cropspark/{label}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, label: str = "step") -> DataFrame:
    """Write `df` to the shared folder and go on from the written copy.

    For a frame that feeds several passes: it is computed once, survives the loss of
    executors, is read back by column, and its real size is known, so Catalyst
    broadcasts it in a join only when it is under the threshold.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
