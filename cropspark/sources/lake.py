"""Partitioned Parquet lake: tabela= / nivel= / ano= folders."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropspark.operators.star import unique_batch, upsert
from cropspark.session import written_once

PARTITIONS = ("tabela", "nivel", "ano")


def write_lake(
    df: DataFrame, path: str, partitions: Sequence[str] = PARTITIONS, touched_only: bool = False
) -> None:
    """Write one folder per partition value; all old folders go, or the touched ones only.

    `rebalance` groups rows of a partition into well-sized files and lets adaptive
    execution split a partition that holds a large part of the table.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic" if touched_only else "static")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    partitions: Sequence[str] = PARTITIONS,
    touched_only: bool = False,
    row_group_bytes: int = 32 << 20,
) -> None:
    """Like `write_lake`, with rows laid in order of some columns inside each folder.

    Rows are range-partitioned by folder and columns, and sorted, so a value lies in few row groups,
    whose limits and Bloom filters (of text and whole-number columns) let a filter on it skip the
    others. A hash of the row comes last in the ranges: one hot value is split as well.
    """
    order = [*partitions, *cluster_by]
    dealt = df.repartitionByRange(*order, F.xxhash64(*df.columns)).sortWithinPartitions(*order)
    writer = (
        dealt.write.mode("overwrite")
        .option("compression", "snappy")
        .option("parquet.block.size", row_group_bytes)
        .option("partitionOverwriteMode", "dynamic" if touched_only else "static")
    )
    for name in cluster_by:
        if isinstance(df.schema[name].dataType, (T.StringType, T.IntegerType, T.LongType)):
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", True)
    writer.partitionBy(*partitions).parquet(path)


def read_lake(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The lake as one table; filters on partition columns prune whole folders.

    Without a schema the types of partition columns are guessed from folder names, so a code
    made of digits becomes a number.
    """
    reader = spark.read.option("basePath", path)
    return (reader if schema is None else reader.schema(schema)).parquet(path)


def upsert_lake(
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    schema: T.StructType,
    partition: str = "ano",
    **options,
) -> None:
    """Upsert a batch into a table partitioned by a column of its key.

    Only the partitions that the batch touches are read, merged and overwritten; the merged
    rows are written to the shared folder first, since they replace what they come from. A
    repeated delivery changes nothing.
    """
    spark = batch.sparkSession
    incoming = written_once(unique_batch(batch, keys, **options), "batch")
    touched = incoming.select(partition).distinct()
    try:
        table = read_lake(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], schema)
    base = table.join(touched, partition, "left_semi").select(*schema.fieldNames())
    merged = written_once(upsert(base, incoming, keys, update), "merged")
    write_lake(merged.select(*schema.fieldNames()), path, (partition,), touched_only=True)
