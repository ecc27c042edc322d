"""Tables stored by the hash of their conflict key, so that an upsert moves only the batch.

A table is a view over its current version, a Parquet table bucketed and sorted by the key. The
full outer join of an upsert takes a bucket per task as it lies: only the batch is shuffled, into
the same buckets, and each task writes its bucket of the next version. The view is switched when
the version is complete, so readers see all of an upsert or none of it.
"""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cropspark.operators.star import unique_batch, upsert

BUCKETS = 16


def _switch(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")


def _write_version(df: DataFrame, name: str, location: str, keys: Sequence[str], buckets: int) -> str:
    version = f"{name}_{uuid.uuid4().hex}"
    (
        df.write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", f"{location}/{version.replace('.', '/')}")
        .option("compression", "snappy")
        .saveAsTable(version)
    )
    return version


def create(df: DataFrame, name: str, location: str, keys: Sequence[str], buckets: int = BUCKETS) -> str:
    """Store `df`, whose key is unique, as the table `name` below the folder `location`.

    Choose `buckets` so that a bucket fits into a task; it stays the same for all versions.
    """
    version = _write_version(df.repartition(buckets, *keys), name, location, keys, buckets)
    _switch(df.sparkSession, name, version)
    return version


def current(spark: SparkSession, name: str) -> tuple[str, str, list[str], int]:
    """The version that the table shows, its folder's parent, its key columns and buckets."""
    shown = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    version = shown["View Text"].rsplit(" FROM ", 1)[1].strip()
    facts = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {version}").collect()}
    keys = [k.strip(" `") for k in facts["Bucket Columns"].strip("[]").split(",")]
    location = facts["Location"].removesuffix("/" + version.replace(".", "/"))
    return version, location, keys, int(facts["Num Buckets"])


def merged(spark: SparkSession, name: str, batch: DataFrame, update: Sequence[str], **options) -> DataFrame:
    """The table with the batch upserted on the columns by which it is stored."""
    keys, buckets = current(spark, name)[2:]
    base = spark.table(name)
    kinds = dict(base.dtypes)
    # the batch's keys must hash as the table's do
    typed = batch.withColumns({k: batch[k].cast(kinds[k]) for k in keys})
    incoming = unique_batch(typed, keys, **options).repartition(buckets, *keys)
    return upsert(base, incoming, keys, update, checked=True)


def upsert_table(spark: SparkSession, name: str, batch: DataFrame, update: Sequence[str], **options) -> str:
    """Upsert a batch; returns the version before, which may be dropped when nobody reads it.

    Two upserts of one table must not run at the same time: the later switch would win.
    """
    before, location, keys, buckets = current(spark, name)
    version = _write_version(merged(spark, name, batch, update, **options), name, location, keys, buckets)
    _switch(spark, name, version)
    return before
