"""Clean and upsert CSV snapshots as they land.

The clean-up chain is stateless, so every micro-batch runs the same plan as the
batch load, and the upsert makes a repeated delivery harmless.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cropspark import fixed_values as fv
from cropspark import schemas
from cropspark.operators.rows import clean_rows
from cropspark.sources.lake import upsert_lake
from cropspark.sources.snapshots import CSV_OPTIONS


def landed_rows(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.readStream.schema(schemas.RAW_WIDE_TEXT)
        .options(**CSV_OPTIONS)
        .option("recursiveFileLookup", True)
        .csv(folder)
    )


def load_batch(batch: DataFrame, table: str, processed_at: str) -> None:
    """Upsert one micro-batch into the years it touches; doing it again changes nothing."""
    cleaned = clean_rows(batch, processed_at)
    order = ["coletado_em", *fv.METRICS]
    upsert_lake(
        table, cleaned, fv.PROCESSED_KEYS, fv.PROCESSED_UPDATES, schemas.PROCESSED, on_duplicate="last", order=order
    )


def load_landed(
    spark: SparkSession, folder: str, table: str, checkpoint: str, processed_at: str
) -> StreamingQuery:
    """Start loading everything not loaded yet; the query ends when it has caught up."""

    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, table, processed_at)

    return (
        landed_rows(spark, folder)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
