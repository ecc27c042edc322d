"""Counts, minima and maxima out of Parquet footers, without reading a page.

Spark's newer Parquet reader takes `count`, `min` and `max` of whole columns from the footers. It is
used in a session of its own, so that the settings of the caller's session stay as they are; the
few result rows come back as a local frame. With a filter on rows, or for a column type whose
footers don't hold exact limits, the same call reads what it needs.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster whose Parquet scans push aggregates down."""
    session = spark.newSession()
    for name, value in _SETTINGS.items():
        session.conf.set(name, value)
    return session


def aggregate(
    spark: SparkSession, path: str, columns: Mapping[str, Column], where: Column | None = None, schema=None
) -> DataFrame:
    """One row of aggregates over a Parquet table, planned in a footer session."""
    reader = footer_session(spark).read
    table = (reader if schema is None else reader.schema(schema)).parquet(path)
    if where is not None:
        table = table.where(where)
    return table.agg(*[c.alias(name) for name, c in columns.items()])


def table_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(tabela, total): the rows of each Parquet table, by its footers."""
    counts = [(name, aggregate(spark, path, {"total": F.count(F.lit(1))}).first()["total"]) for name, path in paths.items()]
    return spark.createDataFrame(counts, "tabela string, total bigint")


def latest(spark: SparkSession, path: str, column: str = "ano", where: Column | None = None):
    """The largest value of a column, by the footers unless rows are filtered; None if there is none."""
    return aggregate(spark, path, {"latest": F.max(column)}, where).first()["latest"]
