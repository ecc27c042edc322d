"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropspark.functions.text import bound as bound
from cropspark.session import scratch_path

# The bytes that separate words, 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[ \\t\\n\\x0B\\f\\r]+"


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def words_of(text: Column) -> Column:
    """Words between blanks, in order; null or blank text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def one_row(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """`keep` and one struct `_m` of the columns, each of which is computed once.

    The struct comes from a generator, so Catalyst neither repeats the columns where they are
    used more than once nor pushes later filters below them.
    """
    fields = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.explode(F.array(fields)).alias("_m"))


def packed(df: DataFrame, name: str, *more: Column) -> DataFrame:
    """All columns of `df` as one struct, so that no name can clash with the columns `more`."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name), *more)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and go on from the written copy."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """Partitions for `rows` rows of which a task shall take `per_part`."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_part))
