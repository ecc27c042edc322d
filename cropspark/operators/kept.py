"""Aggregates kept per key and year, of which a batch refreshes only the years it touches.

A kept table holds mergeable state: counts, means and squared deviations for moments, KLL sketches
for quantiles, bitmaps of numbered codes for distinct counts. Answers merge the state of all years
and never read old rows again. State is as large as keys times years.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropspark.operators.star import number_rows
from cropspark.session import written_once

#: Size of a KLL sketch; ranks are within `RANK_ERROR` of the exact ones with 99 % confidence.
SKETCH_SIZE = 2000
RANK_ERROR = 0.002


def moments(value: str) -> dict[str, Column]:
    """State of count, sum, mean, deviation and limits of a column."""
    v = F.col(value).cast("double")
    return {
        "n": F.count(v),
        "soma": F.sum(v),
        "media": F.avg(v),
        "m2": F.var_pop(v) * F.count(v),
        "minimo": F.min(v),
        "maximo": F.max(v),
    }


def sketch(value: str, size: int = SKETCH_SIZE) -> dict[str, Column]:
    """State of the quantiles of a column, missing values left out."""
    v = F.col(value).cast("double")
    return {"n": F.count(v), "esboco": F.kll_sketch_agg_double(F.when(~F.isnan(v), v), size)}


def bits(code: str) -> dict[str, Column]:
    """State of the distinct numbered codes of a group; group by `bit_bucket(code)` as well."""
    return {"mapa": F.bitmap_construct_agg(F.bitmap_bit_position(F.col(code)))}


def bit_bucket(code: str) -> Column:
    return F.bitmap_bucket_number(F.col(code)).alias("balde")


def refresh(
    spark: SparkSession,
    kept: str,
    table: DataFrame,
    touched: DataFrame,
    keys: Sequence[str | Column],
    state: Mapping[str, Column],
    partition: str = "ano",
) -> list:
    """Work the state of the touched years out anew, from those years of `table` alone.

    `table` is partitioned by year; `touched` holds the years of a batch (a value per partition,
    which bounds what the driver gets). Folders of the years that have rows are replaced; one whose
    rows are all gone has to be dropped by whoever drops it from the table. Returns the years.
    """
    years = sorted(row[0] for row in touched.select(partition).where(F.col(partition).isNotNull()).distinct().collect())
    own = table.where(F.col(partition).isin(years))
    fresh = own.groupBy(partition, *keys).agg(*[c.alias(name) for name, c in state.items()])
    (
        fresh.withColumn("_ano", F.col(partition))
        .hint("rebalance", "_ano")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_ano")
        .parquet(kept)
    )
    return years


def read(spark: SparkSession, kept: str) -> DataFrame:
    return spark.read.parquet(kept).drop("_ano")


def merged_moments(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., n, soma, media, desvio_padrao, minimo, maximo) over all years of the state.

    Deviations of the parts are shifted to the common mean, so nothing cancels out.
    """
    total = state.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("soma").alias("soma"), F.min("minimo").alias("minimo"), F.max("maximo").alias("maximo")
    )
    total = total.withColumn("media", F.try_divide(F.col("soma"), F.col("n")))
    side = {c: f"_k{i}" for i, c in enumerate(by)}
    parts = state.select(*[F.col(c).alias(s) for c, s in side.items()], F.col("n").alias("_n"), F.col("media").alias("_media"), F.col("m2").alias("_m2"))
    same = F.lit(True)
    for c, s in side.items():
        same = same & F.col(c).eqNullSafe(F.col(s))
    shifted = F.sum(F.col("_m2") + F.col("_n") * F.pow(F.col("_media") - F.col("media"), F.lit(2)))
    joined = total.join(parts, same).groupBy(*by, "n", "soma", "media", "minimo", "maximo").agg(shifted.alias("_m2"))
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (F.col("n") - 1)))
    return joined.select(*by, "n", "soma", "media", deviation.alias("desvio_padrao"), "minimo", "maximo")


def merged_quantiles(state: DataFrame, probs: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., n, one column per probability): quantiles of the merged sketches, within `RANK_ERROR`."""
    merged = state.where("n > 0").groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("esboco").alias("_all"))
    found = {name: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_all", F.lit(float(p)))) for name, p in probs.items()}
    return merged.select(*by, "n", *[c.alias(name) for name, c in found.items()])


def merged_distinct(state: DataFrame, by: Sequence[str] = (), out: str = "distintos") -> DataFrame:
    """Exact distinct counts: the bitmaps of a bucket are OR-ed, their ones added up."""
    buckets = state.groupBy(*by, "balde").agg(F.bitmap_count(F.bitmap_or_agg("mapa")).alias("_ones"))
    return buckets.groupBy(*by).agg(F.sum("_ones").alias(out))


def numbered(codes: DataFrame, known: DataFrame | None, code: str, out: str = "numero") -> DataFrame:
    """(code, number) from 1 on for each code; known numbers stay, new codes follow them."""
    names = codes.select(code).where(F.col(code).isNotNull()).distinct()
    if known is None:
        return written_once(number_rows(names, [code], out), "codes")
    highest = known.agg(F.coalesce(F.max(out), F.lit(0)).alias("m")).scalar()
    fresh = number_rows(names.join(known, code, "left_anti"), [code], out, highest)
    return written_once(known.select(code, out).unionByName(fresh.select(code, out)), "codes")
