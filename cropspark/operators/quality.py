"""Anomalies, outliers, integrity and constraint reports."""

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropspark import fixed_values as fv
from cropspark.functions.numbers import yield_per_area
from cropspark.functions.quantiles import exact_percentiles
from cropspark.operators.rows import counts_as_rows
from cropspark.operators.stats import melt_metrics
from cropspark.session import written_once


def anomaly_category(
    tests: Sequence[tuple[str, str]] = fv.ANOMALY_CATEGORIES, valid: str = fv.VALID_CATEGORY
) -> Column:
    """The first metric at or below zero names the category; NULL counts as valid."""
    first, *others = tests
    category = F.when(F.col(first[0]) <= 0, first[1])
    for metric, name in others:
        category = category.when(F.col(metric) <= 0, name)
    return category.otherwise(valid)


def anomaly_summary(df: DataFrame, category: Column | None = None) -> DataFrame:
    """Rows and percent of all per category, largest first."""
    named = anomaly_category() if category is None else category
    counts = df.groupBy(named.alias("categoria")).agg(
        F.count(F.lit(1)).alias("total_registros")
    )
    share = F.col("total_registros").cast("decimal(19,0)") * 100 / F.sum("total_registros").over(
        Window.partitionBy()  # one row per category name, a fixed handful
    )
    return counts.withColumn("percentual", F.round(share, 2).cast("double")).orderBy(
        F.col("total_registros").desc(), "categoria"
    )


def is_anomalous(
    area: str = "area_colhida_ha", quantity: str = "qtd_produzida", ceiling: float = fv.YIELD_CEILING
) -> Column:
    too_high = yield_per_area(F.col(quantity), F.col(area)) > ceiling
    return (F.col(area) < 0) | (F.col(quantity) < 0) | too_high


def anomaly_rows(df: DataFrame, **options) -> DataFrame:
    return df.where(is_anomalous(**options))


def anomaly_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that meet each rule, all rules in one pass: (tipo, total)."""
    return counts_as_rows(df, {name: F.count_if(rule) for name, rule in rules.items()}, "tipo")


def range_rules(bounds: Mapping[str, tuple[float, float]]) -> dict[str, Column]:
    """A rule per column for values outside its business bounds."""
    return {
        f"{name} fora da faixa": (F.col(name) < low) | (F.col(name) > high)
        for name, (low, high) in bounds.items()
    }


def negative_rules(metrics: Sequence[str] = fv.METRICS) -> dict[str, Column]:
    return {f"{name} negativo": F.col(name) < 0 for name in metrics}


def outliers_iqr(
    df: DataFrame, label: str, metrics: Sequence[str] = fv.METRICS, reach: float = 1.5
) -> DataFrame:
    """(label, valor, coluna) of values outside Q1 - reach x IQR .. Q3 + reach x IQR."""
    long = melt_metrics(df, [label], metrics)
    fences = exact_percentiles(
        long, "valor", {"q1": 0.25, "q3": 0.75}, by=["coluna"], few_groups=True
    )
    spread = F.col("q3") - F.col("q1")
    fences = fences.select(
        "coluna", (F.col("q1") - reach * spread).alias("_low"), (F.col("q3") + reach * spread).alias("_high")
    )
    return (
        long.join(F.broadcast(fences), "coluna")  # one row per metric column
        .where((F.col("valor") < F.col("_low")) | (F.col("valor") > F.col("_high")))
        .select(label, "valor", "coluna")
    )


def flag_above_percentile(
    df: DataFrame, by: str, value: str, p: float = 0.95, out: str = "acima_p95"
) -> DataFrame:
    """Mark rows above their group's percentile; a NULL value is never above."""
    limits = exact_percentiles(df, value, {"_limit": p}, by=[by])
    limits = written_once(limits.select(F.col(by).alias("_group"), "_limit"), "limits")
    joined = df.join(limits, df[by].eqNullSafe(limits["_group"]), "left")
    above = F.coalesce(F.col(value) > F.col("_limit"), F.lit(False))
    return joined.withColumn(out, above).drop("_group", "_limit")


# --- integrity -----------------------------------------------------------------


def count_orphans(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Rows of `fact` for which SQL's `key NOT IN (SELECT dim_key ...)` holds.

    The fact is counted per key first, so a hot key is one row, and the test is an
    ordinary anti join, which needs no broadcast of the dimension. NULL follows
    SQL: a NULL in the dimension leaves no orphan, an empty dimension leaves all.
    """
    known = dim.select(F.col(dim_key).alias("_known"))
    facts = known.agg(
        F.struct(F.count(F.lit(1)).alias("size"), F.count_if(F.col("_known").isNull()).alias("nulls"))
    ).scalar()
    per_key = fact.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    unmatched = per_key.join(known, F.col("_key") == F.col("_known"), "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_all"),
        F.coalesce(F.sum(F.when(F.col("_key").isNotNull(), F.col("_rows"))), F.lit(0)).alias("_set"),
    )
    return unmatched.select(
        F.when(facts["size"] == 0, F.col("_all"))
        .when(facts["nulls"] > 0, F.lit(0))
        .otherwise(F.col("_set"))
        .alias("orfas")
    )


def _as_text(column: str, kinds: set[type]) -> Column:
    """A key as text that is equal where keys of these types are equal."""
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if kinds <= set(integral) or kinds == {T.StringType}:
        return F.col(column).cast("string")
    return F.col(column).cast("double").cast("string")


def orphan_counts(
    fact: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]
) -> DataFrame:
    """(verificacao, orfas) per reference name -> (fact key, dimension, dimension key).

    All references share one scan of the fact and one shuffle: a row gives a (reference, key) pair
    for each, pairs are counted, so a hot key is one row, and one anti join tells the unknown ones.
    NULL follows SQL's NOT IN, as in `count_orphans`.
    """
    pairs, known = [], []
    for i, (key, dim, dim_key) in enumerate(references.values()):
        kinds = {type(fact.schema[key].dataType), type(dim.schema[dim_key].dataType)}
        pairs.append(F.struct(F.lit(i).alias("_ref"), _as_text(key, kinds).alias("_key")))
        known.append(dim.select(F.lit(i).alias("_ref"), _as_text(dim_key, kinds).alias("_key")))
    per_key = (
        fact.select(F.explode(F.array(*pairs)).alias("_p"))
        .groupBy(F.col("_p._ref").alias("_ref"), F.col("_p._key").alias("_key"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    keys = functools.reduce(DataFrame.unionAll, known)
    unmatched = per_key.join(keys, ["_ref", "_key"], "left_anti").groupBy("_ref").agg(
        F.sum("_rows").alias("_all"), F.sum(F.when(F.col("_key").isNotNull(), F.col("_rows"))).alias("_set")
    )
    sizes = keys.groupBy("_ref").agg(F.count(F.lit(1)).alias("_size"), F.count_if(F.col("_key").isNull()).alias("_nulls"))
    names = fact.sparkSession.createDataFrame(list(enumerate(references)), "_ref int, verificacao string")
    # a row per reference and part: gathered by an aggregation, which needs no join on a constant
    parts = names.unionByName(sizes, allowMissingColumns=True).unionByName(unmatched, allowMissingColumns=True)
    found = parts.groupBy("_ref").agg(
        F.max("verificacao").alias("verificacao"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_size", "_nulls", "_all", "_set")]
    )
    orphans = F.when(F.col("_size") == 0, F.col("_all")).when(F.col("_nulls") > 0, F.lit(0)).otherwise(F.col("_set"))
    return found.select("verificacao", orphans.alias("orfas"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("tabela"), "total")
        for name, df in tables.items()
    ]
    return functools.reduce(DataFrame.unionAll, counts)


def count_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys occur more than once; a key with a NULL part never conflicts."""
    return (
        df.na.drop(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .agg(F.count_if(F.col("_copies") > 1).alias("violacoes"))
    )


def constraint_report(
    table: str,
    df: DataFrame,
    not_null: Sequence[str] = (),
    checks: Mapping[str, Column] | None = None,
    lengths: Mapping[str, int] | None = None,
    unique: Sequence[Sequence[str]] = (),
    references: Mapping[str, tuple[str, DataFrame, str]] | None = None,
) -> DataFrame:
    """Violations per constraint: (tabela, restricao, violacoes).

    Row rules share one pass. As in SQL, a check that is NULL is not violated.
    """
    rules = {f"{c} não nulo": F.count_if(F.col(c).isNull()) for c in not_null}
    rules |= {name: F.count_if(~rule) for name, rule in (checks or {}).items()}
    rules |= {f"{c} até {n} caracteres": F.count_if(F.length(c) > n) for c, n in (lengths or {}).items()}
    reports = [counts_as_rows(df, rules, "restricao", "violacoes")] if rules else []
    for keys in unique:
        name = F.lit(f"{', '.join(keys)} único").alias("restricao")
        reports.append(count_duplicate_keys(df, keys).select(name, "violacoes"))
    if references:
        reports.append(orphan_counts(df, references).toDF("restricao", "violacoes"))
    return functools.reduce(DataFrame.unionAll, reports).select(
        F.lit(table).alias("tabela"), "restricao", "violacoes"
    )
