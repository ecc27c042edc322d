"""Descriptive statistics, shares, changes over time and trend lines."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark.functions.numbers import guarded_ratio, percent_change, round_half_even
from cropspark.functions.quantiles import exact_percentiles
from cropspark.session import written_once


def _zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def melt_metrics(df: DataFrame, keep: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(keep..., coluna, valor), one row per metric, NULL values left out."""
    numbers = df.select(*keep, *[F.col(m).cast("double").alias(m) for m in metrics])
    return numbers.unpivot(list(keep), list(metrics), "coluna", "valor").where(
        F.col("valor").isNotNull()
    )


# --- one group of numbers ----------------------------------------------------


def describe_metrics(
    df: DataFrame, metrics: Sequence[str] = fv.METRICS, places: int | None = 2
) -> DataFrame:
    """count, mean, median, sample std, min, max, Q1 and Q3 per metric column."""
    long = melt_metrics(df.na.drop(how="all", subset=list(metrics)), [], metrics)
    moments = long.groupBy("coluna").agg(
        F.count("valor").alias("registros"),
        F.avg("valor").alias("media"),
        F.stddev_samp("valor").alias("desvio_padrao"),
        F.min("valor").alias("minimo"),
        F.max("valor").alias("maximo"),
    )
    quartiles = exact_percentiles(
        long, "valor", {"q1": 0.25, "mediana": 0.5, "q3": 0.75}, by=["coluna"], few_groups=True
    ).drop("n")
    joined = moments.join(F.broadcast(quartiles), "coluna")  # one row per metric column
    shown = ["media", "mediana", "desvio_padrao", "minimo", "maximo", "q1", "q3"]
    return joined.select(
        "coluna",
        "registros",
        *[(F.col(c) if places is None else round_half_even(F.col(c), places)).alias(c) for c in shown],
    )


def summary_by(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.min(value).alias("minimo"),
        F.max(value).alias("maximo"),
        F.avg(value).alias("media"),
        F.stddev_samp(value).alias("desvio_padrao"),
    )


def sum_by(df: DataFrame, by: str, value: str) -> DataFrame:
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(by)
        .agg(F.sum(value).alias(value))
        .orderBy(F.col(value).asc(), by)
    )


def mean_by_with_references(df: DataFrame, by: str, value: str) -> DataFrame:
    """Mean per group, with the mean and the median of those means as columns."""
    means = df.where(F.col(value).isNotNull()).groupBy(by).agg(F.avg(value).alias(value))
    return _with_references(means, value).orderBy(F.col(value).desc(), by)


def row_values_with_references(df: DataFrame, label: str, value: str) -> DataFrame:
    """Single values, highest first, with the mean and median over all rows."""
    rows = df.where(F.col(value).isNotNull()).select(label, value)
    return _with_references(rows, value).orderBy(F.col(value).desc(), label)


def _with_references(df: DataFrame, value: str) -> DataFrame:
    median = exact_percentiles(df, value, {"mediana": 0.5}).select("mediana")
    return df.withColumns(
        {"media": df.agg(F.avg(value)).scalar(), "mediana": median.scalar()}
    )


def value_ranking(df: DataFrame, label: str, value: str) -> DataFrame:
    """Rows by value, lowest first, with the overall maximum and the value in millions."""
    rows = df.where(F.col(value).isNotNull()).select(label, value)
    return rows.withColumns(
        {
            "maximo": rows.agg(F.max(value)).scalar(),
            "valor_milhoes": F.col(value) / 1e6,
        }
    ).orderBy(F.col(value).asc(), label)


def share_of_total(df: DataFrame, by: str, value: str, out: str = "participacao") -> DataFrame:
    sums = df.where(F.col(value).isNotNull()).groupBy(by).agg(F.sum(value).alias(value))
    total = sums.agg(F.sum(value)).scalar()
    return sums.withColumn(out, F.try_divide(F.col(value), total))


def kpi_summary(
    df: DataFrame,
    quantity: str = "qtd_produzida",
    area: str = "area_colhida_ha",
    value: str = "valor_producao_mil_reais",
    product: str = "produto",
) -> DataFrame:
    """Card totals; the ratio is quantity per unit of area, as the cards show it."""
    totals = df.agg(
        _zero_if_null(F.sum(quantity)).alias("total_producao"),
        _zero_if_null(F.sum(area)).alias("total_area"),
        _zero_if_null(F.sum(value)).alias("total_valor"),
        F.count_distinct(product).alias("num_produtos"),
    )
    return totals.withColumns(
        {
            "quantidade_por_area": guarded_ratio(F.col("total_producao"), F.col("total_area")),
            "producao_milhoes": round_half_even(F.col("total_producao") / 1e6, 1),
            "area_milhoes": round_half_even(F.col("total_area") / 1e6, 1),
            "valor_milhoes": round_half_even(F.col("total_valor") / 1e6, 0),
        }
    )


# --- long form: one row per variable ------------------------------------------


def _sum_of(label: str, variable: str, value: str) -> Column:
    return F.sum(F.when(F.col(variable) == label, F.col(value)))


def long_kpis(
    df: DataFrame,
    quantity: str = fv.QUANTITY_LABEL,
    area: str = fv.PLANTED_AREA_LABEL,
    variable: str = "variavel",
    value: str = "valor",
    product: str = "produto",
) -> DataFrame:
    totals = df.agg(
        _zero_if_null(_sum_of(quantity, variable, value)).alias("total_producao"),
        _zero_if_null(_sum_of(area, variable, value)).alias("total_area"),
        F.count_distinct(product).alias("num_produtos"),
    )
    return totals.withColumn(
        "rendimento_medio", guarded_ratio(F.col("total_producao"), F.col("total_area"))
    )


def top_by_variable(
    df: DataFrame,
    label: str,
    n: int = 10,
    variable: str = "variavel",
    value: str = "valor",
    product: str = "produto",
) -> DataFrame:
    """Products with the largest sum of one variable."""
    sums = df.where(F.col(variable) == label).groupBy(product).agg(F.sum(value).alias(value))
    return sums.orderBy(F.col(value).desc_nulls_last(), product).limit(n)


def yield_by_product(
    df: DataFrame,
    quantity: str = fv.QUANTITY_LABEL,
    area: str = fv.PLANTED_AREA_LABEL,
    n: int | None = 10,
    variable: str = "variavel",
    value: str = "valor",
    product: str = "produto",
) -> DataFrame:
    """Quantity over area per product that has both; both sums in one pass."""
    ratios = (
        df.groupBy(product)
        .agg(
            _sum_of(quantity, variable, value).alias("_q"),
            _sum_of(area, variable, value).alias("_a"),
        )
        .select(product, F.try_divide(F.col("_q"), F.col("_a")).alias("rendimento"))
        .where(F.col("rendimento").isNotNull())
        .orderBy(F.col("rendimento").desc(), product)
    )
    return ratios if n is None else ratios.limit(n)


# --- change over time -----------------------------------------------------------


def mean_with_previous(
    df: DataFrame,
    value: str = "valor_producao_mil_reais",
    by: str = "id_commodity",
    period: str = "ano",
) -> DataFrame:
    """Mean per group and period beside the mean of the period before.

    The window runs over one row per period, at most the years of one product.
    """
    means = df.groupBy(by, period).agg(F.avg(value).alias("preco_medio"))
    in_time = Window.partitionBy(by).orderBy(F.col(period).asc_nulls_last())
    return means.withColumn("preco_anterior", F.lag("preco_medio").over(in_time))


def change_on_previous(df: DataFrame, **options) -> DataFrame:
    return mean_with_previous(df, **options).withColumn(
        "variacao_pct", percent_change(F.col("preco_medio"), F.col("preco_anterior"))
    )


def trend_line(df: DataFrame, by: str, x: str, y: str, points: int = 100) -> DataFrame:
    """Least-squares line over the group sums, at evenly spaced x: (ponto, x, y).

    Fewer than two groups have no line and give no rows.
    """
    sums = df.na.drop(subset=[x, y]).groupBy(by).agg(F.sum(x).alias("_x"), F.sum(y).alias("_y"))
    return line_points(sums, "_x", "_y", points)


def line_points(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """The same line fitted on single rows."""
    pairs = df.na.drop(subset=[x, y]).select(
        F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
    )
    fit = pairs.agg(
        F.regr_slope("_y", "_x").alias("_slope"),
        F.regr_intercept("_y", "_x").alias("_intercept"),
        F.min("_x").alias("_from"),
        F.max("_x").alias("_to"),
    ).where(F.col("_slope").isNotNull())
    step = (F.col("_to") - F.col("_from")) / (points - 1)
    return (
        fit.withColumn("ponto", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", F.col("_from") + F.col("ponto") * step)
        .select("ponto", "x", (F.col("_intercept") + F.col("_slope") * F.col("x")).alias("y"))
    )


def boxplot_stats(df: DataFrame, by: str, value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends within `reach` x IQR, and outlier count per group."""
    rows = df.where(F.col(value).isNotNull()).select(by, F.col(value).cast("double").alias("_v"))
    boxes = exact_percentiles(rows, "_v", {"q1": 0.25, "mediana": 0.5, "q3": 0.75}, by=[by])
    spread = F.col("q3") - F.col("q1")
    boxes = boxes.withColumns(
        {"_low": F.col("q1") - reach * spread, "_high": F.col("q3") + reach * spread}
    ).withColumnRenamed(by, "_group")
    boxes = written_once(boxes, "boxes")
    joined = rows.join(boxes, rows[by].eqNullSafe(boxes["_group"]))
    inside = F.col("_v").between(F.col("_low"), F.col("_high"))
    return joined.groupBy(by).agg(
        F.max("n").alias("registros"),
        F.max("q1").alias("q1"),
        F.max("mediana").alias("mediana"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("_v"))).alias("haste_inferior"),
        F.max(F.when(inside, F.col("_v"))).alias("haste_superior"),
        F.count_if(~inside).alias("outliers"),
    )
