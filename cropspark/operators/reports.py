"""Listings, rankings and lookups over the processed table and the star schema."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropspark.functions.numbers import thousands

LISTED = (
    "produto", "produto_nome_ibge", "ano", "area_colhida_ha", "qtd_produzida", "unidade_qtd",
    "rendimento_medio_kg_ha", "valor_producao_mil_reais", "status_dado", "processado_em",
)


def star_join(
    fact: DataFrame, dim_commodity: DataFrame, dim_territory: DataFrame | None = None
) -> DataFrame:
    """Fact with its dimensions. Catalyst broadcasts a dimension when its size allows."""
    joined = fact.join(dim_commodity, "id_commodity")
    return joined if dim_territory is None else joined.join(dim_territory, "id_territorio")


def star_listing(fact: DataFrame, dim_commodity: DataFrame, dim_territory: DataFrame) -> DataFrame:
    return (
        star_join(fact, dim_commodity, dim_territory)
        .select(
            F.col("nome_oficial").alias("produto"),
            F.col("nome").alias("territorio"),
            "ano",
            "area_colhida_ha",
            "qtd_produzida",
            "rendimento_medio_kg_ha",
            "valor_producao_mil_reais",
            "coletado_em",
        )
        .orderBy(F.col("ano").desc(), F.col("valor_producao_mil_reais").desc_nulls_last())
    )


def selected_products(
    fact: DataFrame, dim_commodity: DataFrame, dim_territory: DataFrame,
    codes: Sequence[str], year: int,
) -> DataFrame:
    """Listing of some products in one year."""
    chosen = dim_commodity.where(F.col("codigo_sidra").isin(*codes))
    return star_listing(fact.where(F.col("ano") == year), chosen, dim_territory)


def top_by_value(
    rows: DataFrame, n: int = 5, value: str = "valor_producao_mil_reais",
    ties: Sequence[str] = ("produto",),
) -> DataFrame:
    """The n highest values; `ties` fixes the order of equal values."""
    return rows.where(F.col(value).isNotNull()).orderBy(F.col(value).desc(), *ties).limit(n)


def top_fixed_year(
    fact: DataFrame, dim_commodity: DataFrame, year: int, n: int = 5,
    value: str = "valor_producao_mil_reais",
) -> DataFrame:
    rows = star_join(fact.where(F.col("ano") == year), dim_commodity)
    listed = rows.select(
        F.col("nome_oficial").alias("produto"), "id_territorio", "ano", "qtd_produzida", value
    )
    return top_by_value(listed, n, value, ties=["produto", "id_territorio"])


def latest_year(df: DataFrame, having: str = "qtd_produzida", year: str = "ano"):
    """The last year with a value of `having`, as a scalar subquery."""
    return df.where(F.col(having).isNotNull()).agg(F.max(year)).scalar()


def top_latest_year(
    fact: DataFrame, dim_commodity: DataFrame, dim_territory: DataFrame, n: int = 5,
    value: str = "valor_producao_mil_reais",
) -> DataFrame:
    recent = fact.where(F.col("ano") == latest_year(fact))
    listed = star_join(recent, dim_commodity, dim_territory).select(
        "nome_oficial", "nome", "ano", "qtd_produzida", value
    )
    return top_by_value(listed, n, value, ties=["nome_oficial", "nome"])


def top_volume_last_year(
    df: DataFrame, product: str = "produto", quantity: str = "qtd_produzida", n: int = 5
) -> DataFrame:
    """Products with the largest volume in the last year that has any."""
    recent = df.where(F.col("ano") == latest_year(df, quantity))
    volumes = recent.groupBy(product, "ano").agg(F.sum(quantity).alias(quantity))
    return top_by_value(volumes, n, quantity, ties=[product])


def processed_listing(df: DataFrame) -> DataFrame:
    return df.select(*LISTED).orderBy(F.col("ano").desc(), F.col("valor_producao_mil_reais").desc_nulls_last())


def collection_report(df: DataFrame, width: int | None = None) -> DataFrame:
    """Printable lines per product and year, with the number of rows collected.

    Names are whole; a printed report cuts them to its column `width`.
    """
    lines = df.select(
        (F.col("produto") if width is None else F.substring("produto", 1, width)).alias("produto"),
        F.col("ano").cast("string").alias("ano"),
        thousands(F.col("qtd_produzida"), 0, missing="—").alias("qtd_texto"),
        thousands(F.col("valor_producao_mil_reais"), 0, missing="—").alias("valor_texto"),
    )
    return lines.withColumn("total_linhas", df.agg(F.count(F.lit(1))).scalar())


def collection_totals(wide: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows of the wide table beside the long cells they came from."""
    return wide.agg(F.count(F.lit(1)).alias("linhas")).withColumn(
        "celulas", cells.agg(F.count(F.lit(1))).scalar()
    )


def status_counts(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("status_dado").agg(F.count(F.lit(1)).alias("total")).orderBy("status_dado")
    )


def distinct_name_map(df: DataFrame) -> DataFrame:
    return (
        df.select(
            F.col("produto").alias("nome_padronizado"),
            F.col("produto_nome_ibge").alias("nome_original_ibge"),
            "produto_cod",
        )
        .distinct()
        .orderBy("nome_padronizado")
    )


def filter_options(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Distinct non-NULL values for a selection list."""
    options = df.select(column).na.drop().distinct()
    return options.orderBy(F.col(column).desc() if descending else F.col(column).asc())
