"""Counts taken in flight or from footers, and aggregates that are kept from batch to batch."""

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropspark.operators import kept, observed, rows
from cropspark.plans import cleaning, loads  # noqa: F401  (the validation's SQL is registered there)
from cropspark.plans import roles as r
from cropspark.plans.registry import oracles, query
from cropspark.session import scratch_path
from cropspark.sources import footers, lake


@query("observed_validation", sql=oracles()["validation_report"])
def observed_validation(spark, folder):
    """The report of the validation, counted by the job that writes the valid rows."""
    path = scratch_path(spark, "valid")
    typed = rows.coerce_types(r.raw_lines(spark, folder))
    return observed.write_validated(typed, lambda df: df.write.parquet(path))


@query(
    "fact_load_totals",
    sql=f"""WITH {r.SQL_WIDE}, {r.SQL_DIM_COMMODITY}, {r.SQL_DIM_TERRITORY}, achadas AS (
        SELECT id_commodity, id_territorio FROM wide
        LEFT JOIN (SELECT * FROM dim_commodity WHERE codigo_sidra <> '40130') c ON produto_cod = codigo_sidra
        LEFT JOIN (SELECT * FROM dim_territorio WHERE nome <> 'NATION_5') t
          ON cod_territorial = codigo_ibge AND wide.nivel_territorial = t.nivel_territorial)
      SELECT 'carregadas' AS situacao, count(*) FILTER (WHERE id_commodity IS NOT NULL AND id_territorio IS NOT NULL) AS total FROM achadas
      UNION ALL SELECT 'ignoradas', count(*) FILTER (WHERE id_commodity IS NULL OR id_territorio IS NULL) FROM achadas
      UNION ALL SELECT 'sem produto', count(*) FILTER (WHERE id_commodity IS NULL) FROM achadas
      UNION ALL SELECT 'sem território', count(*) FILTER (WHERE id_territorio IS NULL) FROM achadas
      UNION ALL SELECT 'lidas', count(*) FROM achadas
      UNION ALL SELECT 'na tabela', count(*) FILTER (WHERE id_commodity IS NOT NULL AND id_territorio IS NOT NULL) FROM achadas""",
)
def fact_load_totals(spark, folder):
    """Loaded and skipped rows of a fact load, and what the table then holds by its footers."""
    path = scratch_path(spark, "fact")
    products = r.dim_commodity(spark, folder).where(F.col("codigo_sidra") != "40130")
    places = r.dim_territory(spark, folder).where(F.col("nome") != "NATION_5")
    report = observed.write_fact(r.wide(spark, folder), products, places, lambda df: df.write.parquet(path))
    return report.unionAll(footers.table_counts(spark, {"na tabela": path}))


_COUNTED = ["orders", "lineitem", "events", "part", "supplier", "customer"]


@query("footer_counts", sql=" UNION ALL ".join(f"SELECT '{t}' AS tabela, count(*) AS total FROM {t}" for t in _COUNTED))
def footer_counts(spark, folder):
    return footers.table_counts(spark, {t: f"{folder}/{t}.parquet" for t in _COUNTED})


@query(
    "footer_latest_year",
    sql=f"""WITH {r.SQL_FACT} SELECT 'todas' AS linhas, CAST(max(ano) AS INTEGER) AS ultimo_ano FROM fato
      UNION ALL SELECT 'até 1997', CAST(max(ano) AS INTEGER) FROM fato WHERE ano <= 1997""",
)
def footer_latest_year(spark, folder):
    """The latest year of a stored fact, by footers; of some of its rows, by reading one column."""
    path = scratch_path(spark, "fact")
    r.fact(spark, folder).write.parquet(path)
    found = [("todas", footers.latest(spark, path)), ("até 1997", footers.latest(spark, path, where=F.col("ano") <= 1997))]
    return spark.createDataFrame(found, "linhas string, ultimo_ano int")


# --- kept aggregates ---------------------------------------------------------------

_CENTS = "centavos"


def _with_cents(df: DataFrame) -> DataFrame:
    return df.withColumn(_CENTS, (F.col("qtd_produzida") * 100).cast("bigint"))


def _two_batches(spark, folder, keys, state, codes=None):
    """Years up to 1999 and then 1999 on with doubled metrics, in a table by year; the kept state after both."""
    base, batch = loads.base_and_batch(r.stored_wide(spark, folder))
    table, path = scratch_path(spark, "by-year"), scratch_path(spark, "kept")
    known = None
    for part in (base, batch):
        part = _with_cents(part)
        if codes is not None:
            known = kept.numbered(part, known, codes)
            part = part.join(known, codes)
        lake.write_lake(part, table, ["ano"], touched_only=True)
        kept.refresh(spark, path, lake.read_lake(spark, table), part, keys, state)
    return kept.read(spark, path)


_SQL_AFTER = f"""{r.SQL_WIDE}, depois AS (SELECT produto, produto_cod, ano,
  CAST(qtd_produzida * 100 * CASE WHEN ano >= {r.YEAR} THEN 2 ELSE 1 END AS BIGINT) AS {_CENTS} FROM wide)"""
_SQL_MOMENTS = f"""count({_CENTS}) AS n, CAST(sum({_CENTS}) AS DOUBLE) AS soma, CAST(sum({_CENTS}) AS DOUBLE) / count({_CENTS}) AS media,
  round(stddev_samp({_CENTS}) / 1e4, 2) AS desvio_padrao, CAST(min({_CENTS}) AS DOUBLE) AS minimo, CAST(max({_CENTS}) AS DOUBLE) AS maximo"""


@query(
    "kept_summary",
    sql=f"""WITH {_SQL_AFTER} SELECT produto, NULL::INTEGER AS ano, {_SQL_MOMENTS} FROM depois GROUP BY produto
      UNION ALL SELECT NULL, ano, {_SQL_MOMENTS} FROM depois GROUP BY ano""",
)
def kept_summary(spark, folder):
    """Summary by product over all years and by year over all products, from state by both."""
    state = _two_batches(spark, folder, ["produto"], kept.moments(_CENTS))
    parts = [kept.merged_moments(state, [c]) for c in ("produto", "ano")]
    both = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.select(
        "produto", F.col("ano").cast("int").alias("ano"), "n", "soma", "media",
        F.round(F.col("desvio_padrao") / 1e4, 2).alias("desvio_padrao"), "minimo", "maximo",
    )


@query("kept_quartiles")
def kept_quartiles(spark, folder):
    """Quartiles of each product over all years by merged sketches; tests hold their rank error."""
    state = _two_batches(spark, folder, ["produto"], kept.sketch(_CENTS))
    return kept.merged_quantiles(state, {"q1": 0.25, "mediana": 0.5, "q3": 0.75, "p95": 0.95}, ["produto"])


@query(
    "kept_distinct",
    sql=f"""WITH {_SQL_AFTER} SELECT CAST(ano AS INTEGER) AS ano, count(DISTINCT produto_cod) AS distintos FROM depois GROUP BY ano
      UNION ALL SELECT NULL, count(DISTINCT produto_cod) FROM depois""",
)
def kept_distinct(spark, folder):
    """Distinct products by year and over all years, by bitmaps of numbered codes."""
    state = _two_batches(spark, folder, [kept.bit_bucket("numero")], kept.bits("numero"), codes="produto_cod")
    by_year = kept.merged_distinct(state, ["ano"]).select(F.col("ano").cast("int").alias("ano"), "distintos")
    return by_year.unionAll(kept.merged_distinct(state).select(F.lit(None).cast("int").alias("ano"), "distintos"))
