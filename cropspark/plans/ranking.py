"""Star-schema listings, rankings and dashboard aggregates over whole tables."""

from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark.operators import reports, stats
from cropspark.operators.rows import filter_isin
from cropspark.plans import roles as r
from cropspark.plans.registry import query

_VALUE = "valor_producao_mil_reais"


def star(spark, folder, fact=r.fact):
    return (
        fact(spark, folder),
        r.dim_commodity(spark, folder),
        r.dim_territory(spark, folder),
    )


def one_year_fact(spark, folder):
    return r.fact(spark, folder, r.YEAR)


@query(
    "top5_latest_year",
    sql=f"""WITH {r.SQL_STAR}
      SELECT nome_oficial, nome, ano, CAST(qtd_produzida AS DOUBLE) AS qtd_produzida,
        CAST({_VALUE} AS DOUBLE) AS {_VALUE}
      FROM fato JOIN dim_commodity USING (id_commodity) JOIN dim_territorio USING (id_territorio)
      WHERE ano = (SELECT max(ano) FROM fato WHERE qtd_produzida IS NOT NULL) AND {_VALUE} IS NOT NULL
      ORDER BY {_VALUE} DESC, nome_oficial, nome LIMIT 5""",
)
def top5_latest_year(spark, folder):
    top = reports.top_latest_year(*star(spark, folder, r.stored_fact))
    return r.doubles(top, ["qtd_produzida", _VALUE])


@query(
    "top5_fixed_year",
    sql=f"""WITH {r.SQL_STAR}
      SELECT nome_oficial AS produto, id_territorio, ano, CAST(qtd_produzida AS DOUBLE) AS qtd_produzida,
        CAST({_VALUE} AS DOUBLE) AS {_VALUE}
      FROM fato JOIN dim_commodity USING (id_commodity)
      WHERE ano = {r.YEAR} AND {_VALUE} IS NOT NULL
      ORDER BY {_VALUE} DESC, produto, id_territorio LIMIT 5""",
)
def top5_fixed_year(spark, folder):
    fact, products, _ = star(spark, folder, one_year_fact)
    return r.doubles(reports.top_fixed_year(fact, products, r.YEAR), ["qtd_produzida", _VALUE])


_SQL_LISTING = f"""SELECT nome_oficial AS produto, nome AS territorio, ano, {r.sql_doubles()}, coletado_em
  FROM fato JOIN dim_commodity USING (id_commodity) JOIN dim_territorio USING (id_territorio)"""


@query("star_listing", sql=f"WITH {r.SQL_STAR} {_SQL_LISTING}")
def star_listing(spark, folder):
    return r.doubles(reports.star_listing(*star(spark, folder)))


@query(
    "star_listing_selected",
    sql=f"""WITH {r.SQL_STAR} {_SQL_LISTING}
      WHERE ano = {r.YEAR} AND codigo_sidra IN ('40124', '40125')""",
)
def star_listing_selected(spark, folder):
    """Two products in one year, the example listing of the relational model."""
    chosen = reports.selected_products(*star(spark, folder, one_year_fact), codes=["40124", "40125"], year=r.YEAR)
    return r.doubles(chosen)


@query(
    "top5_volume_last_year",
    sql=f"""WITH {r.SQL_WIDE}
      SELECT produto, ano, CAST(sum(qtd_produzida) AS DOUBLE) AS qtd_produzida FROM wide
      WHERE ano = (SELECT max(ano) FROM wide WHERE qtd_produzida IS NOT NULL)
      GROUP BY produto, ano ORDER BY sum(qtd_produzida) DESC, produto LIMIT 5""",
)
def top5_volume_last_year(spark, folder):
    return r.doubles(reports.top_volume_last_year(r.stored_wide(spark, folder)), ["qtd_produzida"])


@query(
    "collection_report",
    sql=f"""WITH {r.SQL_WIDE}
      SELECT produto[1:34] AS produto, CAST(ano AS VARCHAR) AS ano,
        CASE WHEN cod_territorial = '7' THEN '—' ELSE format('{{:,.0f}}', CAST(qtd_produzida AS DOUBLE)) END
          AS qtd_texto,
        format('{{:,.0f}}', CAST({_VALUE} AS DOUBLE)) AS valor_texto,
        (SELECT count(*) FROM wide) AS total_linhas FROM wide""",
)
def collection_report(spark, folder):
    rows = r.doubles(r.stored_wide(spark, folder)).withColumn(
        "qtd_produzida", F.when(F.col("cod_territorial") != "7", F.col("qtd_produzida"))
    )
    return reports.collection_report(rows, width=34)


# --- dashboard -------------------------------------------------------------------


@query(
    "sum_by_product",
    sql=f"""WITH {r.SQL_WIDE} SELECT produto, CAST(sum(qtd_produzida) AS DOUBLE) AS qtd_produzida
      FROM wide GROUP BY produto""",
)
def sum_by_product(spark, folder):
    return r.doubles(stats.sum_by(r.wide(spark, folder), "produto", "qtd_produzida"), ["qtd_produzida"])


@query(
    "share_of_total",
    sql=f"""WITH {r.SQL_WIDE}, somas AS (SELECT produto, sum(area_colhida_ha) AS s FROM wide GROUP BY produto)
      SELECT produto, CAST(s AS DOUBLE) AS area_colhida_ha,
        CAST(s AS DOUBLE) / CAST((SELECT sum(s) FROM somas) AS DOUBLE) AS participacao FROM somas""",
)
def share_of_total(spark, folder):
    rows = r.doubles(r.stored_wide(spark, folder), ["area_colhida_ha"])  # whole numbers: exact sums
    return stats.share_of_total(rows, "produto", "area_colhida_ha")


_YIELD = "rendimento_medio_kg_ha"


@query(
    "mean_by_product_refs",
    sql=f"""WITH {r.SQL_WIDE}, medias AS (SELECT produto, avg(CAST({_YIELD} AS DOUBLE)) AS m FROM wide GROUP BY produto)
      SELECT produto, round(m, 8) AS {_YIELD}, round((SELECT avg(m) FROM medias), 8) AS media,
        round((SELECT quantile_cont(m, 0.5) FROM medias), 8) AS mediana FROM medias""",
)
def mean_by_product_refs(spark, folder):
    means = stats.mean_by_with_references(
        r.doubles(r.stored_wide(spark, folder), [_YIELD]), "produto", _YIELD
    )
    return means.select("produto", *[F.round(c, 8).alias(c) for c in (_YIELD, "media", "mediana")])


@query(
    "kpi_summary",
    sql=f"""WITH {r.SQL_WIDE}, t AS (SELECT coalesce(sum(qtd_produzida), 0) AS q, coalesce(sum(area_colhida_ha), 0) AS a,
        coalesce(sum({_VALUE}), 0) AS v, count(DISTINCT produto) AS n FROM wide WHERE ano IN ({r.YEAR}, {r.YEAR + 1}))
      SELECT CAST(q AS DOUBLE) AS total_producao, CAST(a AS DOUBLE) AS total_area, CAST(v AS DOUBLE) AS total_valor,
        n AS num_produtos, CASE WHEN a > 0 THEN round(CAST(q AS DOUBLE) / CAST(a AS DOUBLE), 6) ELSE 0 END AS quantidade_por_area,
        {r.sql_round('(CAST(q AS DOUBLE) / 1e6)', 1)} AS producao_milhoes,
        {r.sql_round('(CAST(a AS DOUBLE) / 1e6)', 1)} AS area_milhoes,
        {r.sql_round('(CAST(v AS DOUBLE) / 1e6)', 0)} AS valor_milhoes FROM t""",
)
def kpi_summary(spark, folder):
    chosen = filter_isin(r.wide(spark, folder), {"ano": [r.YEAR, r.YEAR + 1], "produto": []})
    cards = stats.kpi_summary(chosen)
    totals = r.doubles(cards, ["total_producao", "total_area", "total_valor", "quantidade_por_area",
                               "producao_milhoes", "area_milhoes", "valor_milhoes"])
    return totals.withColumn("quantidade_por_area", F.round("quantidade_por_area", 6))


_Q, _A = fv.QUANTITY_LABEL, fv.PLANTED_AREA_LABEL
_SQL_Q = f"sum(valor) FILTER (WHERE variavel = '{_Q}')"
_SQL_A = f"sum(valor) FILTER (WHERE variavel = '{_A}')"


@query(
    "long_kpis",
    sql=f"""WITH {r.SQL_LONG}, t AS (SELECT coalesce({_SQL_Q}, 0) AS q, coalesce({_SQL_A}, 0) AS a,
        count(DISTINCT produto) AS n FROM longo)
      SELECT CAST(q AS DOUBLE) AS total_producao, CAST(a AS DOUBLE) AS total_area, n AS num_produtos,
        CASE WHEN a > 0 THEN round(CAST(q AS DOUBLE) / CAST(a AS DOUBLE), 6) ELSE 0 END AS rendimento_medio FROM t""",
)
def long_kpis(spark, folder):
    cards = stats.long_kpis(r.long_form(spark, folder))
    cards = r.doubles(cards, ["total_producao", "total_area", "rendimento_medio"])
    return cards.withColumn("rendimento_medio", F.round("rendimento_medio", 6))


@query(
    "top10_by_variable",
    sql=f"""WITH {r.SQL_LONG}, somas AS (SELECT variavel, produto, sum(valor) AS s,
        row_number() OVER (PARTITION BY variavel ORDER BY sum(valor) DESC, produto) AS pos
        FROM longo WHERE variavel IN ('{_Q}', '{_A}') GROUP BY variavel, produto)
      SELECT variavel, produto, CAST(s AS DOUBLE) AS valor FROM somas WHERE pos <= 10""",
)
def top10_by_variable(spark, folder):
    long = r.long_form(spark, folder)

    def top(label):
        best = stats.top_by_variable(long, label)
        return best.select(F.lit(label).alias("variavel"), "produto", F.col("valor").cast("double"))

    return top(_Q).unionAll(top(_A))


@query(
    "yield_by_product",
    sql=f"""WITH {r.SQL_LONG}, somas AS (SELECT produto, {_SQL_Q} AS q, {_SQL_A} AS a FROM longo GROUP BY produto)
      SELECT produto, round(CAST(q AS DOUBLE) / CAST(a AS DOUBLE), 6) AS rendimento FROM somas
      WHERE q IS NOT NULL AND a IS NOT NULL AND a <> 0
      ORDER BY CAST(q AS DOUBLE) / CAST(a AS DOUBLE) DESC, produto LIMIT 10""",
)
def yield_by_product(spark, folder):
    best = stats.yield_by_product(r.long_form(spark, folder))
    return best.select("produto", F.round(F.col("rendimento").cast("double"), 6).alias("rendimento"))
