"""Descriptive statistics, changes over time, trends and outliers over whole tables."""

from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark.functions.text import lookup_or
from cropspark.operators import quality, stats
from cropspark.plans import roles as r
from cropspark.plans.registry import query

_VALUE = "valor_producao_mil_reais"
_YIELD = "rendimento_medio_kg_ha"
_QUANTITY = "qtd_produzida"


def one_year(spark, folder):
    return r.doubles(r.stored_wide(spark, folder, r.YEAR))


def _sql_year(extra: str = "") -> str:
    return f"""{r.SQL_WIDE}, ano_unico AS (SELECT produto, nome_territorial, {r.sql_doubles()}
      FROM wide WHERE ano = {r.YEAR} {extra})"""


_SQL_MELTED = " UNION ALL ".join(
    f"SELECT '{m}' AS coluna, produto, {m} AS valor FROM ano_unico" for m in fv.METRICS
)


def _sql_describe(source: str, places: int = 2) -> str:
    shown = {
        "media": "avg(valor)", "mediana": "quantile_cont(valor, 0.5)", "desvio_padrao": "stddev_samp(valor)",
        "minimo": "min(valor)", "maximo": "max(valor)", "q1": "quantile_cont(valor, 0.25)",
        "q3": "quantile_cont(valor, 0.75)",
    }
    columns = ", ".join(f"{r.sql_round(e, places)} AS {n}" for n, e in shown.items())
    return f"SELECT coluna, count(valor) AS registros, {columns} FROM ({source}) GROUP BY coluna"


@query("describe_metrics", sql=f"WITH {_sql_year()} {_sql_describe(_SQL_MELTED)}")
def describe_metrics(spark, folder):
    return stats.describe_metrics(one_year(spark, folder))


_LINE_METRICS = ["l_quantity", "l_extendedprice", "l_tax"]


@query(
    "describe_line_items",
    sql=_sql_describe(
        " UNION ALL ".join(f"SELECT '{m}' AS coluna, {m} AS valor FROM lineitem" for m in _LINE_METRICS)
    ),
)
def describe_line_items(spark, folder):
    """The same statistics over every line item."""
    return stats.describe_metrics(r.table(spark, folder, "lineitem"), _LINE_METRICS)


@query(
    "summary_by_commodity",
    sql=f"""WITH {r.SQL_FACT}
      SELECT id_commodity, CAST(min({_VALUE}) AS DOUBLE) AS minimo, CAST(max({_VALUE}) AS DOUBLE) AS maximo,
        round(avg(CAST({_VALUE} AS DOUBLE)), 6) AS media,
        round(stddev_samp(CAST({_VALUE} AS DOUBLE)), 3) AS desvio_padrao
      FROM fato GROUP BY id_commodity""",
)
def summary_by_commodity(spark, folder):
    rows = r.doubles(r.fact(spark, folder), [_VALUE])
    summary = stats.summary_by(rows, ["id_commodity"], _VALUE)
    return summary.withColumns(
        {"media": F.round("media", 6), "desvio_padrao": F.round("desvio_padrao", 3)}
    )


_SQL_YOY = f"""medias AS (SELECT id_commodity, ano, avg(CAST({_VALUE} AS DOUBLE)) AS m FROM fato GROUP BY 1, 2),
  com_anterior AS (SELECT id_commodity, ano, m,
    lag(m) OVER (PARTITION BY id_commodity ORDER BY ano) AS anterior FROM medias)"""


@query(
    "yoy_lag",
    sql=f"""WITH {r.SQL_FACT}, {_SQL_YOY}
      SELECT id_commodity, ano, round(m, 6) AS preco_medio, round(anterior, 6) AS preco_anterior FROM com_anterior""",
)
def yoy_lag(spark, folder):
    means = stats.mean_with_previous(r.doubles(r.fact(spark, folder), [_VALUE]))
    return means.withColumns({c: F.round(c, 6) for c in ("preco_medio", "preco_anterior")})


@query(
    "yoy_pct_change",
    sql=f"""WITH {r.SQL_FACT}, {_SQL_YOY}
      SELECT id_commodity, ano, round(m, 6) AS preco_medio, round(anterior, 6) AS preco_anterior,
        round((m - anterior) * 100 / nullif(anterior, 0), 6) AS variacao_pct FROM com_anterior""",
)
def yoy_pct_change(spark, folder):
    changes = stats.change_on_previous(r.doubles(r.fact(spark, folder), [_VALUE]))
    return changes.withColumns(
        {
            "preco_medio": F.round("preco_medio", 6),
            "preco_anterior": F.round("preco_anterior", 6),
            "variacao_pct": F.round("variacao_pct", 6),
        }
    )


def _sql_line(source: str) -> str:
    return f"""reta AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b, min(x) AS x0, max(x) AS x1 FROM ({source}))
      SELECT CAST(i AS INTEGER) AS ponto, round(x0 + i * ((x1 - x0) / 99), 2) AS x,
        round(b + a * (x0 + i * ((x1 - x0) / 99)), 2) AS y FROM reta, range(100) AS t(i)"""


@query(
    "trend_line",
    sql=f"""WITH {r.SQL_WIDE}, """
    + _sql_line(
        f"""SELECT CAST(sum(area_colhida_ha) AS DOUBLE) AS x, CAST(sum({_VALUE}) AS DOUBLE) AS y
          FROM wide GROUP BY produto"""
    ),
)
def trend_line(spark, folder):
    points = stats.trend_line(r.wide(spark, folder), "produto", "area_colhida_ha", _VALUE)
    return points.withColumns({"x": F.round("x", 2), "y": F.round("y", 2)})


@query(
    "trend_line_rows",
    sql=f"WITH {_sql_year()}, " + _sql_line(f"SELECT area_colhida_ha AS x, {_VALUE} AS y FROM ano_unico"),
)
def trend_line_rows(spark, folder):
    """The line fitted on the row pairs of one year."""
    points = stats.line_points(one_year(spark, folder), "area_colhida_ha", _VALUE)
    return points.withColumns({"x": F.round("x", 2), "y": F.round("y", 2)})


@query(
    "yield_refs_year",
    sql=f"""WITH {_sql_year()}
      SELECT produto, {_YIELD}, round((SELECT avg({_YIELD}) FROM ano_unico), 8) AS media,
        round((SELECT quantile_cont({_YIELD}, 0.5) FROM ano_unico), 8) AS mediana FROM ano_unico""",
)
def yield_refs_year(spark, folder):
    rows = stats.row_values_with_references(one_year(spark, folder), "produto", _YIELD)
    return rows.withColumns({c: F.round(c, 8) for c in ("media", "mediana")})


@query(
    "value_ranking_year",
    sql=f"""WITH {_sql_year()}
      SELECT produto, {_VALUE}, (SELECT max({_VALUE}) FROM ano_unico) AS maximo,
        {_VALUE} / 1e6 AS valor_milhoes FROM ano_unico""",
)
def value_ranking_year(spark, folder):
    return stats.value_ranking(one_year(spark, folder), "produto", _VALUE)


def _sql_box(source: str, group: str) -> str:
    return f"""caixas AS (SELECT {group}, count(v) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2,
        quantile_cont(v, 0.75) AS q3 FROM ({source}) GROUP BY {group}),
      linhas AS (SELECT s.{group} AS {group}, v, n, q1, q2, q3,
        v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS dentro
        FROM ({source}) s JOIN caixas c ON s.{group} = c.{group})
      SELECT {group}, max(n) AS registros, round(max(q1), 6) AS q1, round(max(q2), 6) AS mediana,
        round(max(q3), 6) AS q3, min(v) FILTER (WHERE dentro) AS haste_inferior,
        max(v) FILTER (WHERE dentro) AS haste_superior, count(*) FILTER (WHERE NOT dentro) AS outliers
      FROM linhas GROUP BY {group}"""


@query(
    "boxplot_stats",
    sql=f"WITH {_sql_year()}, " + _sql_box(f"SELECT produto, {_QUANTITY} AS v FROM ano_unico", "produto"),
)
def boxplot_stats(spark, folder):
    boxes = stats.boxplot_stats(one_year(spark, folder), "produto", _QUANTITY)
    return boxes.withColumns({c: F.round(c, 6) for c in ("q1", "mediana", "q3")})


@query(
    "boxplot_events",
    sql="WITH " + _sql_box("SELECT event_type, value AS v FROM events", "event_type"),
)
def boxplot_events(spark, folder):
    """Box figures of every event value, per event type."""
    boxes = stats.boxplot_stats(r.table(spark, folder, "events"), "event_type", "value")
    return boxes.withColumns({c: F.round(c, 6) for c in ("q1", "mediana", "q3")})


# --- outliers ----------------------------------------------------------------------


@query(
    "outliers_iqr",
    sql=f"""WITH {_sql_year()}, valores AS ({_SQL_MELTED}),
      cercas AS (SELECT coluna, quantile_cont(valor, 0.25) AS q1, quantile_cont(valor, 0.75) AS q3
        FROM valores GROUP BY coluna)
      SELECT {r.sql_case(fv.CHART_LABELS, 'produto', 'produto')} AS produto_label, valor, coluna
      FROM valores JOIN cercas USING (coluna)
      WHERE valor < q1 - 1.5 * (q3 - q1) OR valor > q3 + 1.5 * (q3 - q1)""",
)
def outliers_iqr(spark, folder):
    labelled = one_year(spark, folder).withColumn(
        "produto_label", lookup_or(F.col("produto"), fv.CHART_LABELS, F.col("produto"))
    )
    return quality.outliers_iqr(labelled.na.drop(subset=[_QUANTITY]), "produto_label")


@query(
    "outliers_iqr_events",
    sql="""WITH cercas AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
      SELECT event_type, value AS valor, 'value' AS coluna FROM events, cercas
      WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
)
def outliers_iqr_events(spark, folder):
    """Outliers among all event values."""
    return quality.outliers_iqr(r.table(spark, folder, "events"), "event_type", ["value"])


@query(
    "outliers_p95",
    sql="""WITH limites AS (SELECT event_type, quantile_cont(value, 0.95) AS p95 FROM events GROUP BY event_type)
      SELECT event_id, event_type, value FROM events JOIN limites USING (event_type) WHERE value > p95""",
)
def outliers_p95(spark, folder):
    flagged = quality.flag_above_percentile(r.table(spark, folder, "events"), "event_type", "value")
    return flagged.where("acima_p95").select("event_id", "event_type", "value")
