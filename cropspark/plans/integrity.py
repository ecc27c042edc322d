"""Anomaly, integrity and constraint reports over whole tables."""

import functools

from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark.operators import quality, rows
from cropspark.plans import roles as r
from cropspark.plans.registry import query
from cropspark.session import written_once

_VALUE = "valor_producao_mil_reais"


def line_metrics(spark, folder):
    """Line items as metric rows: zero tax, zero discount and returned amounts occur."""
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    return r.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        F.col("l_quantity").alias("area_colhida_ha"),
        signed.alias("qtd_produzida"),
        F.col("l_discount").alias(_VALUE),
        F.nullif("l_tax", F.lit(0.02)).alias("rendimento_medio_kg_ha"),
    )


_SQL_LINE_METRICS = f"""medidas AS (SELECT l_orderkey, l_returnflag, l_quantity AS area_colhida_ha,
  CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS qtd_produzida,
  l_discount AS {_VALUE}, nullif(l_tax, 0.02) AS rendimento_medio_kg_ha FROM lineitem)"""

_SQL_CATEGORY = (
    "CASE "
    + " ".join(f"WHEN {m} <= 0 THEN '{name}'" for m, name in fv.ANOMALY_CATEGORIES)
    + f" ELSE '{fv.VALID_CATEGORY}' END"
)


@query(
    "anomaly_summary",
    sql=f"""WITH {_SQL_LINE_METRICS}, t AS (SELECT {_SQL_CATEGORY} AS categoria, count(*) AS n FROM medidas GROUP BY 1)
      SELECT categoria, n AS total_registros,
        CAST((n * 20000 + (SELECT sum(n) FROM t)) // (2 * (SELECT sum(n) FROM t)) AS DOUBLE) / 100 AS percentual
      FROM t""",
)
def anomaly_summary(spark, folder):
    return quality.anomaly_summary(line_metrics(spark, folder))


_CEILING = 2_000_000.0


@query(
    "anomaly_rows",
    sql=f"""WITH {_SQL_LINE_METRICS} SELECT l_orderkey, area_colhida_ha, qtd_produzida FROM medidas
      WHERE area_colhida_ha < 0 OR qtd_produzida < 0
        OR qtd_produzida * 1000 / nullif(area_colhida_ha, 0) > {_CEILING}""",
)
def anomaly_rows(spark, folder):
    found = quality.anomaly_rows(line_metrics(spark, folder), ceiling=_CEILING)
    return found.select("l_orderkey", "area_colhida_ha", "qtd_produzida")


_SQL_P95 = """limites AS (SELECT l_returnflag, quantile_cont(qtd_produzida, 0.95) AS p95 FROM medidas GROUP BY 1)"""
_SQL_RULES = {
    **{f"{m} negativo": f"{m} < 0" for m in fv.METRICS},
    "area_colhida_ha fora da faixa": "area_colhida_ha < 2 OR area_colhida_ha > 49",
    "acima do percentil 95": "qtd_produzida > p95",
    "rendimento inconsistente": f"qtd_produzida * 1000 / nullif(area_colhida_ha, 0) > {_CEILING}",
}


@query(
    "anomaly_counts_by_type",
    sql=f"WITH {_SQL_LINE_METRICS}, {_SQL_P95} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS tipo, count(*) FILTER (WHERE {rule}) AS total FROM medidas JOIN limites USING (l_returnflag)"
        for name, rule in _SQL_RULES.items()
    ),
)
def anomaly_counts_by_type(spark, folder):
    flagged = quality.flag_above_percentile(line_metrics(spark, folder), "l_returnflag", "qtd_produzida")
    rules = {
        **quality.negative_rules(),
        **quality.range_rules({"area_colhida_ha": (2, 49)}),
        "acima do percentil 95": F.col("acima_p95"),
        "rendimento inconsistente": quality.yield_per_area(F.col("qtd_produzida"), F.col("area_colhida_ha"))
        > _CEILING,
    }
    return quality.anomaly_counts(flagged, rules)


def _star_with_gaps(spark, folder):
    products = r.dim_commodity(spark, folder).where(F.col("codigo_sidra") != "40130")
    places = r.dim_territory(spark, folder).where(F.col("nome") != "NATION_5")
    return r.stored_fact(spark, folder), products, places


_SQL_GAPS = f"""{r.SQL_STAR}, produtos AS (SELECT * FROM dim_commodity WHERE codigo_sidra <> '40130'),
  lugares AS (SELECT * FROM dim_territorio WHERE nome <> 'NATION_5')"""


@query(
    "orphan_counts",
    sql=f"""WITH {_SQL_GAPS}
      SELECT 'fato → dim_commodity' AS verificacao, count(*) AS orfas FROM fato
        WHERE id_commodity NOT IN (SELECT id_commodity FROM produtos)
      UNION ALL SELECT 'fato → dim_territorio', count(*) FROM fato
        WHERE id_territorio NOT IN (SELECT id_territorio FROM lugares)
      UNION ALL SELECT 'lineitem → part', count(*) FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 7)""",
)
def orphan_counts(spark, folder):
    fact, products, places = _star_with_gaps(spark, folder)
    report = quality.orphan_counts(
        fact,
        {
            "fato → dim_commodity": ("id_commodity", products, "id_commodity"),
            "fato → dim_territorio": ("id_territorio", places, "id_territorio"),
        },
    )
    parts = r.table(spark, folder, "part").where(F.col("p_size") != 7)
    items = r.table(spark, folder, "lineitem")
    return report.unionAll(
        quality.orphan_counts(items, {"lineitem → part": ("l_partkey", parts, "p_partkey")})
    )


@query(
    "table_counts",
    sql=f"""WITH {r.SQL_STAR} SELECT 'dim_commodity' AS tabela, count(*) AS total FROM dim_commodity
      UNION ALL SELECT 'dim_territorio', count(*) FROM dim_territorio
      UNION ALL SELECT 'fato_producao', count(*) FROM fato""",
)
def table_counts(spark, folder):
    return quality.table_counts(
        {
            "dim_commodity": r.dim_commodity(spark, folder),
            "dim_territorio": r.dim_territory(spark, folder),
            "fato_producao": r.fact(spark, folder),
        }
    )


_LEVELS = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]
_STORED = ["produto", "produto_cod", "nivel_territorial", "cod_territorial", "nome_territorial", "ano", "unidade_qtd", "status_dado", "area_colhida_ha"]


def _sql_unique(table, keys):
    held = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    names = ", ".join(keys)
    return f"""SELECT '{table}' AS tabela, '{names} único' AS restricao, count(*) AS violacoes
      FROM (SELECT 1 FROM {table} WHERE {held} GROUP BY {names} HAVING count(*) > 1)"""


def _sql_rule(table, name, broken):
    return f"SELECT '{table}' AS tabela, '{name}' AS restricao, count(*) FILTER (WHERE {broken}) AS violacoes FROM {table}"


def _sql_reference(table, name, key, known):
    return f"SELECT '{table}' AS tabela, '{name}' AS restricao, count(*) AS violacoes FROM {table} WHERE {key} NOT IN ({known})"


_SQL_CONSTRAINTS = " UNION ALL ".join(
    [
        _sql_rule("linhas", "imposto não nulo", "imposto IS NULL"),
        _sql_rule("linhas", "ano entre 1974 e 2000", "NOT ano BETWEEN 1974 AND 2000"),
        _sql_rule("linhas", "imposto positivo", "NOT imposto > 0.01"),
        _sql_rule("linhas", "status na lista", "l_returnflag NOT IN ('A', 'N')"),
        _sql_unique("linhas", ["l_orderkey", "l_linenumber"]),
        _sql_reference("linhas", "l_partkey em part", "l_partkey", "SELECT p_partkey FROM part WHERE p_size <> 7"),
        _sql_reference("linhas", "l_suppkey em supplier", "l_suppkey", "SELECT s_suppkey FROM supplier WHERE s_nationkey <> 3"),
        _sql_rule("dim_commodity", "codigo_sidra não nulo", "codigo_sidra IS NULL"),
        _sql_rule("dim_commodity", "codigo_sidra numérico", "NOT regexp_full_match(codigo_sidra, '[0-9]+')"),
        _sql_rule("dim_commodity", "nome_oficial até 12 caracteres", "length(nome_oficial) > 12"),
        _sql_unique("dim_commodity", ["codigo_sidra"]),
        _sql_unique("dim_commodity", ["unidade_medida"]),
        _sql_rule("dim_territorio", "codigo_ibge não nulo", "codigo_ibge IS NULL"),
        _sql_rule("dim_territorio", "nome não nulo", "nome IS NULL"),
        _sql_rule("dim_territorio", "nivel_territorial na lista", f"nivel_territorial NOT IN ({', '.join(map(repr, _LEVELS))})"),
        _sql_rule("dim_territorio", "nome até 8 caracteres", "length(nome) > 8"),
        _sql_unique("dim_territorio", ["codigo_ibge", "nivel_territorial"]),
        _sql_unique("dim_territorio", ["nivel_territorial"]),
        _sql_rule("fato", "ano entre 1974 e 2100", "NOT ano BETWEEN 1974 AND 2100"),
        _sql_unique("fato", fv.FACT_KEYS),
        _sql_reference("fato", "id_commodity em dim_commodity", "id_commodity", "SELECT id_commodity FROM produtos"),
        _sql_reference("fato", "id_territorio em dim_territorio", "id_territorio", "SELECT id_territorio FROM lugares"),
        _sql_rule("processado", "unidade_qtd não nulo", "unidade_qtd IS NULL"),
        _sql_rule("processado", "area_colhida_ha não nulo", "area_colhida_ha IS NULL"),
        _sql_rule("processado", "ano entre 1974 e 2100", "NOT ano BETWEEN 1974 AND 2100"),
        _sql_rule("processado", "status_dado na lista", "status_dado NOT IN ('completo')"),
        _sql_rule("processado", "produto até 10 caracteres", "length(produto) > 10"),
        _sql_rule("processado", "nome_territorial até 8 caracteres", "length(nome_territorial) > 8"),
        _sql_unique("processado", fv.PROCESSED_KEYS),
    ]
)


@query(
    "constraint_report",
    sql=f"""WITH {r.SQL_PROCESSED}, fato AS (SELECT id_commodity, id_territorio, ano, count(*) AS n FROM lines GROUP BY ALL),
      {r.SQL_DIM_COMMODITY}, {r.SQL_DIM_TERRITORY}, produtos AS (SELECT * FROM dim_commodity WHERE codigo_sidra <> '40130'),
      lugares AS (SELECT * FROM dim_territorio WHERE nome <> 'NATION_5'),
      linhas AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_tax, 0) AS imposto,
        l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS ano FROM lineitem)
      {_SQL_CONSTRAINTS}""",
)
def constraint_report(spark, folder):
    """The rules of the line items, the star schema and the processed table."""
    items = r.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.nullif("l_tax", F.lit(0.0)).alias("imposto"), F.year("l_shipdate").alias("ano"),
    )
    parts = r.table(spark, folder, "part").where(F.col("p_size") != 7)
    suppliers = r.table(spark, folder, "supplier").where(F.col("s_nationkey") != 3)
    fact, products, places = _star_with_gaps(spark, folder)
    stored = written_once(rows.clean_rows(r.raw_lines(spark, folder), r.PROCESSED_AT).select(*_STORED), "processed")
    years = {"ano entre 1974 e 2100": F.col("ano").between(fv.YEAR_MIN, fv.YEAR_MAX)}
    reports = [
        quality.constraint_report(
            "linhas",
            items,
            not_null=["imposto"],
            checks={
                "ano entre 1974 e 2000": F.col("ano").between(1974, 2000),
                "imposto positivo": F.col("imposto") > 0.01,
                "status na lista": F.col("l_returnflag").isin("A", "N"),
            },
            unique=[["l_orderkey", "l_linenumber"]],
            references={"l_partkey em part": ("l_partkey", parts, "p_partkey"), "l_suppkey em supplier": ("l_suppkey", suppliers, "s_suppkey")},
        ),
        quality.constraint_report(
            "dim_commodity",
            r.dim_commodity(spark, folder),
            not_null=["codigo_sidra"],
            checks={"codigo_sidra numérico": F.col("codigo_sidra").rlike("^[0-9]+$")},
            lengths={"nome_oficial": 12},
            unique=[["codigo_sidra"], ["unidade_medida"]],
        ),
        quality.constraint_report(
            "dim_territorio",
            r.dim_territory(spark, folder),
            not_null=["codigo_ibge", "nome"],
            checks={"nivel_territorial na lista": F.col("nivel_territorial").isin(_LEVELS)},
            lengths={"nome": 8},
            unique=[["codigo_ibge", "nivel_territorial"], ["nivel_territorial"]],
        ),
        quality.constraint_report(
            "fato",
            fact,
            checks=years,
            unique=[fv.FACT_KEYS],
            references={
                "id_commodity em dim_commodity": ("id_commodity", products, "id_commodity"),
                "id_territorio em dim_territorio": ("id_territorio", places, "id_territorio"),
            },
        ),
        quality.constraint_report(
            "processado",
            stored,
            not_null=["unidade_qtd", "area_colhida_ha"],
            checks={**years, "status_dado na lista": F.col("status_dado").isin("completo")},
            lengths={"produto": 10, "nome_territorial": 8},
            unique=[fv.PROCESSED_KEYS],
        ),
    ]
    return functools.reduce(lambda a, b: a.unionAll(b), reports)
