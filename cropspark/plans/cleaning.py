"""Clean-up steps over whole tables."""

from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark import schemas
from cropspark.functions import numbers as num
from cropspark.functions.text import lookup_or
from cropspark.operators import reports, rows
from cropspark.plans import roles as r
from cropspark.plans.registry import query
from cropspark.session import scratch_path, written_once
from cropspark.sources.snapshots import first_available, parse_snapshot_name, read_csv, snapshot_name, write_csv

_CODES = "produto_cod, tabela_sidra, cod_territorial"
_METRICS = ", ".join(fv.METRICS)


def processed(spark, folder):
    return r.raw_lines(spark, folder).transform(rows.clean_rows, processed_at=r.PROCESSED_AT)


# --- projections and filters -------------------------------------------------


@query("project_ordered", sql="SELECT c_custkey, c_name, c_acctbal FROM customer")
def project_ordered(spark, folder):
    wanted = ["c_custkey", "c_absent", "c_name", "c_acctbal"]
    return rows.project_ordered(r.table(spark, folder, "customer"), wanted)


@query(
    "rename_if_present",
    sql="""SELECT event_type AS produto, CAST(value AS DECIMAL(18,2)) AS valor, user_id FROM events""",
)
def rename_if_present(spark, folder):
    landed = r.table(spark, folder, "events").select(
        F.col("event_type").alias("Produto das lavouras temporárias"),
        F.col("value").cast(r.MONEY).alias("Valor"),
        "user_id",
    )
    return rows.rename_if_present(landed)


@query(
    "add_lineage",
    sql=f"""SELECT o_orderkey, o_orderstatus, TIMESTAMP '{r.PROCESSED_AT}' AS processado_em,
      '1.0' AS versao_etl FROM orders""",
)
def add_lineage(spark, folder):
    orders = r.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return rows.add_lineage(orders, r.PROCESSED_AT)


@query(
    "filter_isin",
    sql="""SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
      WHERE o_orderstatus IN ('F', 'P')""",
)
def filter_isin(spark, folder):
    orders = r.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return rows.filter_isin(orders, {"o_orderstatus": ["F", "P"], "o_orderpriority": []})


_SQL_GAPS = """lacunas AS (SELECT l_orderkey, l_linenumber,
  CAST(nullif(l_discount, 0) AS DECIMAL(5,2)) AS desconto,
  CAST(nullif(l_tax, 0) AS DECIMAL(5,2)) AS imposto FROM lineitem)"""


def gaps(spark, folder):
    """Line items whose zero discount and zero tax are read as missing."""
    return r.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_discount", F.lit(0.0)).cast("decimal(5,2)").alias("desconto"),
        F.nullif("l_tax", F.lit(0.0)).cast("decimal(5,2)").alias("imposto"),
    )


@query(
    "dropna_any_all",
    sql=f"""WITH {_SQL_GAPS}
      SELECT 'any' AS modo, count(*) AS linhas, sum(l_orderkey)::BIGINT AS soma FROM lacunas
        WHERE desconto IS NOT NULL AND imposto IS NOT NULL
      UNION ALL
      SELECT 'all', count(*), sum(l_orderkey)::BIGINT FROM lacunas
        WHERE desconto IS NOT NULL OR imposto IS NOT NULL""",
)
def dropna_any_all(spark, folder):
    rows_ = gaps(spark, folder)
    checked = ["desconto", "imposto"]

    def summed(mode, df):
        return df.agg(F.count(F.lit(1)).alias("linhas"), F.sum("l_orderkey").alias("soma")).select(
            F.lit(mode).alias("modo"), "linhas", "soma"
        )

    return summed("any", rows.drop_any_null(rows_, checked)).unionAll(
        summed("all", rows.drop_all_null(rows_, checked))
    )


@query(
    "null_profile",
    sql=f"""WITH {_SQL_GAPS}
      SELECT 'desconto' AS coluna, count(*) FILTER (WHERE desconto IS NULL) AS nulos FROM lacunas
      UNION ALL SELECT 'imposto', count(*) FILTER (WHERE imposto IS NULL) FROM lacunas""",
)
def null_profile(spark, folder):
    return rows.null_profile(gaps(spark, folder), ["desconto", "imposto"])


# --- scalar functions ----------------------------------------------------------


@query(
    "parse_locale_number",
    sql="""SELECT o_orderkey,
      CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN NULL WHEN '3-MEDIUM' THEN NULL
        ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS valor,
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN NULL
        ELSE CAST(replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', '') AS DOUBLE)
        END AS valor_com_ponto FROM orders""",
)
def parse_locale_number(spark, folder):
    """Prices as local text with marks, read back; and point decimals read as local text."""
    price = F.col("o_totalprice").cast(r.MONEY)
    mark = F.col("o_orderpriority")

    def marked(text):
        return (
            F.when(mark == "1-URGENT", "-")
            .when(mark == "2-HIGH", " ... ")
            .when(mark == "3-MEDIUM", "X")
            .otherwise(text)
        )

    local = marked(F.translate(F.format_number(price, 2), ",.", ".,"))
    return r.table(spark, folder, "orders").select(
        "o_orderkey",
        num.parse_locale_number(local).alias("valor"),
        num.parse_locale_number(marked(price.cast("string"))).alias("valor_com_ponto"),
    )


@query(
    "code_lookup_default",
    sql=f"""WITH codigos AS (SELECT p_partkey, p_name, p_brand,
        CAST(211 + p_size % 7 AS VARCHAR) AS variavel,
        CAST({r.FIRST_CODE} + CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS VARCHAR) AS codigo
        FROM part)
      SELECT p_partkey, {r.sql_case(fv.VARIABLES, 'variavel', "'var_' || variavel")} AS coluna,
        {r.sql_case(fv.DASHBOARD_LABELS, 'codigo', 'p_name')} AS rotulo FROM codigos""",
)
def code_lookup_default(spark, folder):
    parts = r.table(spark, folder, "part").select(
        "p_partkey",
        "p_name",
        (211 + F.col("p_size") % 7).cast("string").alias("variavel"),
        (r.FIRST_CODE + r.brand_number()).cast("string").alias("codigo"),
    )
    variable, code = F.col("variavel"), F.col("codigo")
    return parts.select(
        "p_partkey",
        lookup_or(variable, fv.VARIABLES, F.concat(F.lit("var_"), variable)).alias("coluna"),
        lookup_or(code, fv.DASHBOARD_LABELS, F.col("p_name")).alias("rotulo"),
    )


def _sql_number(x: str, places: int) -> str:
    return f"format('{{:.{places}f}}', {x})"


@query(
    "human_numbers",
    sql=f"""WITH saldos AS (SELECT c_custkey, c_acctbal, c_acctbal * c_acctbal * sign(c_acctbal) AS quadrado
        FROM customer)
      SELECT c_custkey,
        CASE WHEN quadrado >= 1e6 THEN {_sql_number('quadrado / 1e6', 1)} || 'M'
          WHEN quadrado >= 1e3 THEN {_sql_number('quadrado / 1e3', 1)} || 'K'
          ELSE {_sql_number('quadrado', 0)} END AS cartao,
        CASE WHEN abs(quadrado * 100) >= 1e9 THEN {_sql_number('quadrado * 100 / 1e9', 1)} || 'B'
          WHEN abs(quadrado * 100) >= 1e6 THEN {_sql_number('quadrado * 100 / 1e6', 0)} || 'M'
          WHEN abs(quadrado * 100) >= 1e3 THEN {_sql_number('quadrado * 100 / 1e3', 0)} || 'K'
          ELSE {_sql_number('quadrado * 100', 0)} END AS eixo,
        format('{{:,.2f}}', c_acctbal) AS milhar
      FROM saldos""",
)
def human_numbers(spark, folder):
    balance = F.col("c_acctbal")
    squared = balance * balance * F.signum(balance)
    return r.table(spark, folder, "customer").select(
        "c_custkey",
        num.card_number(squared).alias("cartao"),
        num.axis_number(squared * 100).alias("eixo"),
        num.thousands(balance, 2).alias("milhar"),
    )


@query(
    "snapshot_name_parse",
    sql="""WITH nomes AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano,
        CAST(o_orderdate AS DATE) AS dia, CASE WHEN o_orderstatus = 'F' THEN 'brasil' ELSE 'uf' END AS nivel
        FROM orders)
      SELECT o_orderkey, 'ibge_pam_' || nivel || '_' || ano || '_' || (ano + 1) || '_' ||
          strftime(dia, '%Y%m%d') AS base, nivel, ano AS primeiro_ano, ano + 1 AS ultimo_ano, dia AS data,
        'csv' AS formato FROM nomes""",
)
def snapshot_name_parse(spark, folder):
    """Build a snapshot name from each order and read its parts back."""
    year = F.year("o_orderdate")
    level = F.when(F.col("o_orderstatus") == "F", "brasil").otherwise("uf")
    name = snapshot_name(level, F.array(year + 1, year), F.to_date("o_orderdate"))
    named = r.table(spark, folder, "orders").select(
        "o_orderkey", F.concat(F.lit("landed/csv/"), name, F.lit(".csv")).alias("arquivo")
    )
    parts = parse_snapshot_name(F.col("arquivo"))
    return named.select(
        "o_orderkey",
        parts["base"].alias("base"),
        parts["nivel"].alias("nivel"),
        parts["anos"][0].alias("primeiro_ano"),
        parts["anos"][1].alias("ultimo_ano"),
        parts["data"].alias("data"),
        parts["formato"].alias("formato"),
    )


# --- clean-up chain ------------------------------------------------------------


@query(
    "coerce_types",
    sql=f"WITH {r.SQL_TYPED} SELECT {_CODES}, ano, coletado_em, {_METRICS} FROM tipado",
)
def coerce_types(spark, folder):
    typed = rows.coerce_types(r.raw_lines(spark, folder))
    return typed.select(
        "produto_cod", "tabela_sidra", "cod_territorial", "ano", "coletado_em", *fv.METRICS
    )


@query(
    "completeness_status",
    sql=f"WITH {r.SQL_CATEGORIES} SELECT url_origem, status_dado, {_METRICS} FROM categorias",
)
def completeness_status(spark, folder):
    typed = rows.coerce_types(r.raw_lines(spark, folder))
    return rows.completeness_status(typed).select("url_origem", "status_dado", *fv.METRICS)


@query(
    "standardize_categories",
    sql=f"""WITH {r.SQL_CATEGORIES} SELECT produto, produto_nome_ibge, nivel_territorial,
      nome_territorial, unidade_qtd, fonte, count(*) AS linhas FROM categorias GROUP BY ALL""",
)
def standardize_categories(spark, folder):
    keys = ["produto", "produto_nome_ibge", "nivel_territorial", "nome_territorial", "unidade_qtd", "fonte"]
    tidy = rows.standardize_categories(r.raw_lines(spark, folder))
    return tidy.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas"))


@query(
    "validate_rows",
    sql=f"WITH {r.SQL_PROCESSED} SELECT produto_cod, ano, {_METRICS}, url_origem FROM processado",
)
def validate_rows(spark, folder):
    typed = rows.coerce_types(r.raw_lines(spark, folder))
    return rows.validate_rows(typed).select("produto_cod", "ano", *fv.METRICS, "url_origem")


_SQL_YEAR_OK = f"coalesce(ano BETWEEN {fv.YEAR_MIN} AND {fv.YEAR_MAX}, false)"
_SQL_CODE_OK = "regexp_full_match(produto_cod, '[0-9]+')"


@query(
    "validation_report",
    sql=f"WITH {r.SQL_TYPED} "
    + " UNION ALL ".join(
        f"SELECT '{label}' AS regra, count(*) FILTER (WHERE {rule}) AS total FROM tipado"
        for label, rule in {
            "ano inválido": f"NOT {_SQL_YEAR_OK}",
            "código inválido": f"{_SQL_YEAR_OK} AND NOT {_SQL_CODE_OK}",
            **{
                f"negativo em {c}": f"{_SQL_YEAR_OK} AND {_SQL_CODE_OK} AND {c} < 0"
                for c in fv.METRICS
            },
            "aprovados": f"{_SQL_YEAR_OK} AND {_SQL_CODE_OK}",
            "total": "true",
        }.items()
    ),
)
def validation_report(spark, folder):
    return rows.validation_report(rows.coerce_types(r.raw_lines(spark, folder)))


@query(
    "clean_chain",
    sql=f"WITH {r.SQL_PROCESSED} SELECT {', '.join(fv.PROCESSED_COLUMNS)} FROM processado",
)
def clean_chain(spark, folder):
    return processed(spark, folder)


# --- processed-table listings ----------------------------------------------------


@query(
    "processed_listing",
    sql=f"""WITH {r.SQL_PROCESSED} SELECT produto, produto_nome_ibge, ano, area_colhida_ha,
      qtd_produzida, unidade_qtd, rendimento_medio_kg_ha, valor_producao_mil_reais, status_dado,
      processado_em FROM processado""",
)
def processed_listing(spark, folder):
    return reports.processed_listing(written_once(processed(spark, folder).select(*reports.LISTED), "listed"))


@query(
    "partial_records",
    sql=f"""WITH {r.SQL_PROCESSED} SELECT produto, ano, {_METRICS}, status_dado FROM processado
      WHERE status_dado = 'parcial'""",
)
def partial_records(spark, folder):
    return rows.partial_records(processed(spark, folder))


@query(
    "status_counts",
    sql=f"""WITH {r.SQL_PROCESSED} SELECT status_dado, count(*) AS total FROM processado GROUP BY 1""",
)
def status_counts(spark, folder):
    return reports.status_counts(processed(spark, folder))


@query(
    "distinct_name_map",
    sql=f"""WITH {r.SQL_PROCESSED} SELECT DISTINCT produto AS nome_padronizado,
      produto_nome_ibge AS nome_original_ibge, produto_cod FROM processado""",
)
def distinct_name_map(spark, folder):
    return reports.distinct_name_map(processed(spark, folder))


@query(
    "filter_options",
    sql=f"""WITH {r.SQL_PROCESSED}
      SELECT DISTINCT 'ano' AS filtro, CAST(ano AS VARCHAR) AS opcao FROM processado
      UNION ALL SELECT DISTINCT 'produto', produto FROM processado""",
)
def filter_options(spark, folder):
    rows_ = written_once(processed(spark, folder).select("ano", "produto").distinct(), "options")
    years = reports.filter_options(rows_, "ano", descending=True)
    products = reports.filter_options(rows_, "produto")
    return years.select(F.lit("ano").alias("filtro"), F.col("ano").cast("string").alias("opcao")).unionAll(
        products.select(F.lit("produto").alias("filtro"), F.col("produto").alias("opcao"))
    )


@query(
    "first_available_source",
    sql="""SELECT o_orderkey, o_totalprice, 'pedidos' AS fonte_carga FROM orders""",
)
def first_available_source(spark, folder):
    """Orders of a status that does not occur, else all orders."""
    orders = r.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    missing = orders.where(F.col("o_orderstatus") == "none")
    found = first_available({"pedidos abertos": missing, "pedidos": orders})
    return found.select("o_orderkey", "o_totalprice", "fonte_carga")


@query(
    "processed_csv_scan",
    sql=f"""WITH {r.SQL_PROCESSED} SELECT {', '.join(fv.PROCESSED_COLUMNS)}, 'CSV processado' AS fonte_carga
      FROM processado""",
)
def processed_csv_scan(spark, folder):
    """The processed rows as CSV, read back in their types; a first source that holds no row is passed over."""
    root = scratch_path(spark, "processed")
    rows_ = processed(spark, folder)
    write_csv(rows_.limit(0), f"{root}/novo.csv", fv.PROCESSED_COLUMNS)
    write_csv(rows_, f"{root}/processado.csv", fv.PROCESSED_COLUMNS)
    return first_available(
        {
            "CSV novo": read_csv(spark, f"{root}/novo.csv", schemas.PROCESSED),
            "CSV processado": read_csv(spark, f"{root}/processado.csv", schemas.PROCESSED),
        }
    )
