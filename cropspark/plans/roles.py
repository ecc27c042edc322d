"""The general tables in the roles of the crop model, for Spark and as SQL.

A line item is one measurement: its part's brand number is the product, its
supplier's nation the place, the nation's region the territorial level and the
ship year the year. Quantity plays harvested area, price produced quantity and
discounted price the value. Amounts are whole numbers of the smallest unit, so sums
are exact in any order and cheap on every row.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark.functions.text import lookup_or
from cropspark.session import written_once

COLLECTED_AT = "2024-01-15 10:00:00"
PROCESSED_AT = "2024-01-16 12:30:00"
YEAR = 1999
FIRST_CODE = 40123  # brand 1 becomes product code 40124

MONEY = "decimal(18,2)"


# Explicit schemas: no job to read file footers before the query starts.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def brand_number(col: str = "p_brand") -> Column:
    return F.regexp_extract(col, "([0-9]+)", 1).cast("int")


def official_or_brand(code: Column) -> Column:
    return lookup_or(code, fv.OFFICIAL_NAMES, F.col("p_brand"))


def of_year(items: DataFrame, year: int | None) -> DataFrame:
    """Line items of one year, as a range of the ship date that reaches the scan."""
    if year is None:
        return items
    shipped = F.col("l_shipdate")
    return items.where((shipped >= F.lit(f"{year}-01-01").cast("date")) & (shipped < F.lit(f"{year + 1}-01-01").cast("date")))


def lines(
    spark: SparkSession, folder: str, items: DataFrame | None = None, year: int | None = None
) -> DataFrame:
    """One row per line item with its product and place."""
    items = of_year(table(spark, folder, "lineitem") if items is None else items, year)
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    kept_percent = 100 - F.rint(F.col("l_discount") * 100).cast("bigint")
    code = (FIRST_CODE + brand_number()).cast("string")
    part = table(spark, folder, "part").select(
        "p_partkey",
        "p_size",
        brand_number().alias("id_commodity"),
        code.alias("produto_cod"),
        official_or_brand(code).alias("produto"),
    )
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        items.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "produto",
            "produto_cod",
            F.col("r_name").alias("nivel_territorial"),
            F.col("s_nationkey").cast("string").alias("cod_territorial"),
            F.col("n_name").alias("nome_territorial"),
            F.year("l_shipdate").alias("ano"),
            F.col("l_quantity").cast("decimal(18,2)").alias("area"),
            cents.alias("centavos"),
            (cents * kept_percent).alias("valor_1e4"),
            "l_shipdate",
            "l_orderkey",
            "l_linenumber",
            "l_returnflag",
            "l_linestatus",
            "p_size",
            "id_commodity",
            (F.col("s_nationkey") + 1).alias("id_territorio"),
        )
    )


def _metrics() -> list[Column]:
    area = F.sum("area").cast(MONEY)
    quantity = (F.sum("centavos").cast("decimal(20,0)") / 100).cast(MONEY)
    value = (F.sum("valor_1e4").cast("decimal(24,0)") / 10000).cast(MONEY)
    ratio = quantity.cast("double") / area.cast("double")
    return [
        area.alias("area_colhida_ha"),
        quantity.alias("qtd_produzida"),
        (F.rint(ratio * 100) / 100).cast(MONEY).alias("rendimento_medio_kg_ha"),
        value.alias("valor_producao_mil_reais"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("coletado_em"),
    ]


PLACE_KEYS = [
    "produto", "produto_cod", "nivel_territorial", "cod_territorial", "nome_territorial", "ano",
]


def wide(spark: SparkSession, folder: str, year: int | None = None) -> DataFrame:
    """Raw wide rows: one per product, place and year, in the 15-column order."""
    return (
        lines(spark, folder, year=year)
        .groupBy(*PLACE_KEYS)
        .agg(*_metrics())
        .withColumns(
            {
                "unidade_qtd": unit_of(F.col("produto_cod")),
                "fonte": F.lit(fv.SOURCE_NAME),
                "tabela_sidra": F.lit(fv.TABLE_CODE),
                "url_origem": F.concat_ws("/", F.lit("landed"), "nivel_territorial", "cod_territorial"),
            }
        )
        .select(*fv.RAW_COLUMNS)
    )


def stored_wide(spark: SparkSession, folder: str, year: int | None = None) -> DataFrame:
    """`wide` computed once, for queries that pass over it more than once."""
    return written_once(wide(spark, folder, year), "wide")


def stored_fact(spark: SparkSession, folder: str) -> DataFrame:
    return written_once(fact(spark, folder), "fact")


def unit_of(code: Column) -> Column:
    return F.when(code == "40127", "Mil frutos").when(code != "40131", "Toneladas")


def doubles(df: DataFrame, names=fv.METRICS) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in names})


def dim_commodity(spark: SparkSession, folder: str) -> DataFrame:
    code = (FIRST_CODE + brand_number()).cast("string")
    return (
        table(spark, folder, "part")
        .select("p_brand")
        .distinct()
        .select(
            brand_number().alias("id_commodity"),
            code.alias("codigo_sidra"),
            official_or_brand(code).alias("nome_oficial"),
            F.coalesce(unit_of(code), F.lit(fv.DEFAULT_UNIT)).alias("unidade_medida"),
        )
    )


def dim_territory(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("n_nationkey") + 1).alias("id_territorio"),
            F.col("n_nationkey").cast("string").alias("codigo_ibge"),
            F.col("n_name").alias("nome"),
            F.col("r_name").alias("nivel_territorial"),
        )
    )


def fact(spark: SparkSession, folder: str, year: int | None = None) -> DataFrame:
    return lines(spark, folder, year=year).groupBy("id_commodity", "id_territorio", "ano").agg(*_metrics())


def long_form(spark: SparkSession, folder: str) -> DataFrame:
    """Events in the second long form: product, variable, value."""
    event = F.col("event_type")
    return table(spark, folder, "events").select(
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("produto"),
        F.when(event == "purchase", fv.QUANTITY_LABEL)
        .when(event == "view", fv.PLANTED_AREA_LABEL)
        .otherwise(event)
        .alias("variavel"),
        F.col("value").cast(MONEY).alias("valor"),
    )


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as untyped raw rows with blanks, mixed case, marks and bad values."""
    reversed_sale = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A")
    quantity = (F.col("centavos") / 100).cast("string")
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    return lines(spark, folder, items).select(
        F.concat(
            F.lit("  "),
            F.when(F.col("l_linestatus") == "F", F.upper("produto")).otherwise(F.lower("produto")),
            F.lit(" "),
        ).alias("produto"),
        F.when(F.col("p_size") == 50, F.concat(F.lit("B"), "produto_cod"))
        .otherwise(F.concat(F.lit(" "), "produto_cod", F.lit(" ")))
        .alias("produto_cod"),
        F.concat("nivel_territorial", F.lit(" ")).alias("nivel_territorial"),
        F.concat(F.lit(" "), "cod_territorial").alias("cod_territorial"),
        F.lower("nome_territorial").alias("nome_territorial"),
        F.when(F.col("l_linenumber") == 7, "1900")
        .when(F.col("l_linenumber") == 6, "n/d")
        .otherwise(F.col("ano").cast("string"))
        .alias("ano"),
        F.when(F.col("l_returnflag") == "R", "...")
        .otherwise(F.col("area").cast("string"))
        .alias("area_colhida_ha"),
        quantity.alias("qtd_produzida"),
        F.lit(" toneladas").alias("unidade_qtd"),
        F.when(reversed_sale, F.concat(F.lit("-"), quantity))
        .otherwise(quantity)
        .alias("rendimento_medio_kg_ha"),
        ((F.col("centavos") * 10 + 5) / 1000).cast("string").alias("valor_producao_mil_reais"),
        F.lit("ibge/pam-sidra ").alias("fonte"),
        F.lit(fv.TABLE_CODE).alias("tabela_sidra"),
        F.concat_ws("/", F.lit("landed"), F.col("l_orderkey").cast("string")).alias("url_origem"),
        F.when(F.col("l_linenumber") == 1, "0000-00")
        .otherwise(F.col("l_shipdate").cast("string"))
        .alias("coletado_em"),
    )


# --- the same roles in SQL ---------------------------------------------------


def sql_case(table_: dict[str, str], key: str, default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table_.items())
    return f"CASE {key} {whens} ELSE {default} END"


_SQL_CODE = f"CAST({FIRST_CODE} + CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS VARCHAR)"
_SQL_NUMBER = "CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER)"
_SQL_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_SQL_UNIT = "CASE WHEN {c} = '40127' THEN 'Mil frutos' WHEN {c} <> '40131' THEN 'Toneladas' END"

SQL_LINES = f"""lines AS (
  SELECT {sql_case(fv.OFFICIAL_NAMES, _SQL_CODE, 'p_brand')} AS produto,
    {_SQL_CODE} AS produto_cod, r_name AS nivel_territorial,
    CAST(s_nationkey AS VARCHAR) AS cod_territorial, n_name AS nome_territorial,
    CAST(year(l_shipdate) AS INTEGER) AS ano,
    CAST(l_quantity AS DECIMAL(18,2)) AS area, {_SQL_PRICE} AS qtd,
    {_SQL_PRICE} * (1 - CAST(l_discount AS DECIMAL(5,2))) AS valor,
    l_shipdate, l_orderkey, l_linenumber, l_returnflag, l_linestatus, p_size,
    {_SQL_NUMBER} AS id_commodity, s_nationkey + 1 AS id_territorio
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

SQL_RAW_LINES = f"""{SQL_LINES}, bruto AS (
  SELECT '  ' || CASE WHEN l_linestatus = 'F' THEN upper(produto) ELSE lower(produto) END || ' ' AS produto,
    CASE WHEN p_size = 50 THEN 'B' || produto_cod ELSE ' ' || produto_cod || ' ' END AS produto_cod,
    nivel_territorial || ' ' AS nivel_territorial, ' ' || cod_territorial AS cod_territorial,
    lower(nome_territorial) AS nome_territorial,
    CASE l_linenumber WHEN 7 THEN '1900' WHEN 6 THEN 'n/d' ELSE CAST(ano AS VARCHAR) END AS ano,
    CASE WHEN l_returnflag = 'R' THEN '...' ELSE CAST(area AS VARCHAR) END AS area_colhida_ha,
    CAST(qtd AS VARCHAR) AS qtd_produzida, ' toneladas' AS unidade_qtd,
    CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A' THEN '-' ELSE '' END || CAST(qtd AS VARCHAR)
      AS rendimento_medio_kg_ha,
    CAST(qtd AS VARCHAR) || '5' AS valor_producao_mil_reais, 'ibge/pam-sidra ' AS fonte,
    '{fv.TABLE_CODE}' AS tabela_sidra, 'landed/' || CAST(l_orderkey AS VARCHAR) AS url_origem,
    CASE WHEN l_linenumber = 1 THEN '0000-00' ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END
      AS coletado_em
  FROM lines)"""

_SQL_METRICS = """CAST(sum(area) AS DECIMAL(18,2)) AS area_colhida_ha,
    CAST(sum(qtd) AS DECIMAL(18,2)) AS qtd_produzida,
    CAST(round_even(CAST(sum(qtd) AS DOUBLE) / CAST(sum(area) AS DOUBLE) * 100, 0) / 100
      AS DECIMAL(18,2)) AS rendimento_medio_kg_ha,
    CAST(sum(valor) AS DECIMAL(18,2)) AS valor_producao_mil_reais,
    strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS coletado_em"""

SQL_WIDE = f"""{SQL_LINES}, wide AS (
  SELECT {', '.join(PLACE_KEYS)}, {_SQL_METRICS},
    {_SQL_UNIT.format(c='produto_cod')} AS unidade_qtd,
    '{fv.SOURCE_NAME}' AS fonte, '{fv.TABLE_CODE}' AS tabela_sidra,
    'landed/' || nivel_territorial || '/' || cod_territorial AS url_origem
  FROM lines GROUP BY {', '.join(PLACE_KEYS)})"""

SQL_DIM_COMMODITY = f"""dim_commodity AS (
  SELECT DISTINCT {_SQL_NUMBER} AS id_commodity, {_SQL_CODE} AS codigo_sidra,
    {sql_case(fv.OFFICIAL_NAMES, _SQL_CODE, 'p_brand')} AS nome_oficial,
    coalesce({_SQL_UNIT.format(c=_SQL_CODE)}, '{fv.DEFAULT_UNIT}') AS unidade_medida FROM part)"""

SQL_DIM_TERRITORY = """dim_territorio AS (
  SELECT n_nationkey + 1 AS id_territorio, CAST(n_nationkey AS VARCHAR) AS codigo_ibge,
    n_name AS nome, r_name AS nivel_territorial
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

SQL_FACT = f"""{SQL_LINES}, fato AS (
  SELECT id_commodity, id_territorio, ano, {_SQL_METRICS}
  FROM lines GROUP BY id_commodity, id_territorio, ano)"""

SQL_STAR = f"{SQL_FACT}, {SQL_DIM_COMMODITY}, {SQL_DIM_TERRITORY}"

SQL_LONG = f"""longo AS (
  SELECT 'k' || regexp_extract(props, '[0-9]+') AS produto,
    CASE event_type WHEN 'purchase' THEN '{fv.QUANTITY_LABEL}' WHEN 'view' THEN '{fv.PLANTED_AREA_LABEL}'
      ELSE event_type END AS variavel, CAST(value AS DECIMAL(18,2)) AS valor FROM events)"""


def sql_doubles(names=fv.METRICS) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in names)


def sql_round(expression: str, places: int) -> str:
    """Half-even rounding on doubles, the way `round_half_even` does it."""
    scale = float(10**places)
    return f"round_even({expression} * {scale}, 0) / {scale}"


def sql_title(expression: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({expression}, "
        "'[\\p{L}]+|[^\\p{L}]+'), lambda s: upper(s[1]) || lower(s[2:])), '')"
    )


def _sql_typed() -> str:
    numbers = ", ".join(
        f"{sql_round(f'TRY_CAST({c} AS DOUBLE)', 2)} AS {c}" for c in fv.METRICS
    )
    return f"""SELECT trim(produto_cod) AS produto_cod, trim(tabela_sidra) AS tabela_sidra,
      trim(cod_territorial) AS cod_territorial, TRY_CAST(ano AS INTEGER) AS ano,
      TRY_CAST(coletado_em AS TIMESTAMP) AS coletado_em, {numbers},
      produto, nivel_territorial, nome_territorial, unidade_qtd, fonte, url_origem FROM bruto"""


_SQL_PARTIAL = " OR ".join(f"{c} IS NULL" for c in fv.METRICS)

SQL_TYPED = f"""{SQL_RAW_LINES}, tipado AS ({_sql_typed()})"""

SQL_CATEGORIES = f"""{SQL_TYPED}, categorias AS (
  SELECT {sql_case(fv.CANONICAL_NAMES, 'lower(trim(produto))', sql_title('trim(produto)'))} AS produto,
    trim(produto) AS produto_nome_ibge, produto_cod,
    {sql_title('trim(nivel_territorial)')} AS nivel_territorial, cod_territorial,
    {sql_title('trim(nome_territorial)')} AS nome_territorial, ano,
    {', '.join(fv.METRICS)}, upper(trim(unidade_qtd)) AS unidade_qtd,
    CASE WHEN {_SQL_PARTIAL} THEN 'parcial' ELSE 'completo' END AS status_dado,
    upper(trim(fonte)) AS fonte, tabela_sidra, url_origem, coletado_em
  FROM tipado)"""

SQL_PROCESSED = f"""{SQL_CATEGORIES}, processado AS (
  SELECT produto, produto_nome_ibge, produto_cod, nivel_territorial, cod_territorial,
    nome_territorial, ano,
    {', '.join(f'CASE WHEN {c} >= 0 THEN {c} END AS {c}' for c in fv.METRICS)},
    unidade_qtd, status_dado, fonte, tabela_sidra, url_origem, coletado_em,
    TIMESTAMP '{PROCESSED_AT}' AS processado_em, '{fv.ETL_VERSION}' AS versao_etl
  FROM categorias
  WHERE ano BETWEEN {fv.YEAR_MIN} AND {fv.YEAR_MAX} AND regexp_full_match(produto_cod, '[0-9]+'))"""
