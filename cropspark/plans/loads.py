"""Payload to wide rows, star loads and upserts over whole tables."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropspark import fixed_values as fv
from cropspark import schemas
from cropspark.operators import reports, star
from cropspark.operators.reshape import attach_unit, pivot_first_nonnull
from cropspark.plans import roles as r
from cropspark.plans.registry import query
from cropspark.session import scratch_path, written_once
from cropspark.sources import bucketed, lake
from cropspark.sources import payload as src

_METRICS = ", ".join(fv.METRICS)
_CODE_OF = {column: code for code, column in fv.VARIABLES.items()}
_UNIT_OF = {
    "area_colhida_ha": "Hectares",
    "rendimento_medio_kg_ha": "Kg por Hectare",
    "valor_producao_mil_reais": "Mil Reais",
}


# --- payload documents, one per wide row ---------------------------------------


def _local_text(name):
    """1234.5 -> "1.234,50"."""
    return F.translate(F.format_number(F.col(name), 2), ",.", ".,")


def _cell(variable):
    unit = (
        F.lit(_UNIT_OF[variable])
        if variable in _UNIT_OF
        else F.coalesce("unidade_qtd", F.lit("Frutos"))
    )
    withheld = (F.col("nome_territorial") == "NATION_3") & F.lit(variable == "area_colhida_ha")
    return F.struct(
        F.col("cod_territorial").alias("D1C"),
        F.col("nome_territorial").alias("D1N"),
        F.lit(_CODE_OF[variable]).alias("D2C"),
        F.lit(variable).alias("D2N"),
        F.col("ano").cast("string").alias("D3C"),
        F.col("ano").cast("string").alias("D3N"),
        F.col("produto_cod").alias("D4C"),
        F.col("produto").alias("D4N"),
        F.lit("1").alias("MC"),
        unit.alias("MN"),
        F.lit("3").alias("NC"),
        F.col("nivel_territorial").alias("NN"),
        F.when(withheld, "X").otherwise(_local_text(variable)).alias("V"),
    )


def _document():
    names = "D1C D1N D2C D2N D3C D3N D4C D4N MC MN NC NN V".split()
    return F.struct(*[F.lit("header").alias(n) for n in names]), [_cell(v) for v in fv.METRICS]


def payloads(spark, folder):
    """Every wide row as a response document: a header and one cell per variable."""
    header, cells = _document()
    place = F.concat_ws("/", "cod_territorial", "produto_cod", F.col("ano").cast("string"))
    return r.wide(spark, folder).select(
        F.to_json(F.array(header, *cells)).alias("payload"),
        F.concat(F.lit("landed/"), place).alias("url_origem"),
    )


_SQL_UNITS = {**{m: f"'{u}'" for m, u in _UNIT_OF.items()}, "qtd_produzida": "coalesce(unidade_qtd, 'Frutos')"}


def _sql_cell_value(m):
    value = f"CAST({m} AS DOUBLE)"
    return f"CASE WHEN nome_territorial = 'NATION_3' THEN NULL ELSE {value} END" if m == "area_colhida_ha" else value


SQL_CELLS = f"""{r.SQL_WIDE}, celulas AS ({' UNION ALL '.join(f'''
  SELECT produto, produto_cod, nivel_territorial, cod_territorial, nome_territorial,
    CAST(ano AS VARCHAR) AS ano, '{_CODE_OF[m]}' AS variavel_cod, '{m}' AS variavel_col,
    {_SQL_UNITS[m]} AS unidade_api, {_sql_cell_value(m)} AS valor, '{fv.SOURCE_NAME}' AS fonte,
    '{fv.TABLE_CODE}' AS tabela_sidra,
    'landed/' || cod_territorial || '/' || produto_cod || '/' || CAST(ano AS VARCHAR) AS url_origem,
    '{r.COLLECTED_AT}' AS coletado_em, {i} AS posicao FROM wide''' for i, m in enumerate(fv.METRICS, 1))})"""


def cells(spark, folder):
    return src.payload_to_cells(payloads(spark, folder), r.COLLECTED_AT)


# --- the same documents landed as files: lines, and one array file per level --------

_IN_ARRAYS = ["ASIA", "EUROPE"]
_ORDER = ["cod_territorial", "produto_cod", "ano", "variavel_cod"]
_SQL_IN_ARRAYS = f"nivel_territorial IN ({', '.join(repr(n) for n in _IN_ARRAYS)})"
_SQL_LANDED_AS = f"CASE WHEN {_SQL_IN_ARRAYS} THEN 'arrays/' ELSE 'lines/' END || regexp_extract(nivel_territorial, '[A-Z]+')"
SQL_LANDED = f"""{SQL_CELLS}, recebidas AS (
  SELECT * REPLACE ({_SQL_LANDED_AS} AS url_origem, CAST(CASE WHEN {_SQL_IN_ARRAYS}
    THEN row_number() OVER (PARTITION BY nivel_territorial ORDER BY {', '.join(_ORDER)}) ELSE posicao END AS INTEGER) AS posicao)
  FROM celulas)"""


def land(spark, folder):
    """Write the documents below a new folder, which is returned: `lines` and `arrays`.

    Some documents of 1995 land a second time, cut off.
    """
    root = scratch_path(spark, "landing")
    rows = r.stored_wide(spark, folder)
    header, cells = _document()
    document = F.to_json(F.array(header, *cells))
    cut = F.when((F.col("ano") == 1995) & (F.col("nome_territorial") == "NATION_3"), F.substring(document, 1, 200))
    lines = rows.where(~F.col("nivel_territorial").isin(_IN_ARRAYS)).select(
        F.col("nivel_territorial").alias("nivel"), F.explode(F.array_compact(F.array(document, cut))).alias("value")
    )
    lines.write.partitionBy("nivel").text(f"{root}/lines")
    each = F.explode(F.array(*[F.struct(F.lit(_CODE_OF[v]).alias("variavel_cod"), F.to_json(c).alias("cell")) for v, c in zip(fv.METRICS, cells)]))
    arrays = rows.where(F.col("nivel_territorial").isin(_IN_ARRAYS)).select(
        F.col("nivel_territorial").alias("nivel"), "cod_territorial", "produto_cod", "ano", each.alias("_c")
    )
    src.write_arrays(arrays.select("nivel", *_ORDER[:-1], "_c.*"), f"{root}/arrays", "nivel", _ORDER, "cell", F.to_json(header))
    return root


def landed_cells(spark, folder):
    """All cells of the landed files, and what became of each document."""
    root = land(spark, folder)
    lines = src.read_payloads(spark, f"{root}/lines")
    of_arrays, files = src.landed_cells(spark, f"{root}/arrays", r.COLLECTED_AT)
    cells = src.union_blocks([src.payload_to_cells(lines, r.COLLECTED_AT), of_arrays])
    return cells.withColumn("url_origem", _landed_as()), lines, files


def _landed_as():
    return F.regexp_replace(F.regexp_extract("url_origem", "((?:lines|arrays)/nivel=[A-Z]+)", 1), "nivel=", "")


@query("payload_to_cells", sql=f"WITH {SQL_LANDED} SELECT * FROM recebidas")
def payload_to_cells(spark, folder):
    return landed_cells(spark, folder)[0]


@query(
    "landed_documents",
    sql=f"""WITH {r.SQL_WIDE} SELECT 'lines' AS forma, count(*) FILTER (WHERE NOT {_SQL_IN_ARRAYS}) AS aceitos,
        count(*) FILTER (WHERE NOT {_SQL_IN_ARRAYS} AND ano = 1995 AND nome_territorial = 'NATION_3') AS recusados FROM wide
      UNION ALL SELECT 'arrays', count(DISTINCT nivel_territorial) FILTER (WHERE {_SQL_IN_ARRAYS}), 0 FROM wide""",
)
def landed_documents(spark, folder):
    """Documents that gave cells, and those that were refused."""
    _, lines, files = landed_cells(spark, folder)
    parsed = lines.select(F.from_json("payload", schemas.PAYLOAD).isNotNull().alias("aceito"))
    both = parsed.select(F.lit("lines").alias("forma"), "aceito").unionByName(files.select(F.lit("arrays").alias("forma"), "aceito"))
    return both.groupBy("forma").agg(F.count_if("aceito").alias("aceitos"), F.count_if(~F.col("aceito")).alias("recusados"))


_SQL_PIVOT = ", ".join(
    f"arg_min(valor, posicao) FILTER (WHERE variavel_col = '{m}' AND valor IS NOT NULL) AS {m}"
    for m in fv.METRICS
)


@query(
    "pivot_first_nonnull",
    sql=f"""WITH {SQL_CELLS} SELECT {', '.join(fv.PIVOT_KEYS)}, {_SQL_PIVOT} FROM celulas
      WHERE valor IS NOT NULL GROUP BY {', '.join(fv.PIVOT_KEYS)}""",
)
def pivot_first(spark, folder):
    return pivot_first_nonnull(cells(spark, folder))


_SOURCE_KEYS = ["produto", "produto_cod", "ano", "nivel_territorial", "nome_territorial", "fonte_carga"]


@query(
    "pivot_by_source",
    sql=f"""WITH {SQL_CELLS} SELECT produto, produto_cod, ano, nivel_territorial, nome_territorial,
      'API' AS fonte_carga, {_SQL_PIVOT} FROM celulas WHERE valor IS NOT NULL GROUP BY ALL""",
)
def pivot_by_source(spark, folder):
    tagged = cells(spark, folder).withColumn("fonte_carga", F.lit("API"))
    return pivot_first_nonnull(tagged, keys=_SOURCE_KEYS)


@query(
    "pivot_line_items",
    sql="""SELECT l_orderkey, l_linenumber,
        arg_min(l_quantity, (l_suppkey, l_partkey, l_quantity)) FILTER (WHERE l_returnflag = 'A') AS "A",
        arg_min(l_quantity, (l_suppkey, l_partkey, l_quantity)) FILTER (WHERE l_returnflag = 'N') AS "N",
        arg_min(l_quantity, (l_suppkey, l_partkey, l_quantity)) FILTER (WHERE l_returnflag = 'R') AS "R"
      FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def pivot_line_items(spark, folder):
    """Line items that share a key, first quantity per return flag."""
    rows = r.table(spark, folder, "lineitem").withColumn(
        "lugar", F.struct("l_suppkey", "l_partkey", "l_quantity")
    )
    return pivot_first_nonnull(
        rows, ["l_orderkey", "l_linenumber"], ["A", "N", "R"], "l_returnflag", "l_quantity", "lugar"
    )


@query(
    "attach_unit_left_join",
    sql=f"""WITH {SQL_CELLS}, largo AS (SELECT {', '.join(fv.PIVOT_KEYS)}, {_SQL_PIVOT} FROM celulas
        WHERE valor IS NOT NULL GROUP BY {', '.join(fv.PIVOT_KEYS)}),
      unidades AS (SELECT DISTINCT produto_cod, ano, cod_territorial, unidade_api FROM celulas
        WHERE variavel_col = 'qtd_produzida')
      SELECT largo.*, unidade_api AS unidade_qtd FROM largo
        LEFT JOIN unidades USING (produto_cod, ano, cod_territorial)""",
)
def attach_unit_left_join(spark, folder):
    long = written_once(cells(spark, folder), "cells")
    return attach_unit(pivot_first_nonnull(long), long)


@query(
    "collect_wide",
    sql=f"""WITH {r.SQL_WIDE} SELECT produto, produto_cod, nivel_territorial, cod_territorial, nome_territorial,
      ano, {_sql_cell_value('area_colhida_ha')} AS area_colhida_ha, CAST(qtd_produzida AS DOUBLE) AS qtd_produzida,
      coalesce(unidade_qtd, 'Frutos') AS unidade_qtd, CAST(rendimento_medio_kg_ha AS DOUBLE) AS rendimento_medio_kg_ha,
      CAST(valor_producao_mil_reais AS DOUBLE) AS valor_producao_mil_reais, fonte, tabela_sidra,
      {_SQL_LANDED_AS} AS url_origem, '{r.COLLECTED_AT}' AS coletado_em FROM wide""",
)
def collect_wide(spark, folder):
    return src.collect_cells(landed_cells(spark, folder)[0])


@query(
    "collection_totals",
    sql=f"""WITH {SQL_CELLS} SELECT (SELECT count(*) FROM wide) AS linhas, count(*) AS celulas FROM celulas""",
)
def collection_totals(spark, folder):
    long = written_once(cells(spark, folder), "cells")
    return reports.collection_totals(pivot_first_nonnull(long), long)


@query(
    "clean_long_values",
    sql="""SELECT 'k' || regexp_extract(props, '[0-9]+') AS produto, event_type AS variavel,
      CAST(value AS DOUBLE) AS valor, CAST(user_id AS VARCHAR) AS municipio
      FROM events WHERE event_type NOT IN ('error', 'signup')""",
)
def clean_long_values(spark, folder):
    """Every event as a landed document of the second form, one a line, read by header text."""
    titles = {"D4N": "Produto das lavouras temporárias", "D2N": "Variável", "V": "Valor", "D1N": "Município"}
    header = F.create_map(*[F.lit(x) for pair in titles.items() for x in pair])
    event = F.col("event_type")
    value = (
        F.when(event == "error", "..")
        .when(event == "signup", "n/d")
        .otherwise(F.col("value").cast(r.MONEY).cast("string"))
    )
    cell = F.create_map(
        F.lit("D4N"), F.concat(F.lit("k"), F.get_json_object("props", "$.k")),
        F.lit("D2N"), event,
        F.lit("V"), value,
        F.lit("D1N"), F.col("user_id").cast("string"),
    )
    docs = r.table(spark, folder, "events").select(F.to_json(F.array(header, cell)).alias("payload"))
    path = scratch_path(spark, "second-form")
    docs.write.text(path)
    return src.clean_long_values(src.header_named_cells(src.read_payloads(spark, path)))


# --- keys and dimensions ---------------------------------------------------------


@query(
    "dedupe_keep_first",
    sql="""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n
        FROM lineitem) WHERE n = 1""",
)
def dedupe_keep_first(spark, folder):
    rows = r.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return star.keep_first(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query(
    "surrogate_keys",
    sql="""SELECT o_orderkey, o_custkey, CAST(1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS id
      FROM orders""",
)
def surrogate_keys(spark, folder):
    rows = r.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    numbered = star.number_rows(rows, ["o_orderdate", "o_orderkey"], "id", 1000)
    return numbered.select("o_orderkey", "o_custkey", "id")


_OLD = 40134  # products up to this code are already in the dimension


@query(
    "dim_insert_if_absent",
    sql=f"""WITH {r.SQL_DIM_COMMODITY}, antigas AS (SELECT * FROM dim_commodity WHERE codigo_sidra <= '{_OLD}')
      SELECT * FROM antigas UNION ALL
      SELECT CAST((SELECT max(id_commodity) FROM antigas) + row_number() OVER (ORDER BY codigo_sidra) AS INTEGER),
        codigo_sidra, nome_oficial, unidade_medida FROM dim_commodity WHERE codigo_sidra > '{_OLD}'""",
)
def dim_insert_if_absent(spark, folder):
    existing = r.dim_commodity(spark, folder).where(F.col("codigo_sidra") <= str(_OLD))
    return star.load_dim_commodity(
        existing, r.wide(spark, folder), ["ano", "cod_territorial"]
    )


@query(
    "dim_territory_load",
    sql=f"""WITH {r.SQL_WIDE} SELECT CAST(row_number() OVER (ORDER BY cod_territorial, nivel_territorial) AS INTEGER)
        AS id_territorio, cod_territorial AS codigo_ibge, arg_min(nome_territorial, ano) AS nome, nivel_territorial
      FROM wide GROUP BY cod_territorial, nivel_territorial""",
)
def dim_territory_load(spark, folder):
    empty = spark.createDataFrame(
        [],
        T.StructType(
            [
                T.StructField("id_territorio", T.IntegerType()),
                T.StructField("codigo_ibge", T.StringType()),
                T.StructField("nome", T.StringType()),
                T.StructField("nivel_territorial", T.StringType()),
            ]
        ),
    )
    return star.load_dim_territory(empty, r.wide(spark, folder), ["ano"])


@query(
    "fact_key_lookup",
    sql=f"""WITH {r.SQL_WIDE}, {r.SQL_DIM_COMMODITY}, {r.SQL_DIM_TERRITORY}
      SELECT id_commodity, id_territorio, ano, {r.sql_doubles()},
        id_commodity IS NOT NULL AND id_territorio IS NOT NULL AS carregada
      FROM wide LEFT JOIN (SELECT * FROM dim_commodity WHERE codigo_sidra <> '40130') c ON produto_cod = codigo_sidra
        LEFT JOIN (SELECT * FROM dim_territorio WHERE nome <> 'NATION_5') t
          ON cod_territorial = codigo_ibge AND wide.nivel_territorial = t.nivel_territorial""",
)
def fact_key_lookup(spark, folder):
    """Fact rows against dimensions that lack one product and one place."""
    products = r.dim_commodity(spark, folder).where(F.col("codigo_sidra") != "40130")
    places = r.dim_territory(spark, folder).where(F.col("nome") != "NATION_5")
    rows = star.resolve_fact_keys(r.wide(spark, folder), products, places)
    flagged = rows.withColumn("carregada", star.has_both_keys())
    return r.doubles(flagged).select("id_commodity", "id_territorio", "ano", *fv.METRICS, "carregada")


# --- upserts -----------------------------------------------------------------------

_BUCKETS = 8


def base_and_batch(df):
    """Years up to 1999 as the table; 1999 on, with doubled metrics, as the batch."""
    base = df.where(F.col("ano") <= r.YEAR)
    changed = {c: (F.col(c) * 2).cast(r.MONEY) for c in fv.METRICS}
    batch = df.where(F.col("ano") >= r.YEAR).withColumns(changed)
    return base, batch.withColumn("coletado_em", F.lit(r.COLLECTED_AT))


def fact_base_and_batch(spark, folder):
    rows = r.stored_fact(spark, folder).withColumn("fonte", F.lit("base"))
    base, batch = base_and_batch(rows)
    return base, batch.withColumn("fonte", F.lit("lote"))


_SQL_DOUBLED = ", ".join(
    f"CAST({c} * CASE WHEN ano >= {r.YEAR} THEN 2 ELSE 1 END AS DOUBLE) AS {c}" for c in fv.METRICS
)
_SQL_UPSERTED_FACT = f"""SELECT id_commodity, id_territorio, ano, {_SQL_DOUBLED},
  CASE WHEN ano >= {r.YEAR} THEN '{r.COLLECTED_AT}' ELSE coletado_em END AS coletado_em,
  CASE WHEN ano > {r.YEAR} THEN 'lote' ELSE 'base' END AS fonte FROM fato"""


@query("upsert_partial_columns", sql=f"WITH {r.SQL_FACT} {_SQL_UPSERTED_FACT}")
def upsert_partial_columns(spark, folder):
    """The fact stored by its key; the batch alone is moved."""
    base, batch = fact_base_and_batch(spark, folder)
    table = f"fato_{uuid.uuid4().hex}"
    bucketed.create(base, table, scratch_path(spark, "buckets"), fv.FACT_KEYS, _BUCKETS)
    bucketed.upsert_table(spark, table, batch, fv.FACT_UPDATES)
    return r.doubles(spark.table(table))


@query("upsert_idempotent", sql=f"WITH {r.SQL_FACT} {_SQL_UPSERTED_FACT}")
def upsert_idempotent(spark, folder):
    """The same batch delivered twice to a table by year, of which only touched years are rewritten."""
    base, batch = fact_base_and_batch(spark, folder)
    path = scratch_path(spark, "by-year")
    lake.write_lake(base, path, ["ano"])
    for _ in range(2):
        lake.upsert_lake(path, batch, fv.FACT_KEYS, fv.FACT_UPDATES, base.schema)
    return r.doubles(lake.read_lake(spark, path, base.schema)).select(*base.columns)


@query(
    "upsert_processed",
    sql=f"""WITH {r.SQL_WIDE} SELECT produto || CASE WHEN ano >= {r.YEAR} THEN ' novo' ELSE '' END AS produto,
      produto_cod, cod_territorial, nivel_territorial, ano, {_SQL_DOUBLED}, coalesce(unidade_qtd, 'Frutos') ||
        CASE WHEN ano > {r.YEAR} THEN ' novo' ELSE '' END AS unidade_qtd FROM wide""",
)
def upsert_processed(spark, folder):
    """Product name and metrics follow the batch; the unit keeps its first value."""
    shown = ["produto", *fv.PROCESSED_KEYS, *fv.METRICS, "unidade_qtd"]
    rows = r.stored_wide(spark, folder).withColumn("unidade_qtd", F.coalesce("unidade_qtd", F.lit("Frutos")))
    base, batch = base_and_batch(rows.select(*shown))
    batch = batch.withColumns(
        {c: F.concat(F.col(c), F.lit(" novo")) for c in ("produto", "unidade_qtd")}
    ).drop("coletado_em")
    table = f"processado_{uuid.uuid4().hex}"
    bucketed.create(base, table, scratch_path(spark, "buckets"), fv.PROCESSED_KEYS, _BUCKETS)
    bucketed.upsert_table(spark, table, batch, fv.PROCESSED_UPDATES)
    return r.doubles(spark.table(table))
