"""Typed catalog tables for the processed rows and the star schema."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column types and defaults of the published tables
_METRICS = """
    area_colhida_ha DECIMAL(15,2),
    qtd_produzida DECIMAL(18,2),
    rendimento_medio_kg_ha DECIMAL(10,2),
    valor_producao_mil_reais DECIMAL(18,2)"""

TABLES = {
    "dim_commodity": """
    id_commodity INT,
    codigo_sidra VARCHAR(10),
    nome_oficial VARCHAR(100),
    unidade_medida VARCHAR(30) DEFAULT 'Toneladas'""",
    "dim_territorio": """
    id_territorio INT,
    codigo_ibge VARCHAR(10),
    nome VARCHAR(100),
    nivel_territorial VARCHAR(30)""",
    "fato_producao": f"""
    id_producao INT,
    id_commodity INT,
    id_territorio INT,
    ano SMALLINT,{_METRICS},
    fonte VARCHAR(30) DEFAULT 'IBGE/PAM-SIDRA',
    tabela_sidra VARCHAR(10) DEFAULT '5457',
    url_origem STRING,
    coletado_em TIMESTAMP_NTZ""",
    "producao_agricola": f"""
    id INT,
    produto VARCHAR(50),
    produto_nome_ibge VARCHAR(150),
    produto_cod VARCHAR(10),
    nivel_territorial VARCHAR(30),
    cod_territorial VARCHAR(10),
    nome_territorial VARCHAR(100),
    ano SMALLINT,{_METRICS},
    unidade_qtd VARCHAR(20),
    status_dado VARCHAR(15) DEFAULT 'completo',
    fonte VARCHAR(30),
    tabela_sidra VARCHAR(10),
    url_origem STRING,
    coletado_em TIMESTAMP_NTZ,
    processado_em TIMESTAMP_NTZ,
    versao_etl VARCHAR(10) DEFAULT '1.0'""",
}


def create_tables(spark: SparkSession, schema: str, location: str) -> dict[str, str]:
    """Create the schema and its tables where absent: short name -> full name.

    VARCHAR lengths and decimal precision are enforced by Spark on insert; keys and
    checks are reported by `operators.quality.constraint_report`.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{location}'")
    for name, columns in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{name} ({columns}) USING parquet")
    return {name: f"{schema}.{name}" for name in TABLES}


def append_to(df: DataFrame, table: str) -> None:
    """Insert by column name; table columns the frame lacks take their default."""
    target = df.sparkSession.table(table).schema
    shared = [f for f in target if f.name in df.columns]
    view = f"rows_{uuid.uuid4().hex}"
    df.select(*[F.col(f.name).cast(f.dataType) for f in shared]).createOrReplaceTempView(view)
    names = ", ".join(f.name for f in shared)
    df.sparkSession.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {view}")
    df.sparkSession.catalog.dropTempView(view)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append to a table of an outside database, in batches, one connection per task."""
    df.write.mode("append").option("batchsize", 10_000).jdbc(url, table, properties=properties)
