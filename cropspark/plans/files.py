"""Snapshots, envelopes, lakes and tables written to the shared folder and read back."""

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark import schemas
from cropspark.operators import quality, rows, star
from cropspark.plans import roles as r
from cropspark.plans.registry import query
from cropspark.session import scratch_path
from cropspark.sources import catalog, lake
from cropspark.sources import snapshots as snap

_YEARS = list(range(1995, 2002))
_DAY = "20240115"
_RAW = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c in fv.METRICS else c for c in fv.RAW_COLUMNS
)


def raw_rows(spark, folder):
    return r.doubles(r.wide(spark, folder))


def _raw_layer(spark, folder):
    root = scratch_path(spark, "raw")
    return snap.write_raw_layer(raw_rows(spark, folder), root, "uf", _YEARS, _DAY, r.COLLECTED_AT)


@query("csv_sink_roundtrip", sql=f"WITH {r.SQL_WIDE} SELECT {_RAW} FROM wide")
def csv_sink_roundtrip(spark, folder):
    path = scratch_path(spark, "csv")
    snap.write_csv(raw_rows(spark, folder), path)
    return snap.read_csv(spark, path)


@query("parquet_sink_roundtrip", sql=f"WITH {r.SQL_WIDE} SELECT {_RAW} FROM wide")
def parquet_sink_roundtrip(spark, folder):
    path = scratch_path(spark, "parquet")
    snap.write_parquet(raw_rows(spark, folder), path)
    return spark.read.schema(schemas.RAW_WIDE).parquet(path)


@query("json_envelope_roundtrip", sql=f"WITH {r.SQL_WIDE} SELECT {_RAW} FROM wide")
def json_envelope_roundtrip(spark, folder):
    return snap.read_json_envelopes(spark, _raw_layer(spark, folder)["json"])


@query(
    "scan_latest_snapshot",
    sql=f"WITH {r.SQL_WIDE} SELECT {_RAW} FROM wide WHERE ano >= {r.YEAR}",
)
def scan_latest_snapshot(spark, folder):
    """Two snapshots of different days; only the later one is read."""
    root = scratch_path(spark, "snapshots")
    rows = raw_rows(spark, folder)
    snap.write_csv(rows, f"{root}/ibge_pam_uf_1995_2001_20240101.csv")
    snap.write_csv(rows.where(F.col("ano") >= r.YEAR), f"{root}/ibge_pam_uf_1995_2001_20240115.csv")
    return snap.scan_latest_snapshot(spark, root)


@query(
    "raw_layer_write",
    sql=f"""WITH {r.SQL_WIDE} SELECT unnest(['csv', 'json', 'parquet']) AS tabela,
      (SELECT count(*) FROM wide) AS total""",
)
def raw_layer_write(spark, folder):
    """Rows that each format of one snapshot gives back."""
    paths = _raw_layer(spark, folder)
    return quality.table_counts(
        {
            "csv": snap.read_csv(spark, paths["csv"]),
            "json": snap.read_json_envelopes(spark, paths["json"]),
            "parquet": spark.read.parquet(paths["parquet"]),
        }
    )


def _written_files(spark, folder):
    paths = _raw_layer(spark, folder)
    rows = spark.read.parquet(paths["parquet"]).agg(F.count(F.lit(1))).scalar()
    return snap.snapshot_files(spark, paths, rows)


@query("snapshot_manifest")
def snapshot_manifest(spark, folder):
    """Describe a written snapshot, save the description, read it back, one row per format.

    Sizes are those of the files, so there is no SQL for them; tests hold them against the files.
    """
    files = _written_files(spark, folder)
    described = snap.manifest(files, "cropspark", "uf", _YEARS, r.COLLECTED_AT)
    path = snap.write_manifest(described, scratch_path(spark, "manifest"))
    saved = spark.read.schema(described.schema).json(path)
    entries = saved.select(*[c for c in saved.columns if c != "arquivos"], F.explode("arquivos").alias("arquivo", "f"))
    name = F.element_at(F.split("f.path", "/"), -1)
    kb = F.abs(F.col("f.tamanho_bytes") / 1024 - F.col("f.tamanho_kb")) <= 0.005
    return entries.select(
        "pipeline", "camada", "fonte", "tabela", "nivel", "anos", "total_linhas", "gerado_em", "f.formato", name.alias("nome"),
        "f.linhas", "f.tamanho_bytes", "f.tamanho_kb", "f.salvo_em", kb.alias("kb_confere"),
    )


@query("format_size_report")
def format_size_report(spark, folder):
    """Size of each format beside the CSV; no SQL knows the sizes of files."""
    files = _written_files(spark, folder)
    sizes = files.select("formato", "linhas", "tamanho_bytes")
    return snap.format_size_report(files).join(sizes, "formato").select("formato", "linhas", "tamanho_bytes", "tamanho_kb", "pct_do_csv")


@query(
    "partition_pruned_scan",
    sql=f"""WITH {r.SQL_WIDE} SELECT produto, CAST(qtd_produzida AS DOUBLE) AS qtd_produzida,
      CAST(valor_producao_mil_reais AS DOUBLE) AS valor_producao_mil_reais
      FROM wide WHERE nivel_territorial = 'ASIA' AND ano = {r.YEAR}""",
)
def partition_pruned_scan(spark, folder):
    """Write the lake by table, level and year; read one level and year of it."""
    path = scratch_path(spark, "lake")
    rows = raw_rows(spark, folder).withColumnsRenamed({"tabela_sidra": "tabela", "nivel_territorial": "nivel"})
    lake.write_lake(rows, path)
    return (
        lake.read_lake(spark, path)
        .where((F.col("nivel") == "ASIA") & (F.col("ano") == r.YEAR))
        .select("produto", "qtd_produzida", "valor_producao_mil_reais")
        .orderBy(F.col("valor_producao_mil_reais").desc_nulls_last())
    )


@query(
    "clustered_scan",
    sql=f"""WITH {r.SQL_WIDE} SELECT produto, produto_cod, cod_territorial, ano, CAST(qtd_produzida AS DOUBLE) AS qtd_produzida
      FROM wide WHERE produto_cod IN ('40124', '40131') AND ano >= {r.YEAR}""",
)
def clustered_scan(spark, folder):
    """A lake by year, clustered by product: a filter on products skips row groups."""
    path = scratch_path(spark, "clustered")
    rows_ = raw_rows(spark, folder)
    lake.write_clustered(rows_, path, ["produto_cod"], ["ano"])
    found = lake.read_lake(spark, path, rows_.schema).where(F.col("produto_cod").isin("40124", "40131") & (F.col("ano") >= r.YEAR))
    return found.select("produto", "produto_cod", "cod_territorial", "ano", "qtd_produzida")


_KEYED = " AND ".join(f"{k} IS NOT NULL" for k in fv.PROCESSED_KEYS)


@query(
    "create_star_tables",
    sql=f"""WITH {r.SQL_PROCESSED}, fato AS (SELECT DISTINCT id_commodity, id_territorio, ano FROM lines),
        {r.SQL_DIM_COMMODITY}, {r.SQL_DIM_TERRITORY},
        unicas AS (SELECT DISTINCT {', '.join(fv.PROCESSED_KEYS)} FROM processado WHERE {_KEYED})
      SELECT 'dim_commodity' AS tabela, count(*) AS total, max(id_commodity) AS maior_id FROM dim_commodity
      UNION ALL SELECT 'dim_territorio', count(*), max(id_territorio) FROM dim_territorio
      UNION ALL SELECT 'fato_producao', count(*), count(*) FROM fato
      UNION ALL SELECT 'fato_producao com fonte padrão', count(*), count(*) FROM fato
      UNION ALL SELECT 'producao_agricola', count(*), count(*) FROM unicas""",
)
def create_star_tables(spark, folder):
    """Create typed tables, load the star schema and the processed rows, count what the tables hold.

    Facts and processed rows are numbered from 1 by their keys.
    """
    name = f"crop_{uuid.uuid4().hex}"
    tables = catalog.create_tables(spark, name, scratch_path(spark, "warehouse"))
    catalog.append_to(r.dim_commodity(spark, folder), tables["dim_commodity"])
    catalog.append_to(r.dim_territory(spark, folder), tables["dim_territorio"])
    catalog.append_to(star.number_rows(r.fact(spark, folder), fv.FACT_KEYS, "id_producao"), tables["fato_producao"])
    rows_ = star.unique_batch(
        rows.clean_rows(r.raw_lines(spark, folder), r.PROCESSED_AT), fv.PROCESSED_KEYS, "last", ["coletado_em", "url_origem"]
    )
    catalog.append_to(star.number_rows(rows_, fv.PROCESSED_KEYS, "id"), tables["producao_agricola"])
    fact = spark.table(tables["fato_producao"])
    held = {
        "dim_commodity": (spark.table(tables["dim_commodity"]), "id_commodity"),
        "dim_territorio": (spark.table(tables["dim_territorio"]), "id_territorio"),
        "fato_producao": (fact, "id_producao"),
        "fato_producao com fonte padrão": (fact.where(F.col("fonte") == fv.SOURCE_NAME), "id_producao"),
        "producao_agricola": (spark.table(tables["producao_agricola"]), "id"),
    }
    reports = [
        df.agg(F.count(F.lit(1)).alias("total"), F.max(i).cast("bigint").alias("maior_id")).select(F.lit(n).alias("tabela"), "total", "maior_id")
        for n, (df, i) in held.items()
    ]
    return functools.reduce(DataFrame.unionAll, reports)
