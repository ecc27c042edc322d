import glob
import json

import pytest
from conftest import values
from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark import schemas
from cropspark.sources import catalog, lake
from cropspark.sources import snapshots as snap
from cropspark.streaming.incremental import load_landed

AT = "2024-01-01 10:00:00"


def row(product="Soja", code="1", year=2023, area=1.5, place='Bra"sil, x', level="Brasil", at=AT):
    return (product, code, level, "1", place, year, area, None, "t", 3.0, 4.0, "f", "5457", "u", at)


@pytest.fixture
def wide(spark):
    data = [row(), row("Café (em grão)", "2", 2024), row("Arroz", "3", 2023, None)]
    return spark.createDataFrame(data, schemas.RAW_WIDE)


def test_csv_round_trip_with_and_without_mark(spark, wide, tmp_path):
    for single in (False, True):
        path = str(tmp_path / f"csv{single}")
        snap.write_csv(wide, path, single_file=single)
        assert values(snap.read_csv(spark, path)) == values(wide)
    first = open(glob.glob(str(tmp_path / "csvTrue" / "part-*"))[0], "rb").read(3)
    assert first == b"\xef\xbb\xbf"


def test_three_formats_hold_the_same_rows(spark, wide, tmp_path):
    paths = snap.write_raw_layer(wide, str(tmp_path), "brasil", [2024, 2023], "20240101", AT)
    assert paths["csv"].endswith("/csv/ibge_pam_brasil_2023_2024_20240101.csv")
    for df in (snap.read_csv(spark, paths["csv"]), snap.read_json_envelopes(spark, paths["json"]), spark.read.parquet(paths["parquet"])):
        assert values(df.select(*wide.columns)) == values(wide)
    document = json.loads(open(glob.glob(paths["json"] + "/part-*.json")[0]).readline())
    assert document["total_registros"] == 3 and document["anos"] == [2024, 2023]

    files = snap.snapshot_files(spark, paths, 3)
    assert [r["formato"] for r in files.orderBy("formato").collect()] == ["csv", "json", "parquet"]
    described = snap.manifest(files, "crop", "brasil", [2023, 2024], AT).first()
    assert set(described["arquivos"]) == {"csv", "json", "parquet"} and described["total_linhas"] == 3
    saved = snap.write_manifest(snap.manifest(files, "crop", "brasil", [2023, 2024], AT), str(tmp_path))
    assert json.loads(open(glob.glob(saved + "/part-*.json")[0]).readline())["arquivos"]["csv"]["linhas"] == 3
    share = {r["formato"]: r["pct_do_csv"] for r in snap.format_size_report(files).collect()}
    assert share["csv"] == 100.0


def test_envelopes_stay_small_and_whole(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 3).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.RAW_WIDE if f.name != "ano"], F.col("id").cast("int").alias("ano"))
    path = str(tmp_path / "p")
    snap.write_parquet(rows, path)
    docs = snap.json_envelopes(spark.read.parquet(path), "uf", [1], AT, per_document=100)
    assert docs.select(F.max(F.size("registros"))).first()[0] <= 100
    assert docs.select(F.explode("registros.ano").alias("a")).distinct().count() == 1000
    assert [r[0] for r in docs.select("total_registros").distinct().collect()] == [1000]


def test_an_indented_envelope_is_read(spark, tmp_path):
    record = {"produto": "Azeitona", "produto_cod": "40131", "ano": 2023, "area_colhida_ha": 6862.0}
    (tmp_path / "e.json").write_text(json.dumps({"fonte": "x", "registros": [record, record]}, indent=2))
    assert snap.read_json_envelopes(spark, str(tmp_path / "e.json"), multi_line=True).count() == 2


def test_newest_by_name_and_by_date_differ(spark, wide, tmp_path):
    for name in ("ibge_pam_uf_2023_20240101", "ibge_pam_brasil_2023_20240301", "ibge_pam_municipio_2023_20240201"):
        snap.write_csv(wide.limit(1), str(tmp_path / f"{name}.csv"))
    folder = str(tmp_path)
    assert snap.newest_snapshot(spark, folder).endswith("ibge_pam_uf_2023_20240101.csv")
    assert snap.newest_snapshot(spark, folder, by="date").endswith("ibge_pam_brasil_2023_20240301.csv")
    assert snap.scan_latest_snapshot(spark, folder).count() == 1
    with pytest.raises(ValueError):
        snap.newest_snapshot(spark, folder, by="size")


def test_no_snapshot_is_no_rows(spark, tmp_path):
    assert snap.newest_snapshot(spark, str(tmp_path)) is None
    assert snap.scan_latest_snapshot(spark, str(tmp_path)).count() == 0


def test_a_file_with_mark_and_doubled_quotes_is_read(spark, tmp_path):
    header = ",".join(fv.RAW_COLUMNS)
    line = 'Soja,1,Brasil,1,"Bra""sil, x",2023,1.5,,t,3.0,4.0,f,5457,u,' + AT
    (tmp_path / "ibge_pam_brasil_2023_20240101.csv").write_text(f"\ufeff{header}\n{line}\n", encoding="utf-8")
    assert values(snap.scan_latest_snapshot(spark, str(tmp_path))) == [row()]


def test_names(spark):
    parts = snap.parse_snapshot_name(F.col("n"))
    df = spark.createDataFrame([("x/ibge_pam_brasil_2023_2024_20260323.csv",), ("other.csv",)], "n string")
    got = [tuple(r) for r in df.select(*[c.alias(k) for k, c in parts.items()]).collect()]
    assert got[0][1:3] == ("brasil", [2023, 2024]) and str(got[0][3]) == "2026-03-23"
    assert got[1][0] is None and got[1][3] is None


def test_first_source_with_rows_wins(spark, wide):
    empty = wide.where("false")
    assert snap.first_available({"a": empty, "b": wide}).first()["fonte_carga"] == "b"
    assert snap.first_available({"a": empty, "b": empty}).count() == 0


def test_lake_prunes_partitions(spark, wide, tmp_path):
    path = str(tmp_path / "lake")
    lake.write_lake(wide.withColumnsRenamed({"tabela_sidra": "tabela", "nivel_territorial": "nivel"}), path)
    assert glob.glob(path + "/tabela=5457/nivel=Brasil/ano=2024/*.parquet")
    one = lake.read_lake(spark, path).where((F.col("nivel") == "Brasil") & (F.col("ano") == 2023)).select("produto")
    assert one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(nivel" in plan and "ReadSchema: struct<produto:string>" in plan


def test_tables_enforce_types_and_defaults(spark, tmp_path):
    tables = catalog.create_tables(spark, "crop_test", str(tmp_path / "w"))
    catalog.create_tables(spark, "crop_test", str(tmp_path / "w"))
    dim = spark.createDataFrame([(1, "40124", "Soja")], "id_commodity int, codigo_sidra string, nome_oficial string")
    catalog.append_to(dim, tables["dim_commodity"])
    assert spark.table(tables["dim_commodity"]).first()["unidade_medida"] == fv.DEFAULT_UNIT
    with pytest.raises(Exception, match="(?i)exceed"):
        catalog.append_to(dim.withColumn("codigo_sidra", F.lit("12345678901")), tables["dim_commodity"])


def test_new_files_are_upserted_once(spark, tmp_path):
    landed, table, checkpoint = (str(tmp_path / d) for d in ("landed", "table", "checkpoint"))

    def land(name, *rows):
        snap.write_csv(spark.createDataFrame(list(rows), schemas.RAW_WIDE), f"{landed}/{name}")

    def load():
        load_landed(spark, landed, table, checkpoint, AT).awaitTermination()
        return values(lake.read_lake(spark, table, schemas.PROCESSED), "produto_cod", "area_colhida_ha")

    land("a.csv", row(), row(code="2"))
    assert load() == [("1", 1.5), ("2", 1.5)]
    land("b.csv", row(area=9.0, at="2024-02-01 00:00:00"), row(code="3"), row(code="bad"))
    assert load() == [("1", 9.0), ("2", 1.5), ("3", 1.5)]
    assert load() == [("1", 9.0), ("2", 1.5), ("3", 1.5)]


def test_a_new_checkpoint_loads_its_first_batch(spark, tmp_path):
    landed, table = (str(tmp_path / d) for d in ("landed", "table"))
    for k, code in enumerate("12"):
        snap.write_csv(spark.createDataFrame([row(code=code)], schemas.RAW_WIDE), f"{landed}-{k}/a.csv")
        load_landed(spark, f"{landed}-{k}", table, str(tmp_path / f"checkpoint-{k}"), AT).awaitTermination()
    assert values(lake.read_lake(spark, table, schemas.PROCESSED), "produto_cod") == [("1",), ("2",)]


def test_csv_keeps_blanks_quotes_and_line_breaks(spark, tmp_path):
    texts = ["  a b ", 'say "x"', "one\ntwo\r\nthree", "back\\nslash", "\\\\", "tab\t", None]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "produto string, ano int")
    snap.write_csv(df, str(tmp_path / "x.csv"), order=["produto", "ano"], escaped=True)
    back = snap.read_csv(spark, str(tmp_path / "x.csv"), df.schema, escaped=True)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == sorted(map(tuple, df.collect()), key=lambda r: r[1])


def test_upsert_leaves_other_years_alone(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, v int, ano int"
    base = spark.createDataFrame([("a", 1, 2020), ("b", 2, 2020), ("a", 3, 2021)], schema)
    lake.write_lake(base, path, ("ano",))
    before = sorted(str(p) for p in (tmp_path / "t" / "ano=2021").glob("*.parquet"))
    batch = spark.createDataFrame([("b", 9, 2020), ("c", 5, 2022), (None, 7, 2020)], schema)
    for _ in range(2):
        lake.upsert_lake(path, batch, ["k", "ano"], ["v"], base.schema)
        found = values(lake.read_lake(spark, path, base.schema), "k", "v", "ano")
        assert found == [("a", 1, 2020), ("a", 3, 2021), ("b", 9, 2020), ("c", 5, 2022)]
    assert sorted(str(p) for p in (tmp_path / "t" / "ano=2021").glob("*.parquet")) == before


def _row_groups(folder, code):
    """Row groups of a folder, and those whose limits let a code be in them."""
    import pyarrow.parquet as pq

    total = hit = 0
    for path in folder.rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index("code")
        for i in range(meta.num_row_groups):
            limits = meta.row_group(i).column(at).statistics
            total, hit = total + 1, hit + (limits.min <= code <= limits.max)
    return total, hit


def test_clustering_lets_a_filter_skip_row_groups(spark, tmp_path):
    year, code = (F.col("id") % 2 + 2000).cast("int"), F.format_string("c%04d", F.col("id") * 7919 % 400)
    hot = F.when(F.col("id") % 3 == 0, "c0200").otherwise(code)
    df = spark.range(0, 40_000, 1, 8).select(year.alias("ano"), hot.alias("code"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    lake.write_lake(df, str(tmp_path / "plain"), ["ano"])
    lake.write_clustered(df, str(tmp_path / "clustered"), ["code"], ["ano"], row_group_bytes=64 << 10)
    total, hit = _row_groups(tmp_path / "clustered", "c0123")
    plain_total, plain_hit = _row_groups(tmp_path / "plain", "c0123")
    assert plain_hit == plain_total and hit <= 4 < total
    # the hot code lies in several files
    assert len({r[0] for r in spark.read.parquet(str(tmp_path / "clustered")).where("code = 'c0200'").select(F.input_file_name()).collect()}) > 2
    for path in ("plain", "clustered"):
        back = lake.read_lake(spark, str(tmp_path / path), df.schema)
        assert back.count() == 40_000 and back.where("code = 'c0123'").count() == df.where("code = 'c0123'").count()
    lake.write_clustered(df.where("ano = 2001").limit(5), str(tmp_path / "clustered"), ["code"], ["ano"], touched_only=True)
    assert lake.read_lake(spark, str(tmp_path / "clustered"), df.schema).groupBy("ano").count().orderBy("ano").collect() == [(2000, 20_000), (2001, 5)]
