from conftest import values
from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark import schemas
from cropspark.operators import reports, rows

URL = "landed/a.json"
AT = "2026-03-23 22:39:15"


def raw(produto, cod, ano, area, qtd, rend, valor, nome="Brasil", unidade="Mil Reais", fonte="IBGE/PAM-SIDRA"):
    return (produto, cod, "Brasil", "1", nome, ano, area, qtd, unidade, rend, valor, fonte, "5457", URL, AT)


# rows of a published snapshot and their published clean-up
GOLDEN = [
    (raw("Azeitona", "40131", "2023", "6862.0", "31489.0", "1780.0", "3856.0"), "Azeitona"),
    (raw("Cacau (em amêndoa)", "40138", "2024", "297509.0", "15264498.0", "482.0", "617168.0"), "Cacau"),
    (raw("Café (em grão) Canephora", "40141", "2023", "983899.0", "10657060.0", "2516.0", "391006.0"), "Café (Em Grão) Canephora"),
    (raw("Erva-mate (folha verde)", "40147", "2023", "736193.0", "956804.0", "8967.0", "82100.0"), "Erva-Mate (Folha Verde)"),
    (raw("Guaraná (semente)", "40150", "2024", "2663.0", "68031.0", "277.0", "9609.0"), "Guaraná (Semente)"),
    (raw("Soja (em grão)", "40124", "2024", "144473768.0", "260233510.0", "3147.0", "45906902.0"), "Soja"),
    (raw("Sorgo (em grão)", "40125", "2023", "4498299.0", "2709971.0", "3346.0", "1344408.0"), "Sorgo"),
    (raw("Triticale (em grão)", "40128", "2023", "58914.0", "52059.0", "2396.0", "24585.0"), "Triticale"),
]


def frame(spark, data):
    return spark.createDataFrame(data, schemas.RAW_WIDE_TEXT)


def test_published_rows_come_out_as_published(spark):
    cleaned = rows.clean_rows(frame(spark, [g[0] for g in GOLDEN]), "2026-03-23 16:41:09")
    assert cleaned.columns == fv.PROCESSED_COLUMNS
    got = {r["produto_cod"]: r for r in cleaned.collect()}
    for source, name in GOLDEN:
        row = got[source[1]]
        assert (row["produto"], row["produto_nome_ibge"]) == (name, source[0])
        assert [row[m] for m in fv.METRICS] == [float(source[i]) for i in (6, 7, 9, 10)]
        assert (row["unidade_qtd"], row["status_dado"], row["versao_etl"]) == ("MIL REAIS", "completo", "1.0")
        assert (str(row["coletado_em"]), str(row["processado_em"])) == (AT, "2026-03-23 16:41:09")


def test_a_negative_keeps_the_status_it_had(spark):
    row = rows.clean_rows(frame(spark, [raw("x", "1", "2020", "-1", "2", "3", "4")]), AT).first()
    assert row["status_dado"] == "completo" and row["area_colhida_ha"] is None


def test_missing_metric_is_partial_and_listed(spark):
    cleaned = rows.clean_rows(
        frame(spark, [raw("x", "1", "2020", "...", "2", "3", "4"), raw("y", "2", "2021", "1", "2", "3", "4")]), AT
    )
    assert values(reports.status_counts(cleaned)) == [("completo", 1), ("parcial", 1)]
    assert values(rows.partial_records(cleaned), "produto") == [("X",)]


def test_codes_stay_text_when_one_is_missing(spark):
    cleaned = rows.clean_rows(
        frame(spark, [raw("x", "040124", "2020", "1", "2", "3", "4"), raw("y", None, "2020", "1", "2", "3", "4")]), AT
    )
    assert values(cleaned, "produto_cod") == [("040124",)]


def test_validation_conserves_rows(spark):
    data = [
        raw("a", "1", "1973", "1", "1", "1", "1"),
        raw("a", "1", "1974", "1", "-1", "1", "1"),
        raw("a", "1", "2101", "1", "1", "1", "1"),
        raw("a", "1", None, "1", "1", "1", "1"),
        raw("a", "B1", "2000", "-1", "1", "1", "1"),
        raw("a", None, "2000", "1", "1", "1", "1"),
        raw("a", "1", "2000", "1", "1", "1", "-9"),
    ]
    typed = rows.coerce_types(frame(spark, data))
    report = dict(values(rows.validation_report(typed)))
    kept = rows.validate_rows(typed)
    assert report["total"] == report["ano inválido"] + report["código inválido"] + report["aprovados"] == 7
    assert report["aprovados"] == kept.count() == 2
    assert (report["negativo em qtd_produzida"], report["negativo em area_colhida_ha"]) == (1, 0)
    assert dict(values(rows.null_profile(kept)))["valor_producao_mil_reais"] == 1


def test_year_limit_is_a_parameter(spark):
    typed = rows.coerce_types(frame(spark, [raw("a", "1", "2030", "1", "1", "1", "1")]))
    assert rows.validate_rows(typed, max_year=2025).count() == 0
    assert rows.validate_rows(typed, max_year=2030).count() == 1


def test_projection_and_renames(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b int, x int, a int")
    assert rows.project_ordered(df, ["a", "missing", "b"]).columns == ["a", "b"]
    assert rows.rename_if_present(df, {"x": "y", "missing": "z"}).columns == ["b", "y", "a"]
    assert rows.add_missing_columns(df, ["a", "m"]).dtypes[-1] == ("m", "double")


def test_empty_selection_keeps_all(spark):
    df = spark.createDataFrame([(1, "p"), (2, "q")], "ano int, produto string")
    assert rows.filter_isin(df, {"ano": [], "produto": []}).count() == 2
    assert rows.filter_isin(df, {"ano": [1], "produto": []}).count() == 1


def test_clean_up_runs_without_python_workers(spark):
    plan = rows.clean_rows(frame(spark, [g[0] for g in GOLDEN]), AT)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_name_map_and_options(spark):
    cleaned = rows.clean_rows(frame(spark, [g[0] for g in GOLDEN]), AT)
    assert ("Soja", "Soja (em grão)", "40124") in values(reports.distinct_name_map(cleaned))
    years = [r[0] for r in reports.filter_options(cleaned, "ano", descending=True).collect()]
    assert years == [2024, 2023]
    lines = {r["produto"]: r for r in reports.collection_report(cleaned.withColumn("qtd_produzida", F.lit(None).cast("double"))).collect()}
    assert lines["Soja"]["qtd_texto"] == "—" and lines["Soja"]["valor_texto"] == "45,906,902"
    assert lines["Soja"]["total_linhas"] == len(GOLDEN)


def test_the_year_is_written_out_a_few_times_only_in_the_filter(spark, capsys):
    """A filter that repeats its input too often is too long a method for the JVM to compile."""
    data = frame(spark, [raw("Soja", "40124", "2024", "1", "2", "3", "4"), raw("Soja", "40124", "n/d", "1", "2", "3", "4")])
    marked = data.withColumn("ano", F.when(F.col("produto_cod") == "year-mark", "n/d").otherwise(F.col("ano")))
    cleaned = rows.clean_rows(marked, AT).select("produto", "produto_cod")
    capsys.readouterr()
    cleaned.explain()
    filters = [x for x in capsys.readouterr().out.split("\n+- ") if "year-mark" in x and "Filter" in x]
    assert filters and max(x.count("year-mark") for x in filters) <= 24
    assert cleaned.count() == 1
