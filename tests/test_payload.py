import json

from conftest import values

from cropspark import fixed_values as fv
from cropspark.operators.reshape import attach_unit, pivot_first_nonnull
from cropspark.sources import payload as src

HEADER = {k: "header" for k in "D1C D1N D2C D2N D3C D3N D4C D4N MC MN NC NN V".split()}
AT = "2024-01-01 00:00:00"


def cell(var, value, product="Soja", code="40124", year="2023", place="1", level="Brasil", unit="Toneladas"):
    return {"D1C": place, "D1N": f"P{place}", "D2C": var, "D3N": year, "D4C": code, "D4N": product,
            "MN": unit, "NN": level, "V": value}


def docs(spark, *documents):
    rows = [(json.dumps(d) if isinstance(d, list) else d, f"u{i}") for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "payload string, url_origem string")


def cells_of(spark, *documents):
    return src.payload_to_cells(docs(spark, *documents), AT)


def test_header_and_bad_documents_give_no_cells(spark):
    cells = cells_of(spark, [HEADER], "not json", [HEADER, cell("214", "1.234,5"), cell("999", "X")])
    assert values(cells, "variavel_col", "valor", "posicao") == [
        ("area_colhida_ha", 1234.5, 1), ("var_999", None, 2),
    ]


def test_absent_keys_are_empty_text(spark):
    row = cells_of(spark, [HEADER, {"V": "1"}]).first()
    assert (row["produto"], row["variavel_col"], row["valor"]) == ("", "var_", 1.0)


def test_pivot_takes_the_first_value_that_is_not_null(spark):
    cells = cells_of(
        spark, [HEADER, cell("214", "-"), cell("214", "5"), cell("214", "6"), cell("215", "7")]
    )
    wide = pivot_first_nonnull(cells)
    assert values(wide, *fv.METRICS) == [(5.0, 7.0, None, None)]


def test_all_null_keys_and_null_key_columns_drop_out(spark):
    cells = cells_of(spark, [HEADER, cell("214", "..."), cell("215", "X"), cell("214", "1", year="2024")])
    assert values(pivot_first_nonnull(cells), "ano") == [("2024",)]
    from pyspark.sql import functions as F

    no_place = cells.withColumn("nome_territorial", F.lit(None).cast("string"))
    assert pivot_first_nonnull(no_place).count() == 0


def test_the_same_key_fetched_twice_gives_two_rows(spark):
    document = [HEADER, cell("214", "1")]
    assert pivot_first_nonnull(cells_of(spark, document, document)).count() == 2


def test_units_fan_out_and_null_keys_match(spark):
    cells = cells_of(
        spark,
        [HEADER, cell("215", "1"), cell("215", "2", level="UF", unit="Mil frutos")],
    )
    wide = attach_unit(pivot_first_nonnull(cells), cells)
    assert values(wide, "nivel_territorial", "unidade_qtd") == [
        ("Brasil", "Mil frutos"), ("Brasil", "Toneladas"), ("UF", "Mil frutos"), ("UF", "Toneladas"),
    ]
    nulls = spark.createDataFrame([(None, 1.0)], "k string, v double")
    units = spark.createDataFrame([(None, "qtd_produzida", "kg")], "k string, variavel_col string, unidade_api string")
    assert values(attach_unit(nulls, units, keys=["k"])) == [(None, 1.0, "kg")]


def test_collection_is_typed_sorted_and_complete(spark):
    wide = src.collect_wide(
        docs(spark, [HEADER, cell("214", "2", year="2024"), cell("214", "1")],
             [HEADER, cell("216", "3", product="Arroz", code="40128")]), AT
    )
    assert wide.columns == fv.RAW_COLUMNS
    assert [(r["produto"], r["ano"]) for r in wide.collect()] == [("Arroz", 2023), ("Soja", 2023), ("Soja", 2024)]
    assert src.collect_wide(docs(spark, [HEADER]), AT).count() == 0


def test_corrected_variable_map_is_an_option(spark):
    document = [HEADER, cell("214", "1")]
    row = src.payload_to_cells(docs(spark, document), AT, variables=fv.VARIABLES_CORRECTED).first()
    assert row["variavel_col"] == "qtd_produzida"


def test_second_form_is_read_by_header_text(spark):
    header = {"A": "Variável", "B": "Valor", "C": "Produto das lavouras temporárias"}
    document = [header, {"A": "Quantidade produzida", "B": "10", "C": "Soja"},
                {"A": "Área plantada", "B": "..", "C": "Soja"}, {"A": "Área plantada", "B": "n/d", "C": "Soja"}]
    named = src.header_named_cells(docs(spark, document))
    assert values(src.clean_long_values(named)) == [("Soja", "Quantidade produzida", 10.0, None)]


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([HEADER, cell("214", "1")], indent=1))
    read = src.read_payloads(spark, str(tmp_path), whole_files=True)
    cells = src.payload_to_cells(read, AT)
    assert cells.count() == 1 and cells.first()["url_origem"].endswith("a.json")
    assert src.union_blocks([cells, cells]).count() == 2
