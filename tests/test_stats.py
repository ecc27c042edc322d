import numpy as np
import pandas as pd
import pytest
from conftest import values

from cropspark.functions.quantiles import exact_percentiles
from cropspark.operators import reports, stats

PROBS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def skewed(seed=3):
    rng = np.random.default_rng(seed)
    groups = rng.choice(["hot", "b", "c", None], size=6000, p=[0.6, 0.2, 0.19, 0.01])
    numbers = np.round(rng.lognormal(3, 2, size=6000), 3)
    numbers[rng.random(6000) < 0.2] = 7.0  # a heavily repeated value
    return pd.DataFrame({"g": groups, "v": numbers})


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
def test_percentiles_are_exact_for_any_sketch_size(spark, accuracy):
    data = skewed()
    df = spark.createDataFrame([(g, float(v)) for g, v in data.itertuples(index=False)], "g string, v double")
    got = {r["g"]: r for r in exact_percentiles(df.repartition(5), "v", PROBS, by=["g"], accuracy=accuracy).collect()}
    assert len(got) == 4
    for group, row in got.items():
        own = data.v[data.g.isna() if group is None else data.g == group]
        assert row["n"] == len(own)
        assert [row[p] for p in PROBS] == pytest.approx([own.quantile(q) for q in PROBS.values()], rel=1e-12)
    whole = exact_percentiles(df, "v", PROBS, accuracy=accuracy).first()
    assert [whole[p] for p in PROBS] == pytest.approx([data.v.quantile(q) for q in PROBS.values()], rel=1e-12)


@pytest.mark.parametrize("n", range(1, 12))
def test_percentiles_of_few_rows(spark, n):
    numbers = [float(x * x) for x in range(n)]
    df = spark.createDataFrame([(x,) for x in numbers] + [(None,), (float("nan"),)], "v double")
    row = exact_percentiles(df, "v", PROBS).first()
    assert [row[p] for p in PROBS] == pytest.approx(list(np.quantile(numbers, list(PROBS.values()))))


def test_describe_matches_pandas(spark):
    data = skewed(5)
    df = spark.createDataFrame([(float(v), None) for v in data.v] + [(None, 1.0)], "v double, w double")
    got = {r["coluna"]: r for r in stats.describe_metrics(df, ["v", "w"]).collect()}
    summary = data.v.describe().round(2)
    names = {"mean": "media", "std": "desvio_padrao", "min": "minimo", "max": "maximo", "25%": "q1", "50%": "mediana", "75%": "q3"}
    for theirs, ours in names.items():
        assert got["v"][ours] == pytest.approx(summary[theirs], abs=0.011)
    assert (got["v"]["registros"], got["w"]["registros"], got["w"]["desvio_padrao"]) == (6000, 1, None)


def test_references_are_of_means_or_of_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0), ("c", 100.0), ("d", None)], "p string, y double")
    means = stats.mean_by_with_references(df, "p", "y").collect()
    assert [(r["p"], r["y"]) for r in means] == [("c", 100.0), ("b", 8.0), ("a", 2.0)]
    assert (means[0]["media"], means[0]["mediana"]) == (pytest.approx(110 / 3), 8.0)
    rows = stats.row_values_with_references(df, "p", "y").first()
    assert (rows["media"], rows["mediana"]) == (28.0, 5.5)


def test_cards_of_nothing_are_zero(spark):
    schema = "produto string, qtd_produzida double, area_colhida_ha double, valor_producao_mil_reais double"
    empty = stats.kpi_summary(spark.createDataFrame([("x", None, None, None)], schema)).first()
    assert (empty["total_producao"], empty["quantidade_por_area"], empty["num_produtos"]) == (0.0, 0.0, 1)


def test_yield_is_null_free_and_never_infinite(spark):
    long = spark.createDataFrame(
        [("a", "Quantidade produzida", 10.0), ("a", "Área plantada", 4.0), ("b", "Quantidade produzida", 1.0),
         ("c", "Quantidade produzida", 1.0), ("c", "Área plantada", 0.0)],
        "produto string, variavel string, valor double",
    )
    assert values(stats.yield_by_product(long)) == [("a", 2.5)]
    assert values(stats.top_by_variable(long, "Quantidade produzida", 1)) == [("a", 10.0)]
    card = stats.long_kpis(long).first()
    assert (card["total_producao"], card["total_area"], card["num_produtos"], card["rendimento_medio"]) == (12.0, 4.0, 3, 3.0)


def test_share_and_ranking(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0), ("c", None)], "p string, v double")
    assert values(stats.share_of_total(df, "p", "v")) == [("a", 3.0, 0.75), ("b", 1.0, 0.25)]
    ranked = stats.value_ranking(df, "p", "v").collect()
    assert [(r["v"], r["maximo"]) for r in ranked] == [(1.0, 2.0), (1.0, 2.0), (2.0, 2.0)]
    assert values(stats.sum_by(df, "p", "v")) == [("a", 3.0), ("b", 1.0)]


def test_change_on_previous(spark):
    df = spark.createDataFrame([(1, 2000, 10.0), (1, 2001, 15.0), (1, 2003, 0.0), (1, 2004, 3.0), (2, 2001, 1.0)],
                               "id_commodity int, ano int, valor_producao_mil_reais double")
    got = values(stats.change_on_previous(df), "id_commodity", "ano", "preco_anterior", "variacao_pct")
    assert got == [(1, 2000, None, None), (1, 2001, 10.0, 50.0), (1, 2003, 15.0, -100.0), (1, 2004, 0.0, None), (2, 2001, None, None)]


def test_trend_line(spark):
    df = spark.createDataFrame([(p, float(x), float(2 * x + 1)) for p, x in zip("abcd", [1, 2, 4, 7])], "p string, x double, y double")
    line = stats.trend_line(df, "p", "x", "y").orderBy("ponto").collect()
    assert len(line) == 100
    assert (line[0]["x"], line[99]["x"]) == (1.0, pytest.approx(7.0))
    assert [r["y"] for r in line] == pytest.approx(list(2 * np.linspace(1, 7, 100) + 1))
    assert stats.trend_line(df.limit(1), "p", "x", "y").count() == 0


def test_box_figures(spark):
    numbers = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", x) for x in numbers] + [(None, 5.0), ("b", None)], "p string, v double")
    got = {r["p"]: r for r in stats.boxplot_stats(df, "p", "v").collect()}
    box = got["a"]
    assert (box["q1"], box["mediana"], box["q3"]) == (2.0, 3.0, 4.0)
    assert (box["haste_inferior"], box["haste_superior"], box["outliers"], box["registros"]) == (1.0, 4.0, 1, 5)
    assert got[None]["outliers"] == 0 and "b" not in got


def test_top_values_break_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None)], "produto string, valor_producao_mil_reais double")
    assert [r[0] for r in reports.top_by_value(df, 2).collect()] == ["a", "b"]


def test_published_top_five(spark):
    facts = spark.createDataFrame(
        [(1, 1, 2024, 260233510.0, 45906902.0), (2, 1, 2024, 8770270.0, 2916018.0), (3, 1, 2024, 2706132.0, 1363415.0),
         (4, 1, 2024, 15264498.0, 617168.0), (5, 1, 2024, 18209944.0, 399820.0), (6, 1, 2024, 1012330.0, 90216.0),
         (1, 1, 2023, 348683454.0, 44417552.0), (1, 1, 2025, None, 99999999.0)],
        "id_commodity int, id_territorio int, ano int, qtd_produzida double, valor_producao_mil_reais double",
    )
    products = spark.createDataFrame(
        list(enumerate(["Soja (em grão)", "Trigo (em grão)", "Sorgo (em grão)", "Cacau (em amêndoa)", "Café (em grão) Canephora", "Erva-mate (folha verde)"], 1)),
        "id_commodity int, nome_oficial string",
    )
    places = spark.createDataFrame([(1, "Brasil")], "id_territorio int, nome string")
    top = [(r["nome_oficial"], r["ano"]) for r in reports.top_latest_year(facts, products, places).collect()]
    assert top == [("Soja (em grão)", 2024), ("Trigo (em grão)", 2024), ("Sorgo (em grão)", 2024),
                   ("Cacau (em amêndoa)", 2024), ("Café (em grão) Canephora", 2024)]
