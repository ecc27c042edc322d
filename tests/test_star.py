import pytest
from conftest import values
from pyspark.sql import functions as F

from cropspark.operators import star

BASE = "k int, a int, b int, c int"


def test_numbers_are_consecutive_over_partitions(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 5000).alias("key"))
    got = star.number_rows(rows, ["key"], "n", 10).orderBy("key").collect()
    assert [(r["key"], r["n"]) for r in got] == [(i, 11 + i) for i in range(5000)]


def test_keep_first(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 5, "y")], "k string, o int, v string")
    assert values(star.keep_first(df, ["k"], ["o"])) == [("a", 1, "x"), ("b", 5, "y")]


def test_known_products_keep_their_id_and_values(spark):
    old = spark.createDataFrame([(7, "2", "Dois", "kg")], "id_commodity int, codigo_sidra string, nome_oficial string, unidade_medida string")
    rows = spark.createDataFrame(
        [("3", "Três", None, 1), ("2", "Outro", "t", 2), ("1", "Um", "t", 3), ("1", "Um B", "t", 4), (None, "?", "t", 5)],
        "produto_cod string, produto string, unidade_qtd string, o int",
    )
    loaded = star.load_dim_commodity(old, rows, ["o"])
    assert values(loaded) == [
        (7, "2", "Dois", "kg"), (8, "1", "Um", "t"), (9, "3", "Três", "Toneladas"),
    ]
    assert values(star.load_dim_commodity(loaded, rows, ["o"])) == values(loaded)


def test_one_code_at_two_levels_is_two_places(spark):
    empty = spark.createDataFrame([], "id_territorio int, codigo_ibge string, nome string, nivel_territorial string")
    rows = spark.createDataFrame(
        [("1", "Brasil", "Brasil", 1), ("1", "Outra", "UF", 2), ("1", "Brasil 2", "Brasil", 3)],
        "cod_territorial string, nome_territorial string, nivel_territorial string, o int",
    )
    assert values(star.load_dim_territory(empty, rows, ["o"])) == [(1, "1", "Brasil", "Brasil"), (2, "1", "Outra", "UF")]


def test_fact_rows_are_kept_or_rejected(spark):
    products = spark.createDataFrame([("1", 10)], "codigo_sidra string, id_commodity int")
    places = spark.createDataFrame([("5", "UF", 20)], "codigo_ibge string, nivel_territorial string, id_territorio int")
    rows = spark.createDataFrame(
        [("1", "5", "UF"), ("2", "5", "UF"), ("1", "5", "Brasil"), (None, "5", "UF")],
        "produto_cod string, cod_territorial string, nivel_territorial string",
    )
    resolved = star.resolve_fact_keys(rows, products, places)
    kept = resolved.where(star.has_both_keys())
    assert (resolved.count(), kept.count()) == (4, 1)
    assert values(kept, "id_commodity", "id_territorio") == [(10, 20)]


def test_upsert_changes_only_the_listed_columns(spark):
    base = spark.createDataFrame([(1, 1, 1, 1), (2, 2, 2, 2)], BASE)
    batch = spark.createDataFrame([(2, 20, 20), (3, 30, 30)], "k int, a int, b int")
    once = star.upsert(base, batch, ["k"], ["a"])
    assert values(once) == [(1, 1, 1, 1), (2, 20, 2, 2), (3, 30, 30, None)]
    assert values(star.upsert(once, batch, ["k"], ["a"])) == values(once)


def test_upsert_can_set_null(spark):
    base = spark.createDataFrame([(1, 1, 1, 1)], BASE)
    batch = spark.createDataFrame([(1, None)], "k int, a int")
    assert values(star.upsert(base, batch, ["k"], ["a"])) == [(1, None, 1, 1)]


def test_a_repeated_conflict_key_fails_or_keeps_the_last(spark):
    base = spark.createDataFrame([(1, 1, 1, 1)], BASE)
    batch = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "k int, a int, o int")
    with pytest.raises(Exception, match="conflict key twice"):
        star.upsert(base, batch, ["k"], ["a"]).collect()
    last = star.upsert(base, batch, ["k"], ["a"], on_duplicate="last", order=["o"])
    assert values(last) == [(1, 6, 1, 1)]
    with pytest.raises(ValueError):
        star.unique_batch(batch, ["k"], "last")
    with pytest.raises(ValueError):
        star.unique_batch(batch, ["k"], "other")


def test_a_missing_key_part_neither_merges_nor_multiplies(spark):
    batch = spark.createDataFrame([("1", None, 1.0), ("2", None, 2.0), ("3", "a", 3.0)], "k string, p string, v double")
    base = spark.createDataFrame([], batch.schema)
    once = star.upsert(base, batch, ["k", "p"], ["v"])
    twice = star.upsert(once, batch, ["k", "p"], ["v"])
    assert values(once) == values(twice) == [("3", "a", 3.0)]
    assert values(star.without_key(batch, ["k", "p"])) == [("1", None, 1.0), ("2", None, 2.0)]
