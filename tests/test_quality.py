import pytest
from conftest import values
from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark.operators import quality

SCHEMA = ", ".join(f"{m} double" for m in fv.METRICS)


def test_zero_is_a_category_null_is_valid_first_match_wins(spark):
    df = spark.createDataFrame(
        [(0.0, -1.0, 1.0, 1.0), (1.0, 0.0, 1.0, 1.0), (None, None, None, None), (1.0, 1.0, 1.0, 1.0)], SCHEMA
    )
    assert values(quality.anomaly_summary(df)) == [
        ("DADOS VÁLIDOS", 2, 50.0), ("PRODUÇÃO INVÁLIDA", 1, 25.0), ("ÁREA INVÁLIDA", 1, 25.0),
    ]


def test_percent_rounds_half_up(spark):
    # 1 of 800 is 0.125 percent
    df = spark.range(800).select(*[F.when(F.col("id") == 0, -1.0).otherwise(1.0).alias(m) for m in fv.METRICS])
    assert {r[0]: r[2] for r in quality.anomaly_summary(df).collect()} == {
        "ÁREA INVÁLIDA": 0.13, "DADOS VÁLIDOS": 99.88,
    }


def test_anomalous_rows(spark):
    df = spark.createDataFrame([(-1.0, 1.0), (1.0, -1.0), (1.0, 101.0), (0.0, 5.0), (1.0, 1.0), (None, 5.0)],
                               "area_colhida_ha double, qtd_produzida double")
    assert quality.anomaly_rows(df).count() == 3


def test_iqr_outliers(spark):
    df = spark.createDataFrame([("p%d" % i, float(i)) for i in range(20)] + [("far", 1000.0)], "p string, m double")
    assert values(quality.outliers_iqr(df, "p", ["m"])) == [("far", 1000.0, "m")]


def test_percentile_flags_keep_every_row(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(100)] + [("b", None), (None, 1.0)], "g string, v double")
    flagged = quality.flag_above_percentile(df, "g", "v")
    assert flagged.count() == 102
    assert values(flagged.where("acima_p95"), "v") == [(95.0,), (96.0,), (97.0,), (98.0,), (99.0,)]


@pytest.mark.parametrize("dim", [[1, 2], [1, None], [], [1, 1, 2], [None]])
def test_orphans_follow_not_in(spark, dim):
    fact = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "k int")
    known = spark.createDataFrame([(d,) for d in dim], "d int")
    fact.createOrReplaceTempView("fact_k")
    known.createOrReplaceTempView("dim_k")
    expected = spark.sql("SELECT count(*) FROM fact_k WHERE k NOT IN (SELECT d FROM dim_k)").first()[0]
    assert quality.count_orphans(fact, "k", known, "d").first()[0] == expected


def test_constraints(spark):
    df = spark.createDataFrame([(1, "ab", 1973), (1, None, 2000), (2, "abcdef", None), (None, "x", 2000), (None, "x", 2000)],
                               "id int, t string, ano int")
    dim = spark.createDataFrame([(1,)], "id int")
    report = quality.constraint_report(
        "t", df, not_null=["t"], checks={"ano": F.col("ano").between(1974, 2100)}, lengths={"t": 5},
        unique=[["id"]], references={"fk": ("id", dim, "id")},
    )
    assert {r["restricao"]: r["violacoes"] for r in report.collect()} == {
        "t não nulo": 1, "ano": 1, "t até 5 caracteres": 1, "id único": 1, "fk": 1,
    }
