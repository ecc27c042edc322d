import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark.functions import numbers as num
from cropspark.functions import text as txt


def evaluate(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]


def test_locale_numbers(spark):
    cells = ["1.234,56", " 7 ", "-", "...", "X", "", "  - ", "abc", "12d", "NaN", "Infinity", "1234.5", "-3,5", None, " 8,5 "]
    assert evaluate(spark, cells, num.parse_locale_number) == [
        1234.56, 7.0, None, None, None, None, None, None, None, None, None, 12345.0, -3.5, None, 8.5,
    ]


def test_plain_numbers_keep_the_point(spark):
    assert evaluate(spark, ["1234.5", "1,5", "-"], lambda c: num.parse_locale_number(c, "plain")) == [
        1234.5, None, None,
    ]
    with pytest.raises(ValueError):
        num.parse_locale_number(F.col("x"), "other")


def test_number_coercion_matches_pandas(spark):
    cells = ["1", " 2.5 ", "-3", "+4", ".5", "6.", "1e3", "x", "", "1,5", "--1", "\t9\n"]
    expected = pd.to_numeric(pd.Series(cells), errors="coerce")
    got = evaluate(spark, cells, num.to_number)
    assert [None if math.isnan(e) else e for e in expected] == got


def test_years(spark):
    assert evaluate(spark, ["2023", "2023.0", "2023.5", "n/d", None, " 1999 "], num.to_year) == [
        2023, 2023, None, None, None, 1999,
    ]


def test_years_in_odd_forms(spark):
    cells = ["\t2023\n", "2023\x85", "\xa02023", "+7", "-3 ", "123456789", "2147483647", "2147483648", "2.023e3", "2.0235e3", "2023.", "20 23", "", "+"]
    assert evaluate(spark, cells, num.to_year) == [
        2023, 2023, 2023, 7, -3, 123456789, 2147483647, None, 2023, None, 2023, None, None, None,
    ]


def test_timestamps(spark):
    got = evaluate(spark, ["2024-01-02 03:04:05", "2024-13-02", "x", None], lambda c: num.to_timestamp(c).cast("string"))
    assert got == ["2024-01-02 03:04:05", None, None, None]


def test_rounding_matches_numpy(spark):
    cells = [0.125, 0.375, 1.005, 1.015, 2.675, -0.125, 1e9 + 0.335, 3.0]
    got = evaluate(spark, cells, num.round_half_even, "double")
    assert got == list(np.round(np.array(cells), 2))


def test_title_case_matches_python(spark):
    names = ["Erva-mate (folha verde)", "D'água", "CAFÉ (em grão) Canephora", "nation_0 x3b", "Guaraná (semente)"]
    assert evaluate(spark, names, txt.title_case) == [n.title() for n in names]


def test_strip_matches_python(spark):
    texts = ["  a b ", " a ", " b", "\tc\r\n", "é ", "", " ", "\x1cq", "d　"]
    assert evaluate(spark, texts, txt.strip) == [t.strip() for t in texts]


def test_canonical_names(spark):
    names = [" SOJA (em grão) ", "Cana-de-açúcar", "Azeitona", "erva-mate (folha verde)", None]
    assert evaluate(spark, names, lambda c: txt.canonical_name(c, fv.CANONICAL_NAMES)) == [
        "Soja", "Cana-de-Açúcar", "Azeitona", "Erva-Mate (Folha Verde)", None,
    ]


def test_labels_by_code_and_by_name_may_disagree(spark):
    assert evaluate(spark, ["40125", "99999"], lambda c: txt.lookup_or(c, fv.DASHBOARD_LABELS, F.lit("?"))) == ["Milho", "?"]
    assert evaluate(spark, ["Sorgo (em grão)"], lambda c: txt.canonical_name(c, fv.CANONICAL_NAMES)) == ["Sorgo"]


def test_human_numbers(spark):
    cells = [1_250_000.0, 2_500_000.0, 1500.0, 999.4, -5_000_000.0, 0.5, None]
    assert evaluate(spark, cells, num.card_number, "double") == [
        f"{1.25:.1f}M", "2.5M", "1.5K", "999", "-5000000", f"{0.5:.0f}", None,
    ]
    cells = [1.5e9, -2_500_000.0, 3_500.0, 12.0, -1.25e9]
    assert evaluate(spark, cells, num.axis_number, "double") == [
        "1.5B", f"{-2.5:.0f}M", f"{3.5:.0f}K", "12", f"{-1.25:.1f}B",
    ]


def test_thousands(spark):
    assert evaluate(spark, [1696001.0, None], lambda c: num.thousands(c, 2, "—"), "double") == ["1,696,001.00", "—"]


def test_guarded_division(spark):
    pairs = spark.createDataFrame([(10.0, 2.0), (10.0, 0.0), (10.0, None)], "q double, a double")
    got = pairs.select(
        num.guarded_ratio(F.col("q"), F.col("a")), num.yield_per_area(F.col("q"), F.col("a")),
        num.percent_change(F.col("q"), F.col("a")),
    ).collect()
    assert [tuple(r) for r in got] == [(5.0, 5000.0, 400.0), (0.0, None, None), (0.0, None, None)]


def test_years_and_dates_are_read_as_the_cast_reads_them(spark):
    from cropspark.functions.numbers import to_timestamp, to_year

    df = spark.createDataFrame([("2023.0",), (" 2.023e3",), ("12345678901",), ("2023.5",), ("x",), ("\t2026-03-23",)], "t string")
    assert [r[0] for r in df.select(to_year(F.col("t"))).collect()] == [2023, 2023, None, None, None, None]
    days = spark.createDataFrame([("2026",), ("\t2026-03-23",), ("x",)], "t string").select(to_timestamp(F.col("t")).cast("string"))
    assert [r[0] for r in days.collect()] == ["2026-01-01 00:00:00", "2026-03-23 00:00:00", None]


def test_title_case_by_either_way(spark):
    texts = ["soja EM grão", "NATION_3", "3abc d", "d'água-mel", "a\tb c", "(x) y", "  two  blanks", "ÉTÉ été", "a.b", "", None, "x_1 y", "1 a 2b"]
    def expected(t):
        return None if t is None else re.sub(r"[^\W\d_]+", lambda m: m[0][0].upper() + m[0][1:].lower(), t)

    assert evaluate(spark, texts, txt.title_case) == [expected(t) for t in texts]
