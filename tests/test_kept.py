"""Counts in flight, answers from footers, kept aggregates, references in one pass."""

import bisect
import pathlib
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark.operators import kept, observed, quality, rows
from cropspark.plans import queries
from cropspark.sources import footers, lake

SMALL = "/root/testdata/sf0.001"


def typed_rows(spark, n=500):
    rng = random.Random(2)
    number = lambda: rng.choice([None, -1.0, 0.0, 5.5])
    data = [(rng.choice([None, 1900, 2000, 2020]), rng.choice(["1", "x", None, "22"]), *[number() for _ in fv.METRICS]) for _ in range(n)]
    return spark.createDataFrame(data, "ano int, produto_cod string, " + ", ".join(f"{m} double" for m in fv.METRICS))


def test_validation_is_counted_by_the_job_that_writes(spark, tmp_path):
    typed_rows(spark).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    plans = []

    def write(valid):
        plans.append(valid._jdf.queryExecution().executedPlan().toString())
        valid.write.parquet(str(tmp_path / "out"))

    report = observed.write_validated(df, write)
    assert values(report) == values(rows.validation_report(df))
    assert plans[0].count("FileScan") == 1 and "CollectMetrics" in plans[0]
    assert values(spark.read.parquet(str(tmp_path / "out"))) == values(rows.validate_rows(df))
    assert dict(observed.write_validated(df.where("false"), lambda d: d.write.parquet(str(tmp_path / "none"))).collect())["total"] == 0


def test_fact_load_reports_loaded_and_skipped(spark, tmp_path):
    products = spark.createDataFrame([("1", 10)], "codigo_sidra string, id_commodity int")
    places = spark.createDataFrame([("5", "UF", 20)], "codigo_ibge string, nivel_territorial string, id_territorio int")
    data = spark.createDataFrame(
        [("1", "5", "UF"), ("2", "5", "UF"), ("1", "5", "Brasil"), (None, None, "UF")], "produto_cod string, cod_territorial string, nivel_territorial string"
    )
    report = observed.write_fact(data, products, places, lambda d: d.write.parquet(str(tmp_path / "fact")))
    assert dict(report.collect()) == {"carregadas": 1, "ignoradas": 3, "sem produto": 2, "sem território": 2, "lidas": 4}
    assert spark.read.parquet(str(tmp_path / "fact")).count() == 1


def test_whole_columns_are_answered_by_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") % 7 + 2000).cast("int").alias("ano"), F.col("id").cast("string").alias("s")).write.parquet(path)
    total = footers.aggregate(spark, path, {"n": F.count(F.lit(1)), "m": F.max("ano")})
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MAX(ano)]" in plan and tuple(total.first()) == (1000, 2006)
    some = footers.aggregate(spark, path, {"m": F.max("ano")}, where=F.col("ano") < 2003)
    assert "PushedAggregation: []" in some._jdf.queryExecution().executedPlan().toString() and some.first()["m"] == 2002
    assert footers.aggregate(spark, path, {"m": F.max("s")}).first()["m"] == "999"
    assert footers.latest(spark, path) == 2006 and dict(footers.table_counts(spark, {"a": path, "b": path}).collect()) == {"a": 1000, "b": 1000}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def batches(spark):
    rng = random.Random(3)
    row = lambda y: (y, rng.choice("abc") if rng.random() > 0.1 else None, None if rng.random() < 0.1 else rng.gauss(1e6, 3.0))
    return [spark.createDataFrame([row(rng.choice(years)) for _ in range(3000)], "ano int, k string, v double") for years in ([2000, 2001, 2002], [2002, 2003])]


def test_kept_state_equals_recomputing_and_reads_touched_years_only(spark, tmp_path):
    table, path, sketches = (str(tmp_path / x) for x in ("table", "kept", "sketches"))
    first, second = batches(spark)
    for i, batch in enumerate((first, second)):
        lake.write_lake(batch, table, ["ano"], touched_only=True)
        if i:  # an untouched year can't even be read
            saved = {f: f.read_bytes() for f in pathlib.Path(table).glob("ano=2000/*.parquet")}
            for f in saved:
                f.write_bytes(b"broken")
        years = kept.refresh(spark, path, lake.read_lake(spark, table, batch.schema), batch, ["k"], kept.moments("v"))
        kept.refresh(spark, sketches, lake.read_lake(spark, table, batch.schema), batch, ["k"], kept.sketch("v"))
        assert years == ([2002, 2003] if i else [2000, 2001, 2002])
    for f, content in saved.items():
        f.write_bytes(content)
    full = lake.read_lake(spark, table)
    assert full.count() == first.where("ano < 2002").count() + second.count()
    for by in (["k"], ["ano"], ["ano", "k"], []):
        expected = full.groupBy(*by).agg(
            F.count("v").alias("n"), F.sum("v").alias("soma"), F.avg("v").alias("media"), F.stddev_samp("v").alias("desvio_padrao"), F.min("v").alias("minimo"), F.max("v").alias("maximo")
        )
        got = values(kept.merged_moments(kept.read(spark, path), by))
        for a, b in zip(got, values(expected)):
            assert a[: len(by) + 1] == b[: len(by) + 1] and a[len(by) + 1 :] == pytest.approx(b[len(by) + 1 :], rel=1e-9)


def test_merged_sketches_keep_their_rank_error(spark, tmp_path):
    table, path = str(tmp_path / "table"), str(tmp_path / "kept")
    df = spark.range(200_000).select((F.col("id") % 5 + 2000).cast("int").alias("ano"), (F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    odd = spark.createDataFrame([(2000, None), (2001, float("nan"))], "ano int, v double")
    lake.write_lake(df.union(odd), table, ["ano"])
    kept.refresh(spark, path, lake.read_lake(spark, table), df, [], kept.sketch("v"))
    probs = {f"p{i}": i / 20 for i in range(1, 20)}
    found = kept.merged_quantiles(kept.read(spark, path), probs).first()
    ordered = sorted(r["v"] for r in df.collect())
    for name, p in probs.items():
        assert abs(bisect.bisect(ordered, found[name]) / len(ordered) - p) <= kept.RANK_ERROR


def test_bitmaps_count_distinct_codes_exactly(spark, tmp_path):
    rng = random.Random(4)
    data = [(rng.choice([2000, 2001]), f"c{rng.randrange(90_000)}" if rng.random() > 0.01 else None) for _ in range(120_000)]
    df = spark.createDataFrame(data, "ano int, c string")
    early = df.where("ano = 2000")
    known = kept.numbered(early, None, "c")
    numbers = kept.numbered(df, known, "c")
    assert numbers.count() == numbers.select("numero").distinct().count() == df.select("c").distinct().count() - 1
    assert numbers.join(known, ["c", "numero"]).count() == known.count()
    path = str(tmp_path / "kept")
    for part in (early, df.where("ano = 2001")):
        kept.refresh(spark, path, part.join(numbers, "c"), part, [kept.bit_bucket("numero")], kept.bits("numero"))
    state = kept.read(spark, path)
    exact = df.groupBy("ano").agg(F.count_distinct("c").alias("distintos"))
    assert values(kept.merged_distinct(state, ["ano"])) == values(exact)
    assert kept.merged_distinct(state).first()["distintos"] == df.agg(F.count_distinct("c")).first()[0] > 32768


def test_all_references_share_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, 5, "a"), (2, 6, "b"), (3, None, None), (3, 7, "z")], "k int, l bigint, s string").write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    dims = {
        "k": ("k", spark.createDataFrame([(1,), (2,)], "d bigint"), "d"),
        "k with null": ("k", spark.createDataFrame([(1,), (None,)], "d int"), "d"),
        "l": ("l", spark.createDataFrame([(5,)], "d int"), "d"),
        "s": ("s", spark.createDataFrame([("a",), ("b",)], "d string"), "d"),
        "empty": ("l", spark.createDataFrame([], "d int"), "d"),
        "k as double": ("k", spark.createDataFrame([(1.0,), (3.0,)], "d double"), "d"),
    }
    report = quality.orphan_counts(fact, dims)
    expected = {name: quality.count_orphans(fact, key, dim, d).first()[0] for name, (key, dim, d) in dims.items()}
    assert dict(report.collect()) == expected == {"k": 2, "k with null": 0, "l": 2, "s": 1, "empty": 4, "k as double": 1}
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation [k#") == 1
    assert dict(quality.orphan_counts(fact.where("false"), dims).collect()) == dict.fromkeys(dims, 0)


@pytest.mark.skipif(not pathlib.Path(SMALL).exists(), reason="no test tables")
def test_manifest_and_size_report_hold_the_sizes_of_the_files(spark, monkeypatch):
    from cropspark.plans import files

    roots = []
    before = files.scratch_path
    monkeypatch.setattr(files, "scratch_path", lambda s, label: roots.append(before(s, label)) or roots[-1])
    manifest = {r["formato"]: r for r in queries()["snapshot_manifest"](spark, SMALL).collect()}
    root = pathlib.Path(next(r for r in roots if "/raw-" in r))
    sizes = {f: sum(p.stat().st_size for p in root.glob(f"{f}/*/part-*")) for f in ("csv", "json", "parquet")}
    assert {f: r["tamanho_bytes"] for f, r in manifest.items()} == sizes and all(r["kb_confere"] and r["nome"].endswith(f) for f, r in manifest.items())
    roots.clear()
    report = {r["formato"]: r for r in queries()["format_size_report"](spark, SMALL).collect()}
    root = pathlib.Path(next(r for r in roots if "/raw-" in r))
    sizes = {f: sum(p.stat().st_size for p in root.glob(f"{f}/*/part-*")) for f in ("csv", "json", "parquet")}
    assert {f: (r["tamanho_bytes"], r["pct_do_csv"]) for f, r in report.items()} == {f: (n, pytest.approx(n * 100 / sizes["csv"], abs=0.051)) for f, n in sizes.items()}
