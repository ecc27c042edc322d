"""Records found inside blocks: arrays and CSV files that are cut anywhere."""

import csv
import io
import json
import random

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropspark.sources import payload as src
from cropspark.sources import pieces
from cropspark.sources import snapshots as snap

HEADER = {k: "header" for k in "D1C D1N D2C D2N D3C D3N D4C D4N MC MN NC NN V".split()}
AT = "2024-01-01 00:00:00"
ODD = ["", "}", "{", "a}b{c", '"', '\\', '\\"}', "[", "]", "},{", "é ñ 漢", "\n", "\r\n", "]}", '{"x": [1]}', "x" * 40]


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few hundred bytes, so that borders fall everywhere."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def objects(n, seed=1):
    rng = random.Random(seed)
    return [{"id": i, "V": "".join(rng.choice(ODD) for _ in range(rng.randrange(4)))} for i in range(n)]


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8", newline="")


def test_array_elements_in_blocks(spark, tmp_path, small_blocks):
    nested = [{"a": {"b": [{"c": "}"}, {}]}, "d": []}, {}, {"e": "]"}]
    documents = {
        "compact.json": json.dumps(objects(400), separators=(",", ":")),
        "indented.json": "﻿\n " + json.dumps(objects(200, 2), indent=3, ensure_ascii=False) + "\n\n",
        "nested.json": json.dumps(nested * 50),
        "empty.json": " [ ]\n",
    }
    for name, text in documents.items():
        write(tmp_path / "in", name, text)
    records, files = pieces.json_array_records(spark, str(tmp_path / "in"))
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "in")).rdd.getNumPartitions() > 20
    found = {}
    for r in records.orderBy("file", "number").collect():
        found.setdefault(r["file"].rsplit("/", 1)[-1], []).append(json.loads(r["record"]))
    assert found == {n: json.loads(t.lstrip("﻿")) for n, t in documents.items() if json.loads(t.lstrip("﻿"))}
    assert all(r["whole"] for r in files.collect()) and files.count() == 4


def test_what_is_no_array_is_refused(spark, tmp_path, small_blocks):
    whole = json.dumps(objects(30))
    bad = {
        "cut.json": whole[:-40], "cut_at_brace.json": whole[: whole.rindex("}") + 1], "open.json": whole[:-1], "object.json": '{"a": [{}]}',
        "text.json": "not json", "twice.json": whole + whole, "quote.json": whole[:-1] + '"]', "tail.json": whole[:-1] + ", 5]", "bracket.json": "[" + whole,
    }
    for name, text in bad.items():
        write(tmp_path / "in", name, text)
    write(tmp_path / "in", "good.json", whole)
    cells, files = src.read_arrays(spark, str(tmp_path / "in"))
    assert {r["url_origem"].rsplit("/", 1)[-1] for r in files.where("aceito").collect()} == {"good.json"}
    assert files.count() == len(bad) + 1 and cells.count() == 30


def cell(i, value="1.234,5"):
    return {"D1C": str(i), "D1N": f"P{i}", "D2C": "214", "D3N": "2023", "D4C": "40124", "D4N": "So}ja", "MN": "t", "NN": "UF", "V": value}


def test_large_documents_give_what_small_ones_give(spark, tmp_path, small_blocks):
    document = [HEADER, *[cell(i) for i in range(300)], {"V": "X"}]
    refused = [json.dumps([HEADER, cell(1)])[:-3], json.dumps([HEADER, 5, cell(1)]), json.dumps([HEADER, cell(1)]).replace("214", '214", oops')]
    write(tmp_path / "in", "a.json", json.dumps(document, indent=1))
    for i, text in enumerate(refused):
        write(tmp_path / "in", f"b{i}.json", text)
    cells, files = src.landed_cells(spark, str(tmp_path / "in"), AT)
    small = spark.createDataFrame([(json.dumps(document), "x")] + [(t, "y") for t in refused], "payload string, url_origem string")
    expected = src.payload_to_cells(small, AT)
    shown = [c for c in expected.columns if c != "url_origem"]
    assert values(cells, *shown) == values(expected, *shown) and cells.count() == 301
    accepted = {r["url_origem"].rsplit("/", 1)[-1]: r["aceito"] for r in files.collect()}
    assert accepted == {"a.json": True, "b0.json": False, "b1.json": False, "b2.json": False}
    wide = src.collect_cells(src.union_blocks([cells, cells.limit(0)]))
    assert wide.count() == 300 and wide.first()["area_colhida_ha"] == 1234.5


def test_documents_are_written_as_arrays(spark, tmp_path):
    rows = [("d1", i, json.dumps(cell(i))) for i in range(50)] + [("d2", 1, json.dumps(cell(7)))]
    df = spark.createDataFrame(rows, "doc string, n int, j string").repartition(5)
    src.write_arrays(df, str(tmp_path / "out"), "doc", ["n"], "j", F.lit(json.dumps(HEADER)))
    files = sorted((tmp_path / "out").glob("doc=*/part-*"))
    assert [json.loads(f.read_text()) for f in files] == [[HEADER, *[cell(i) for i in range(50)]], [HEADER, cell(7)]]
    cells, accepted = src.landed_cells(spark, str(tmp_path / "out"), AT)
    assert values(cells, "posicao", "cod_territorial") == sorted([(i + 1, str(i)) for i in range(50)] + [(1, "7")], key=lambda r: [(False, str(v)) for v in r])
    assert accepted.where("aceito").count() == 2


TEXTS = T.StructType([T.StructField(c, T.StringType()) for c in "abc"] + [T.StructField("n", T.IntegerType())])


def odd_rows(n):
    rng = random.Random(5)
    parts = ["x", " ", '"', ",", "\n", "\r\n", "\r", "é", "'", "\\", '""', "\\n", ";"]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(6))) or None
    return [(text(), text(), f"k{i}", i if i % 7 else None) for i in range(n)]


def test_csv_round_trip_keeps_breaks_quotes_and_blanks(spark, tmp_path, small_blocks):
    rows = odd_rows(400)
    df = spark.createDataFrame(rows, TEXTS)
    for single in (False, True):
        path = str(tmp_path / f"csv{single}")
        snap.write_csv(df, path, order=["a", "b", "c", "n"], single_file=single)
        assert pieces.has_quoted_breaks(spark, path)
        back = snap.read_csv(spark, path, TEXTS)
        assert back.schema == TEXTS and sorted(map(tuple, back.collect()), key=lambda r: r[2]) == sorted(rows, key=lambda r: r[2])


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_foreign_csv_files(spark, tmp_path, small_blocks, ending):
    rows = odd_rows(200)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=ending)
    writer.writerow(["a", "b\nof two lines", "c", "n"])
    writer.writerows([["" if v is None else v for v in r] for r in rows])
    write(tmp_path / "in", "x.csv", "﻿" + out.getvalue() + ending + ending)
    write(tmp_path / "in", "y.csv", "a,b,c,n" + ending + f'p,"q{ending}r",s,bad' + ending + "t")
    back = sorted(map(tuple, snap.read_csv(spark, str(tmp_path / "in"), TEXTS).collect()), key=lambda r: str(r[2]))
    assert back == sorted([*rows, ("p", f"q{ending}r", "s", None), ("t", None, None, None)], key=lambda r: str(r[2]))


def test_files_of_plain_lines_are_read_as_such(spark, tmp_path):
    write(tmp_path / "in", "x.csv", 'a,b,c,n\n"1, 2"," s ",k,3\n')
    path = str(tmp_path / "in")
    assert not pieces.has_quoted_breaks(spark, path)
    assert snap.read_csv(spark, path, TEXTS).collect() == [("1, 2", " s ", "k", 3)]
