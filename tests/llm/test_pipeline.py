"""The pipeline and the registered queries over the small test tables."""

import pathlib
import sys

import public_tokenizers
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent.parent / "tools"))

import compare_sql  # noqa: E402
import helpers  # noqa: E402
from test_row_operators import edits, without_repeats  # noqa: E402

import corpus_pipeline  # noqa: E402
from cropspark.llm import quality_rules, queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no test tables")


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    result = df.columns, [tuple(r) for r in df.collect()]
    sql = compare_sql.run_sql(compare_sql.database(FOLDER), queries.ORACLES[name])
    assert compare_sql.compare(result, sql[:2]) is None


def test_pipeline_matches_brute_force(spark):
    docs = sorted(map(tuple, spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()))
    items = [helpers.WORD.sub(lambda m: m[0], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in quality_rules.judge(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect() if r["kept"]}
    docs = [(i, t) for i, t in docs if i in kept]
    done = without_repeats([t for _, t in docs])
    left = [(i, text) for (i, _), (text, n_gone, n_lines) in zip(docs, done) if n_gone < n_lines]
    groups = helpers.near_duplicates([t for _, t in left])
    left = [x for x, (_, _, _, first) in zip(left, groups) if first]

    def plain(text):
        shown = "".join(c.lower() if c.isascii() and c.isalnum() else c if not c.isascii() else " " for c in text)
        return " ".join(shown.split(" ")) if "  " not in shown else " ".join(x for x in shown.split(" ") if x)

    found = [t for t in map(plain, items)]
    left = [(i, t) for i, t in left if not any(item in plain(t) for item in found)]
    import sentencepiece

    known = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = {i: (t, known.encode(t)) for i, t in left}
    result = {r["doc_id"]: (r["text"], r["ids"]) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert result == expected and edits("ab", "ac") == 1


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][:2] == ["quality rules", "line dedup"] and len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
