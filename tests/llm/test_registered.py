"""Registered queries without SQL, run over a folder of tables and held against brute force."""

import hashlib
import math
import pathlib
import random
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

import helpers  # noqa: E402
from helpers import awkward, awkward_texts, prose  # noqa: E402
from test_corpus_operators import ctw_score, kt_tree  # noqa: E402
from test_files_and_tokens import encoded, library  # noqa: E402
from test_row_operators import plainly, semi_global  # noqa: E402

from cropspark.llm import decontamination, lm_scoring, queries  # noqa: E402

ITEMS = [prose(500 + i, 12 + 3 * i, lines=False)[: 60 + 21 * i] for i in range(6)] + ["short one", "tiny"]


def short_texts():
    texts = [None, "", " ", "The cat sat. THE cat", "the dog sat on the cat\n", "é ñ"] + [prose(i, 9) for i in range(12)]
    for i in range(18):
        copy, rng = list(ITEMS[i % len(ITEMS)]), random.Random(i)
        for _ in range(i // 6 * 3):
            copy[rng.randrange(len(copy))] = "z"
        texts.append(f"{prose(600 + i, 8)} {''.join(copy)}, {prose(700 + i, 6)}")
    return texts


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Tables of long and awkward texts, and of short ones for the slow definitions."""
    made = {}
    for name, texts in (("long", awkward_texts()), ("short", short_texts())):
        folder = tmp_path_factory.mktemp(name)
        awkward(spark, texts).repartition(3).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([*enumerate(ITEMS), (90, None)], "item_id bigint, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
        made[name] = texts, str(folder)
    return made


def run(spark, name, folder):
    return queries.QUERIES[name](spark, folder).collect()


def test_op1_finds_what_all_alignments_find(spark, folders):
    texts, folder = folders["short"]
    expected = {}
    for j, item in enumerate(ITEMS):
        own = plainly(item).rstrip(b" ")
        budget = min(int(len(own) * decontamination.EDIT_RATE), (len(own) - decontamination.Q) // decontamination.Q) if len(own) >= decontamination.Q else -1
        for i, text in enumerate(texts):
            edits = semi_global(own, plainly(text or ""))
            if edits <= budget:
                expected[i, j] = edits
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in run(spark, "op1_benchmark_decontamination", folder)}
    assert found == expected and len(expected) >= 8


def test_op4_gives_the_ids_of_the_library(spark, folders):
    texts, folder = folders["long"]
    known, _ = library()
    found = {r["doc_id"]: r for r in run(spark, "op4_sentencepiece", folder)}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        expected = known.encode(text or "")
        assert (found[i]["ids"], found[i]["n_tokens"], found[i]["round_trip"]) == (expected, len(expected), True)


def test_op5_places_and_sums_all_ids(spark, folders):
    texts, folder = folders["long"]
    expected, start = [], 0
    for i, ids in enumerate(encoded(texts, 2)):
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = queries.QUERIES["op5_token_output"](spark, folder)
    assert sorted(map(tuple, found.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == expected


def test_op8_removes_what_brute_force_removes(spark, folders):
    texts, folder = folders["long"]
    found = {r["doc_id"]: r for r in run(spark, "op8_suffix_array_dedup", folder)}
    for i, (size, removed, spans, kept) in enumerate(helpers.repeats(texts)):
        own = found[i]
        assert (own["n_bytes"], own["n_removed"], own["n_spans"]) == (size, removed, spans)
        assert own["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_op9_scores_as_defined(spark, folders):
    texts, folder = folders["short"]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    data = [(t or "").encode() for t in texts]
    tree, memory = kt_tree([d for d, h in zip(data, held) if not h], lm_scoring.DEPTH), {}
    words = [helpers.WORD.findall((t or "").translate(helpers.LOWER)) + [None] for t in texts]
    trained = [w for ws, h in zip(words, held) if not h for w in ws]
    known, below = set(trained), math.log10(len(trained) + len(set(trained)) + 1)
    found = {r["doc_id"]: r for r in run(spark, "op9_lm_scoring", folder)}
    assert any(held) and len(found) == len(texts)
    for i, ws in enumerate(words):
        own = found[i]
        assert (own["held_out"], own["n_tokens"], own["train_tokens"]) == (held[i], len(ws), len(trained))
        assert own["n_known"] == sum(w in known for w in ws)
        assert own["base_score"] == pytest.approx(sum(math.log10(trained.count(w) + 1) - below for w in ws), abs=1e-9)
        assert own["score"] == pytest.approx(ctw_score(data[i], tree, lm_scoring.DEPTH, memory), abs=1e-6)


def test_op10_counts_every_document(spark, folders):
    texts, folder = folders["long"]
    found = sorted(map(tuple, run(spark, "op10_token_counts", folder)))
    sizes = sorted(len(ids) - 1 for ids in encoded(texts, 2))
    assert sorted(r[2] for r in found) == sizes and [r[0] for r in found] == list(range(len(texts)))
    starts = np.cumsum([0, *[r[2] + 1 for r in found]])
    assert [r[1] for r in found] == starts[:-1].tolist() and all(r[3] for r in found)
