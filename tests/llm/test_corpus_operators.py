"""Operators over the whole corpus: near-duplicates, repeats, language model."""

import collections
import hashlib
import itertools
import math
import pathlib
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

import helpers  # noqa: E402
from helpers import awkward, awkward_texts, edited, prose, rows  # noqa: E402

from cropspark.llm import components, lm_scoring, minhash_near_dedup, suffix_array_dedup  # noqa: E402
from cropspark.session import shared_folder  # noqa: E402


def test_components_of_a_chain_a_hub_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (None, 3), (101, 100)]
    found = rows(components.components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b"), "node", "component")
    assert found == sorted([(i, 1) for i in range(1, 31)] + [(100 + i, 100) for i in range(20)], key=repr)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_near_duplicates_match_brute_force(spark):
    base = prose(9, 150)
    # a group whose members differ from each other more than from their original, and outsiders
    texts = awkward_texts() + [base] + [edited(base, i, 0.015) for i in range(25)] + [edited(base, 50 + i, 0.08) for i in range(25)]
    found = minhash_near_dedup.near_duplicates(awkward(spark, texts))
    assert sorted(tuple(r) for r in found.collect()) == helpers.near_duplicates(texts)


def test_near_duplicates_keep_rows_and_columns(spark):
    text = prose(1, 40)
    docs = spark.createDataFrame([(5, text, "x"), (5, text, "y"), (None, text, "z"), (7, text, "u"), (8, None, "v")], "doc_id bigint, text string, node string")
    kept = minhash_near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["node"] for r in kept.collect()) == ["v", "x", "y", "z"]
    assert minhash_near_dedup.near_duplicates(awkward(spark, [])).count() == 0


@pytest.mark.parametrize("options", [{}, {"group": 2}, {"sent_hashes": 0}])
def test_repeats_match_brute_force(spark, options):
    passage = prose(77, 90, lines=False)
    texts = awkward_texts() + [prose(80 + i, 30) + passage + prose(90 + i, 30) for i in range(8)] + [passage[i:] for i in range(0, 200, 40)]
    found = {r["doc_id"]: r for r in suffix_array_dedup.remove_repeats(awkward(spark, texts), **options).collect()}
    for i, (size, removed, spans, kept) in enumerate(helpers.repeats(texts)):
        own = found[i]
        assert (own["n_bytes"], own["n_removed"], own["n_spans"], bytes(own["kept"])) == (size, removed, spans, kept), i
        assert own["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_intervals_of_a_suffix_array():
    words = sorted(["banana"[i:] for i in range(6)])
    common = [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in itertools.pairwise(words)]
    found = suffix_array_dedup.intervals(common, 1)
    assert {(d, a, b) for d, a, b, _ in found} == {(3, 1, 2), (1, 0, 2), (2, 4, 5)}
    inner = next(x for x in found if x[0] == 3)
    assert found[inner[3]][:3] == (1, 0, 2)


def test_trees_name_all_occurrences(spark):
    passage = prose(33, 120, lines=False)
    texts = [prose(i, 40) + " " + passage + " " + prose(50 + i, 40) for i in range(5)]
    tree, _, places = suffix_array_dedup.trees(awkward(spark, texts))
    nodes = tree.filter("depth + extent >= 400").agg({"members": "max"}).first()[0]
    assert nodes == 5 and places.select("t").distinct().count() == 5


def test_places_have_one_number_in_tasks_and_in_spark(spark):
    digests = [hashlib.md5(b"%d" % i).digest() for i in range(50)]
    owner, at = np.arange(50).repeat(2), np.arange(100) * 7919
    own = suffix_array_dedup._place_keys(digests, owner, at)
    places = spark.createDataFrame([(bytes(digests[o]), int(a)) for o, a in zip(owner, at)], "t binary, at bigint")
    assert sorted(r[0] for r in places.select(suffix_array_dedup._place_key()).collect()) == sorted(own.tolist()) and min(own) < 0


def test_large_groups_are_read_once_to_be_split(spark):
    rows = [(1, b"c%d" % i, b"l" * i, b"r" * (400 - i), False, 0, 336) for i in range(0, 337, 48)]
    groups = spark.createDataFrame(rows, "key bigint, c binary, before binary, after binary, many boolean, low int, high int")
    parts = suffix_array_dedup._split(groups)
    assert parts._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    middle = (0 + 336 + 1) // 2
    expected = {(bytes(c), middle, 336) for _, c, b, _, *_ in rows if len(b) >= middle}
    expected |= {(bytes(c), 0, middle - 1) for _, c, _, a, *_ in rows if len(a) >= 401 - middle}
    assert {(bytes(r["c"]), r["low"], r["high"]) for r in parts.collect()} == expected and len(expected) > len(rows) / 2


def kt_tree(trained, depth):
    """Counts of each node below each context, straight from the definition."""
    counts = collections.Counter()
    for data in trained:
        for i, byte in enumerate(data):
            context = bytes(data[i - k] if i >= k else 0 for k in range(1, depth + 1))
            for bit in range(8):
                node, one = (256 + byte) >> (8 - bit), byte >> (7 - bit) & 1
                for d in range(depth + 1):
                    counts[context[:d], node, one] += 1
    return counts


def ctw_score(data, counts, depth, memory):
    def estimate(context, node):
        a, b = counts[context, node, 0], counts[context, node, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    contexts = {(c, n) for c, n, _ in list(counts)}
    children = collections.defaultdict(set)
    for c, n in contexts:
        if c:
            children[c[:-1], n].add(c)

    def weighted(context, node):
        if (context, node) not in memory:
            e = estimate(context, node)
            if len(context) < depth:
                below = sum(weighted(c, node) for c in children[context, node])
                e = math.log(0.5) + max(e, below) + math.log1p(math.exp(-abs(e - below)))
            memory[context, node] = e
        return memory[context, node]

    def probability(context, node, one, d):
        a, b = counts[context[:d], node, 0], counts[context[:d], node, 1]
        own = ((b if one else a) + 0.5) / (a + b + 1)
        if d == depth:
            return own
        share = 0.5 if a + b == 0 else math.exp(math.log(0.5) + estimate(context[:d], node) - weighted(context[:d], node))
        return share * own + (1 - share) * probability(context, node, one, d + 1)

    total = 0.0
    for i, byte in enumerate(data):
        context = bytes(data[i - k] if i >= k else 0 for k in range(1, depth + 1))
        for bit in range(8):
            total += math.log10(probability(context, (256 + byte) >> (8 - bit), byte >> (7 - bit) & 1, 0))
    return total


@pytest.mark.parametrize("cached", [lm_scoring.CACHED, 40, 0])
def test_scores_match_the_definition(spark, cached):
    texts = [None, "", "The cat sat. THE cat", "the dog sat on the cat\n", "é ñ", prose(1, 30), prose(2, 12), prose(1, 30)] + [prose(i, 8) for i in range(10, 22)]
    found = {r["doc_id"]: r for r in lm_scoring.score(awkward(spark, texts), cached=cached).collect()}
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    assert any(held) and len(found) == len(texts)
    data = [(t or "").encode() for t in texts]
    tree, memory = kt_tree([d for d, h in zip(data, held) if not h], lm_scoring.DEPTH), {}
    tokens = [helpers.WORD.findall((t or "").translate(helpers.LOWER)) + [None] for t in texts]
    counts = collections.Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in enumerate(tokens):
        own = found[i]
        assert own["held_out"] == held[i] and own["n_tokens"] == len(ws) and own["train_tokens"] == n
        assert own["n_known"] == sum(counts[w] > 0 for w in ws)
        assert own["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), abs=1e-9)
        assert own["score"] == pytest.approx(ctw_score(data[i], tree, lm_scoring.DEPTH, memory), abs=1e-6)


def test_code_lengths_beat_the_words(spark):
    folder = "/root/testdata/sf0.01"
    if not pathlib.Path(folder).exists():
        pytest.skip("no test tables")
    found = lm_scoring.score(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    for r in found[:50]:
        assert r["bits_per_byte"] == pytest.approx(-r["score"] * math.log2(10) / r["n_bytes"])
    held = [r for r in found if r["held_out"]]
    size = sum(r["n_bytes"] for r in held)
    tree, words = (-sum(r[c] for r in held) * math.log2(10) / size for c in ("score", "base_score"))
    assert tree < words and words == pytest.approx(2.15, abs=0.01)


def test_code_length_of_no_bytes(spark):
    found = {r["doc_id"]: (r["n_bytes"], r["bits_per_byte"] is None) for r in lm_scoring.score(awkward(spark, [None, "", "é"])).collect()}
    assert found == {0: (0, True), 1: (0, True), 2: (2, False)}


def test_scores_without_training_rows(spark):
    assert lm_scoring.score(awkward(spark, [])).count() == 0


def test_scores_do_not_depend_on_slices_parts_and_ranges(spark, monkeypatch):
    texts = [None, "", "a", "é ñ", prose(1, 30), prose(2, 12), prose(1, 30)] + [prose(i, 40) for i in range(10, 40)]
    whole = {r["doc_id"]: r["score"] for r in lm_scoring.score(awkward(spark, texts)).collect()}
    for name, value in (("COUNT_SLICE_BYTES", 500), ("LEAST_PART_BYTES", 900), ("PART_BYTES", 900), ("RANGE_GRAMS", 100)):
        monkeypatch.setattr(lm_scoring, name, value)
    cut = {r["doc_id"]: r["score"] for r in lm_scoring.score(awkward(spark, texts)).collect()}
    assert cut == pytest.approx(whole, abs=1e-9) and len(cut) == len(texts)


def test_scoring_writes_no_more_than_a_few_times_the_text(spark):
    texts = [prose(i, 400) for i in range(100, 400)]
    folder = pathlib.Path(shared_folder(spark))
    before = {p for p in folder.rglob("*.parquet") if p.is_file()}
    lm_scoring.score(awkward(spark, texts)).collect()
    written = sum(p.stat().st_size for p in folder.rglob("*.parquet") if p.is_file() and p not in before)
    assert written < 2 * sum(len(t.encode()) for t in texts)


def test_scoring_leaves_no_shuffled_grams(spark):
    texts = [prose(i, 400) for i in range(100, 300)]
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def held():
        return sum(p.stat().st_size for folder in folders for p in pathlib.Path(folder.getPath()).rglob("shuffle_*.data"))

    before, setting = held(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting)
    lm_scoring.score(awkward(spark, texts))
    assert held() - before < sum(len(t.encode()) for t in texts) / 4
    assert spark.conf.get(setting) == was


def test_grams_are_the_same_with_and_without_packed_keys(monkeypatch):
    data = [b"", b"a", prose(1, 200).encode(), bytes(range(256)) * 3, b"ab" * 500, prose(1, 200).encode()]
    part = lm_scoring.Texts(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]), 0)
    held_out = np.array([0, 0, 1, 0, 1, 0])
    expected = collections.Counter()
    for text, own in enumerate(data):
        for i, byte in enumerate(own):
            expected[int.from_bytes((bytes(8) + own)[i : i + 8], "little"), byte, text] += 1
    for bits, table in ((64, 1 << 24), (20, 100)):
        monkeypatch.setattr(lm_scoring, "KEY_BITS", bits)
        monkeypatch.setattr(lm_scoring, "TABLE", table)
        found, counts = collections.Counter(), collections.Counter()
        for turn in range(lm_scoring.ROUNDS):
            whole = lm_scoring.Slice(part)
            for _, (context, grams, byte, trained, held, step) in lm_scoring.gram_blocks(whole, held_out, 3, turn, True):
                assert (np.diff(context.astype(object)) > 0).all()
                seen, at = trained.astype(int) + held, 0
                for c, b, n, h in zip(np.repeat(context, grams).tolist(), byte.tolist(), seen.tolist(), held.tolist()):
                    own = np.cumsum(step[at : at + n].astype(int)).tolist()
                    assert h == held_out[own].sum()
                    found.update((c, b, text) for text in own)
                    at += n
            for _, (context, grams, byte, trained) in lm_scoring.gram_blocks(whole, held_out, 3, turn, False):
                counts.update(dict(zip(zip(np.repeat(context, grams).tolist(), byte.tolist()), trained.tolist())))
        assert found == expected
        assert counts == collections.Counter({k: sum(n for (*g, t), n in expected.items() if tuple(g) == k and not held_out[t]) for k in {x[:2] for x in expected}})


def test_estimates_of_small_and_large_counts():
    zeros, ones = np.array([0, 1, 255, 256, 3, 70000, 1 << 20]), np.array([0, 0, 255, 2, 9000, 70000, 5])
    expected = [math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1) for a, b in zip(zeros, ones)]
    assert lm_scoring._estimates(zeros, ones) == pytest.approx(expected, rel=1e-9, abs=1e-9)
