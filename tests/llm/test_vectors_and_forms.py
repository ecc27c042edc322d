"""Near-duplicate vectors, fill-in-middle and token alignment against brute force."""

import collections
import hashlib
import pathlib
import random
import re
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from helpers import awkward, awkward_texts, prose  # noqa: E402

from cropspark.llm import embedding_near_dedup, fill_in_middle, queries, token_alignment  # noqa: E402
from cropspark.llm.text_arrays import slices  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def linked_vectors(rows, cosine=0.95):
    """(id, links, smallest id reachable, kept) of each row, by all pairs."""
    units = []
    for i, v in rows:
        fine = i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        v = np.array(v, float) / np.abs(v).max() if fine else None
        units.append(v / np.linalg.norm(v) if fine else None)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(units):
        for j, b in enumerate(units[:i]):
            if a is not None and b is not None and len(a) == len(b) and a @ b >= cosine:
                links[i], links[j] = links[i] + 1, links[j] + 1
                parent[root(i)] = root(j)
    least = {}
    for i, (own, _) in enumerate(rows):
        if own is not None:
            least[root(i)] = min(least.get(root(i), own), own)
    return sorted(((i, links[k], least.get(root(k)), i is None or i == least[root(k)]) for k, (i, _) in enumerate(rows)), key=repr)


def some_vectors():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    rows = []
    for i in range(500):  # copies at all distances from their original, on both sides of the limit
        v = base[rng.integers(40)] + rng.normal(size=16) * rng.choice([0.05, 0.15, 0.22, 0.4, 1])
        rows.append((i + 10, v.astype("f4").astype(float).tolist()))
    odd = [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0], [1e300, 2e300], [-0.0, 1e-310]]
    rows += [(2000 + i, v) for i, v in enumerate(odd)] + [(None, rows[0][1]), (3, rows[3][1]), (3, rows[4][1]), (3000, [3 * x for x in rows[3][1]])]
    return rows + [(4000 + i, rows[3][1]) for i in range(20)]


@pytest.mark.parametrize("block, group", [(4096, 65536), (7, 50)])
def test_vectors_match_all_pairs(spark, monkeypatch, block, group):
    monkeypatch.setattr(embedding_near_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_near_dedup, "GROUP", group)
    rows = some_vectors()
    found = embedding_near_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == linked_vectors(rows)


def test_vectors_at_the_limit_do_not_depend_on_the_blocks(spark):
    # cosine exactly 0.95 by integers: 19 of 20
    rows = [(1, [20.0, 0.0, 0.0]), (2, [19.0, 39.0**0.5, 0.0]), (3, [19.0, 0.0, 39.0**0.5])]
    limit = [embedding_near_dedup.exact_cosine_reaches(np.array(rows[0][1]).tobytes(), np.array(v).tobytes(), 0.95) for _, v in rows[1:]]
    found = embedding_near_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r["vec_id"]: r["n_links"] for r in found} == {1: sum(limit), 2: int(limit[0]), 3: int(limit[1])}


def test_vectors_empty_tables_and_columns_of_their_own(spark):
    schema = "node string, id int, v array<float>, kept string, `a.b` int"
    assert embedding_near_dedup.near_duplicates(spark.createDataFrame([], schema), "id", "v").count() == 0
    rows = spark.createDataFrame([("x", 1, [1.0, 0.0], "k", 1), ("y", 2, [1.0, 0.1], "l", 2), ("z", None, [1.0, 0.0], "m", 3)], schema)
    kept = embedding_near_dedup.keep_one(rows, "id", "v")
    assert kept.columns == rows.columns and sorted(r["node"] for r in kept.collect()) == ["x", "z"]


def rearranged(doc_id, text):
    """The contract of the transformation in plain Python."""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    shown = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(shown[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return doc_id, len(lines), "plain", None, None, text
    if h4 % 100 < 50:
        return doc_id, len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def marked_texts():
    """Lines around marks that run over chunk borders, and parts of marks."""
    rng = random.Random(4)
    out = ["<P>", "a <S", "> b", "\n", "\n\n", "x\n", "\r\n a \x0b\n b", "<M", "<<P", "<P\n>", "é\n漢字\n" * 50]
    for i in range(60):
        text = prose(100 + i, 700)
        if i % 2:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["<P>", "<S>", "<M>", "<<S", "<M\n>"]) + text[at:]
        out.append(text)
    return out


def test_fill_in_middle_matches_its_rule(spark):
    texts = awkward_texts() + marked_texts()
    docs = awkward(spark, texts)
    done = fill_in_middle.transform(docs)
    assert sorted(map(tuple, done.collect())) == sorted(rearranged(i, t or "") for i, t in enumerate(texts))
    back = done.select("doc_id", fill_in_middle.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert {r["doc_id"]: r["text"] for r in back} == {i: t or "" for i, t in enumerate(texts)}


def test_fill_in_middle_rates_ids_and_columns(spark):
    docs = spark.createDataFrame([(None, "a\nb\nc", 1), (4, "a\nb\nc", 2), (4, "a\nb\nc", 3), (5, None, 4)], "id int, body string, n int")
    done = fill_in_middle.transform(docs, "id", "body")
    assert sorted(map(tuple, done.collect()), key=repr) == sorted((rearranged(i, t or "") for i, t, _ in docs.collect()), key=repr)
    assert {r["form"] for r in fill_in_middle.transform(docs, "id", "body", rate=0).collect()} == {"plain"}
    assert {r["form"] for r in fill_in_middle.transform(docs, "id", "body", suffix_first=100).filter("n > 0").collect()} == {"spm"}
    assert fill_in_middle.transform(docs.filter("false"), "id", "body").count() == 0


def test_shared_chunks_are_summarised_once_and_verified():
    import pyarrow as pa

    passage = prose(7, 4000)
    memo = fill_in_middle.Memo()
    for text in (prose(8, 300) + passage, prose(9, 700) + passage):
        list(fill_in_middle.chunked(next(slices(pa.array([text.encode()], pa.binary()), 1 << 30)), memo))
    assert sum(len(s.content) for s in memo.found.values()) < len(passage) + 12_000 and memo.reused > 5
    first = memo.of(1, b"one\n")
    assert memo.of(1, b"two") is not first and memo.of(1, b"two").chars == 3 and memo.of(1, b"one\n") is first


def aligned(texts):
    """The contract of the alignment in plain Python."""
    import sentencepiece
    import tokenizers

    first = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = token_alignment.byte_letters()
    links, count, out = [], collections.Counter(), []
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            links.append(None)
            continue
        spans = []
        for tokens in (bytes_a, bytes_b):
            ends = np.cumsum([len(t) for t in tokens]).tolist()
            spans.append([(e - len(t), e) for t, e in zip(tokens, ends)])
        own, j = [], 0
        for i, (start, end) in zip(a, spans[0]):
            while spans[1][j][1] <= start:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < end:
                own.append((i, b[k]))
                k += 1
        both = {e for _, e in spans[0]} & {e for _, e in spans[1]}
        shown, last = [], 0
        for end in sorted(both):
            shown.append("|".join(",".join(str(i) for i, (_, e) in zip(ids, s) if last < e <= end) for ids, s in zip((a, b), spans)))
            last = end
        links.append((len(a), len(b), len(both), own, hashlib.sha256(";".join(shown).encode()).hexdigest()))
        count.update(own)
    best = collections.Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    for x in links:
        out.append((0, 0, 0, 0, 0, 0, "") if x is None else (*x[:3], len(x[3]), sum(count[p] == best[p[1]] for p in x[3]), sum(count[p] for p in x[3]), x[4]))
    return out, count


FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_byte_level_ids_are_the_librarys_with_and_without_ranks(tmp_path):
    import json

    import tokenizers

    with open(FILES[0], encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"]["ignore_merges"] = True  # not the plain rule any more
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec), encoding="utf-8")
    # every letter beside letters, digits, blanks and signs
    points = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b 1{c} {c}  !{c}" for c in points[at : at + 4096]) for at in range(0, len(points), 4096)]
    for path, ranked in ((FILES[0], True), (str(other), False)):
        own, known = token_alignment.ByteLevel(path), tokenizers.Tokenizer.from_file(path)
        known.encode_special_tokens = True
        sample = texts if ranked else texts[:2]
        counts, ids = own.encode([*sample, "<|endoftext|>", ""])
        expected = [known.encode(" " + t, add_special_tokens=False).ids for t in [*sample, "<|endoftext|>", ""]]
        assert own.ranked is ranked and counts.tolist() == [len(e) for e in expected] and ids.tolist() == sum(expected, [])


def short_texts():
    texts = [t if t is None or len(t) < 9000 else t[:4000] for t in awkward_texts()]
    return texts + ["<|endoftext|> <s> </s> <unk>", "  two  blanks ", "\tx\r\n", "ＡＢ ﬁ é", "🙂🙂 ok", "\x00", "▁", "a▁b", *texts[8:11]]


@pytest.mark.parametrize("block_links", [token_alignment.LINKS, 500])
def test_alignment_matches_brute_force(spark, monkeypatch, block_links):
    monkeypatch.setattr(token_alignment, "LINKS", block_links)
    texts = short_texts()
    docs = awkward(spark, texts).repartition(3)
    found = token_alignment.align(docs, *FILES)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected, count = aligned(texts)
    assert sorted(tuple(r) for r in found.select(names).collect()) == [(i, *x) for i, x in enumerate(expected)]
    pairs = token_alignment.pair_counts(token_alignment.index(docs, *FILES)).collect()
    assert {(r["a"], r["b"]): r["n_links"] for r in pairs} == dict(count)
    assert max(r["n_docs"] for r in pairs) <= len(texts) and all(1 <= r["n_docs"] <= r["n_links"] for r in pairs)


def test_dense_bitmaps_and_planes():
    keys = [np.repeat(np.array([(5 << token_alignment._SLOT) | s for s in range(3000)], np.int64), [1 + s % 6 for s in range(3000)])]
    batches = list(token_alignment._inverted(9, keys + [np.array([(6 << token_alignment._SLOT) | 17], np.int64)]))
    sums = np.zeros((2, token_alignment.DOCS), np.int64)
    import pyarrow as pa

    for batch in batches:
        k = batch.num_rows
        token_alignment._add_scores(sums, pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("plane", "n", "dense", "docs")} | {"links": pa.array([10] * k), "best": pa.array([True] * k)}))
    own = np.array([1 + s % 6 for s in range(3000)])
    own[17] += 1
    assert sums[0, :3000].tolist() == (10 * own).tolist() and sums[1, :3000].tolist() == own.tolist() and not sums[:, 3000:].any()
    assert any(b.column("dense").to_pylist()[0] for b in batches)


def test_alignment_of_empty_tables_null_ids_and_other_columns(spark):
    docs = spark.createDataFrame([(None, "a word", "x"), (1, "a word", "y"), (1, "a word", "z")], "pair int, block string, slot string")
    rows = token_alignment.align(docs, *FILES, "pair", "block").collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "1", "None"] and len({(r["count_sum"], r["n_best"], r["groups_sha256"]) for r in rows}) == 1
    assert token_alignment.align(docs.filter("false"), *FILES, "pair", "block").count() == 0


@pytest.mark.skipif(not pathlib.Path(SMALL).exists(), reason="no test tables")
def test_registered_alignment_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    expected, _ = aligned([r["text"] for r in docs])
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op13_token_alignment"](spark, SMALL).collect()}
    assert found == {r["doc_id"]: x for r, x in zip(docs, expected)}
