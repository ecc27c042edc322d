"""Operators that write and read files or encode texts: WARC, sequences, flat tokens, SentencePiece."""

import base64
import collections
import gzip
import hashlib
import pathlib
import random
import sys
import types
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from helpers import awkward, awkward_texts, prose  # noqa: E402

from cropspark.llm import sentencepiece, token_counts, token_output, warc, worker_cache  # noqa: E402

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# --- WARC ------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def read_back(spark, rows, path):
    warc.write_pages(pages(spark, rows), path)
    return warc.page_payloads(warc.read_records(spark, path))


def test_pages_come_back_from_the_archives(spark, tmp_path):
    same, tricky = "<p>é\r\n\r\n</p>" * 200, "WARC/1.1\r\nContent-Length: 5\r\n\r\nabc" * 60
    rows = [(1, "http://a/1", same), (2, None, None), (3, "http://a b/", ""), (7, "u", same), (9, "u", same), (9, "u", same)]
    rows += [(11, "u", "short"), (12, "u", "short"), (13, "u", tricky), (14, "long", prose(1, 60000)), (None, "u", same)]
    found = read_back(spark, rows, str(tmp_path / "a")).collect()
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        leads = html == same and page != 9
        expected.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if leads else "response", 9 if leads else None))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_long_pages_are_put_together_from_segments(spark, tmp_path):
    rows = [(i, f"http://a/{i}", prose(i, 900 + 40 * i)) for i in range(12)] + [(50, "u", "short"), (51, "u", "é" * warc.SEGMENT)]
    path = str(tmp_path / "a")
    warc.write_pages(pages(spark, rows), path)
    files = [gzip.decompress(f.read_bytes()) for f in (tmp_path / "a").glob("*.gz")]
    kinds = [fields["warc-type"] for f in files for fields, _ in warc.parse_records(f)]
    assert kinds.count("response") == 14 and kinds.count("continuation") >= 14
    shown = lambda df: sorted((r["page_id"], r["record_id"], r["warc_type"], bytes(r["payload"]), r["complete"]) for r in df.collect())
    whole = shown(warc.read_records(spark, path))
    assert [(i, p) for i, _, _, p, done in whole if done] == [(i, t.encode()) for i, _, t in rows]
    assert shown(warc.read_records(spark, path, regroup=True)) == whole


def test_records_without_an_id_are_not_put_together(spark, tmp_path):
    def record(n, part, page):
        return warc._record("response", "gone", {"WARC-Segment-Number": n, "Page-ID": page}, part).replace(b"WARC-Record-ID: <gone>\r\n", b"")

    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(b"\r\n\r\n".join([record(None, b"one", 1), record(None, b"two", 2), record(1, b"three", 3), record(1, b"four", 4)]))
    for regroup in (False, True):
        found = warc.read_records(spark, str(tmp_path / "w"), regroup).collect()
        assert sorted((r["page_id"], r["record_id"], r["payload"] and bytes(r["payload"])) for r in found) == [(1, None, b"one"), (2, None, b"two"), (3, None, None), (4, None, None)]


def test_an_empty_table_of_pages(spark, tmp_path):
    assert read_back(spark, [], str(tmp_path / "a")).count() == 0


def test_segments_in_any_file_and_order(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"payload " * 50, 7)
    parts = [body[i : i + 100] for i in range(0, len(body), 100)]

    def record(origin, n, part, total=None):
        fields = {"WARC-Segment-Number": n, "WARC-Segment-Total-Length": total}
        if n == 1:
            return warc._record("response", origin, {"Page-ID": 4, **fields}, part)
        return warc._record("continuation", f"{origin}:{n}", {"WARC-Segment-Origin-ID": f"<{origin}>", **fields}, part)

    def all_of(origin, total):
        return [record(origin, n, p, total if n == len(parts) else None) for n, p in enumerate(parts, 1)]

    whole = all_of("urn:a", len(body))
    records = [*whole, whole[1], *all_of("urn:short", len(body) + 1), *[r for k, r in enumerate(all_of("urn:gap", len(body))) if k != 2]]
    random.Random(4).shuffle(records)
    (tmp_path / "w").mkdir()
    plain = b"noise\r\n" + b"".join(r + b"\r\n\r\n" for r in records[: len(records) // 2])
    packed = b"".join(gzip.compress(r + b"\r\n\r\n") for r in records[len(records) // 2 :])
    (tmp_path / "w" / "a.warc").write_bytes(plain)
    (tmp_path / "w" / "b.warc.gz").write_bytes(packed)
    found = {r["record_id"]: r for r in warc.read_records(spark, str(tmp_path / "w")).collect()}
    assert bytes(found["urn:a"]["payload"]) == b"payload " * 50 and found["urn:a"]["page_id"] == 4
    assert not found["urn:short"]["complete"] and not found["urn:gap"]["complete"] and len(found) == 3


def test_broken_chunk_framing_has_no_payload():
    for framed in (b"", b"zz\r\nab", b"5\r\nab\r\n0\r\n\r\n", b"2\r\nabX"):
        assert warc.unchunked(framed) is None
    assert warc.unchunked(warc.chunked(b"abc" * 9, 4)) == b"abc" * 9


# --- sequences and flat tokens -------------------------------------------------------


def encoded(texts, end):
    tokenizer = token_output.load_tokenizer(TOKENIZER)
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end], "<u4") for t in texts]


def mixtures(n):
    """Texts of signs around which the tokenizer's pattern is particular about."""
    rng, signs = random.Random(5), [*"a b B 1 , . ' ' ( - \n \n \t \r \x00 \x1c \x85 \xa0 \u3000 \u180e \ufeff é 漢 ß × ÷ Я 한 \u2028 \u205f à ́ 😀".split(" "), " ", " ", "  ", "'s", "'ll", " the", " house's", "x" * 30]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_chunks_get_the_ids_of_whole_texts(monkeypatch):
    texts = mixtures(3000) + [t or "" for t in awkward_texts()]
    expected = encoded(texts, 2)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    monkeypatch.setattr(token_output, "SLICE_BYTES", 4000)
    for kept_chunks in (100, 10**6):
        monkeypatch.setattr(token_output, "KEPT_CHUNKS", kept_chunks)
        for pattern in (public_tokenizers.PATTERN, "another"):
            encoder = token_output.Encoder(TOKENIZER, pattern)
            found = [ids for part in token_output.slices(batch.column(1), 4000) for ids in encoder.encode_slice(part, 2)]
            assert len(found) == len(expected) and all(np.array_equal(a, b) for a, b in zip(found, expected))


def test_equal_hashes_don_t_mix_chunks(monkeypatch):
    monkeypatch.setattr(token_output, "mixed", lambda h: h * np.uint64(0) + np.uint64(7))
    texts = ["one two three", "two three, one", "", "three"]
    part = next(token_output.slices(pa.array(texts)))
    found = list(token_output.Encoder(TOKENIZER, public_tokenizers.PATTERN).encode_slice(part, 2))
    assert all(np.array_equal(a, b) for a, b in zip(found, encoded(texts, 2)))


def test_a_worker_gives_a_chunk_to_the_library_once(monkeypatch):
    monkeypatch.setitem(sys.modules, worker_cache.HELD, types.ModuleType(worker_cache.HELD))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2]), "text": pa.array([prose(7, 300), prose(7, 300)])})
    given, encode = [], token_output.load_tokenizer(TOKENIZER).__class__.encode_batch_fast

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode_batch_fast(self, texts, **options):
            given.extend(w for t in texts for w in t.split())
            return encode(self.tokenizer, texts, **options)

    tokenizer = Counting(token_output.load_tokenizer(TOKENIZER))
    monkeypatch.setattr(token_output, "load_tokenizer", lambda path: tokenizer)
    for _ in range(2):  # two tasks
        assert len(list(token_output.encoded(iter([batch]), TOKENIZER, public_tokenizers.PATTERN, 2))) == 2
    # a word is given with a blank before it, and without one at the start of a line
    assert given and max(collections.Counter(given).values()) <= 2


def test_sequences_hold_all_documents_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "ROWS", 2)
    monkeypatch.setattr(token_output, "LENGTH", 64)
    texts, path = awkward_texts(), str(tmp_path / "s")
    docs = awkward(spark, texts).repartition(3)
    token_output.write_sequences(docs, path, TOKENIZER, public_tokenizers.PATTERN, end_id=2)
    expected, start = [], 0
    for i, ids in enumerate(encoded(texts, 2)):
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in token_output.read_documents(spark, path).collect()) == expected
    files = [token_output.Sequences(str(p)) for p in (tmp_path / "s").glob("*.txt")]
    assert files and sum(len(f.tokens()) for f in files) == start
    ids, mask = files[0].sequence(1)
    assert ids.base is not None and len(ids) == len(mask) == 64
    assert np.array_equal(ids, files[0].batch(0)[1])


def test_documents_with_equal_ids_follow_by_text(spark, tmp_path):
    texts = ["b c", None, "a much longer text", "", "b c"]
    docs = spark.createDataFrame([(4, t) for t in texts] + [(None, "first"), (5, "last")], "doc_id bigint, text string")
    token_output.write_sequences(docs.repartition(4), str(tmp_path / "s"), TOKENIZER, public_tokenizers.PATTERN, end_id=2)
    order = [(None, "first"), (4, None), (4, ""), (4, "a much longer text"), (4, "b c"), (4, "b c"), (5, "last")]
    expected, start = [], 0
    for (i, _), ids in zip(order, encoded([t for _, t in order], 2)):
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = [tuple(r) for r in token_output.read_documents(spark, str(tmp_path / "s")).collect()]
    assert sorted(found, key=lambda r: r[1]) == expected


def test_no_documents_no_sequences(spark, tmp_path):
    token_output.write_sequences(awkward(spark, []), str(tmp_path / "s"), TOKENIZER, public_tokenizers.PATTERN, 2)
    token_counts.write_flat(awkward(spark, []), str(tmp_path / "f"), RANKS, public_tokenizers.PATTERN, 50256)
    assert token_output.read_documents(spark, str(tmp_path / "s")).count() == 0
    assert token_counts.count_tokens(spark, str(tmp_path / "f"), 50256).count() == 0


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_pieces_give_the_ids_of_whole_texts():
    encoder, rng = token_output.Encoder(TOKENIZER, public_tokenizers.PATTERN), random.Random(5)
    texts = ["".join(rng.choice("ab'st \n\t\r\x0b é漢1#!́😀") for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    assert all(np.array_equal(a, b) for a, b in zip(encoder.encode(texts, 2), encoded(texts, 2)))


def test_flat_files_are_counted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "FILE_BYTES", 4000)
    monkeypatch.setattr(token_counts, "BLOCK", 300)
    texts, path = awkward_texts(), str(tmp_path / "f")
    token_counts.write_flat(awkward(spark, texts).coalesce(1), path, RANKS, public_tokenizers.PATTERN, 50256)
    assert len(list((tmp_path / "f").glob("*.txt"))) > 2
    found = sorted(tuple(r) for r in token_counts.count_tokens(spark, path, 50256).select("document", "start", "n_tokens").collect())
    expected, start = [], 0
    for i, ids in enumerate(encoded(texts, 2)):
        expected.append((i, start, len(ids) - 1))
        start += len(ids)
    assert found == expected


def test_documents_run_over_blocks_and_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 4)
    files = [[1, 2, 9], [3] * 11, [9, 9, 4], [5, 6]]
    for k, ids in enumerate(files):
        (tmp_path / f"{k}.bin").write_bytes(np.array(ids, "<u2").tobytes())
    found = sorted(tuple(r) for r in token_counts.count_tokens(spark, str(tmp_path), 9).select("document", "start", "n_tokens", "ended").collect())
    assert found == [(0, 0, 2, True), (1, 3, 11, True), (2, 15, 0, True), (3, 16, 3, False)]


def test_files_follow_by_the_numbers_in_their_names(spark, tmp_path):
    names = ["part-9-c1000.bin", "part-10-c002.bin", "part-9-c999.bin", "part-99999.bin", "part-100000.bin"]
    wanted = ["part-9-c999.bin", "part-9-c1000.bin", "part-10-c002.bin", "part-99999.bin", "part-100000.bin"]
    for name in names:
        (tmp_path / name).write_bytes(np.array([1] * wanted.index(name) + [9], "<u2").tobytes())
    (tmp_path / "part-100001.bin").write_bytes(np.array([5], "<u2").tobytes())
    found = sorted((r["document"], r["n_tokens"], r["file"].rsplit("/", 1)[1]) for r in token_counts.count_tokens(spark, str(tmp_path), 9).collect())
    assert found == [*((k, k, name) for k, name in enumerate(wanted)), (5, 1, "part-100001.bin")]


# --- SentencePiece -----------------------------------------------------------------


def library(kind=None):
    import sentencepiece as spm
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(pathlib.Path(MODEL).read_bytes())
    if kind is not None:
        model.trainer_spec.model_type = kind
        for piece in model.pieces:  # sums of 32 bits can't hold such scores beside small ones
            piece.score = max(piece.score, -50000.0)
    return spm.SentencePieceProcessor(model_proto=model.SerializeToString()), model.SerializeToString()


@pytest.mark.parametrize("slice_bytes", [sentencepiece.SLICE_BYTES, 500])
@pytest.mark.parametrize("kind", [None, 1])
def test_ids_are_those_of_the_library(spark, tmp_path, monkeypatch, kind, slice_bytes):
    monkeypatch.setattr(sentencepiece, "SLICE_BYTES", slice_bytes)
    known, raw = library(kind)
    (tmp_path / "m.model").write_bytes(raw)
    model = sentencepiece.load_model(str(tmp_path / "m.model"))
    assert model.merges == (kind is None)
    texts = awkward_texts() + ["  two  blanks ", "▁ sign", "tab\tand more", "1,234.50 --> x==y;", "q" * 700]
    rows = sentencepiece.encode(awkward(spark, texts), model)
    assert rows.columns == ["doc_id", "text", "lang", "n", "h", "ids"]
    found = {r["doc_id"]: r for r in sentencepiece.decode(rows, model).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        assert found[i]["decoded"] == text.replace("▁", " ")
        expected = known.encode(text)
        if kind is None:
            assert found[i]["ids"] == expected, text[:50]
        else:
            score = lambda ids: sum(known.get_score(k) for k in ids)
            assert score(found[i]["ids"]) == pytest.approx(score(expected)) and len(found[i]["ids"]) == len(expected)


def test_no_documents_to_encode(spark):
    model = sentencepiece.load_model(MODEL)
    assert sentencepiece.encode(awkward(spark, []), model).count() == 0


def test_base64_ranks_are_whole():
    encoding = token_counts.load_encoding(RANKS, public_tokenizers.PATTERN)
    assert encoding.n_vocab == 50256 and base64.b64encode(b"the")


def test_words_are_merged_as_arrays(spark, capsys):
    """All words of a length at once give what each gives alone, and nothing is folded row by row in Spark."""
    model = sentencepiece.load_model(MODEL)
    pieces = sentencepiece._Pieces(model)
    random = np.random.default_rng(5)
    letters = np.array(list("aeiostnrhl'.,-0é漢😀\n"))
    words = ["".join(random.choice(letters, size)) for size in random.integers(1, 90, 3000)]
    words += ["the", " the", " internationalization", "    ", "   x", "a", "", "x" * 64, "x" * 65]
    flat, sizes = sentencepiece._merged_words([w.encode() for w in words], model, pieces)
    ends = np.cumsum(sizes)
    for word, a, b in zip(words, ends - sizes, ends):
        assert flat[a:b].tolist() == sentencepiece.merged(word.replace(" ", sentencepiece.BLANK), model, pieces.table), word
    capsys.readouterr()
    sentencepiece.encode(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"), model).explain()
    plan = capsys.readouterr().out
    assert plan.count("MapInArrow") == 1 and "aggregate(" not in plan
