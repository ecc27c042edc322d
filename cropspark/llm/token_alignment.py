"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes, a blank and the text, into tokens. Tokens are linked where
their byte ranges overlap; places where tokens of both end cut the text into groups.

1. One pass encodes each text with both tokenizers and finds ends, groups and links on whole
   arrays. Documents are numbered in blocks of up to `DOCS` documents or `LINKS` links. A block
   is inverted: each linked pair of ids gets a document bitmap, and planes of bitmaps that hold
   the binary digits of (links - 1) of each document. A bitmap is kept as its sorted 16-bit slots,
   or as a bitset where that is shorter. Documents and bitmaps are written in that one pass.
2. The bitmaps of a pair in different blocks hold different documents, so their union is never
   built: population counts are added up over blocks, weighted by plane, which gives documents
   and links of each pair. A pair that occurs everywhere is one row a block.
3. Pairs get their links and whether these are the most of their second id. Postings are joined
   to that, go back to their block and add the scores to its documents.

Texts are read in slices of a megabyte or one longer text, so a task's memory is bounded by a
block and the longest text. The pass is the only place where texts are tokenized.

Defined results: texts that are null or empty, and texts whose tokens do not join to the blank
and the text (the second tokenizer changes some signs; bytes that are not UTF-8) have no tokens,
zeros and an empty digest; equal rows, and rows with equal ids or without an id, each give a row
and each count; an empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropspark.llm.frames import stored
from cropspark.llm.text_arrays import Texts, slices

DOCS = 8192
LINKS = 2_000_000
#: Bits of a pair that its second id takes.
SECOND = 24
_SLOT = DOCS.bit_length() - 1
_ROWS = 200_000
_SCHEMA = (
    "block bigint, slot int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pair bigint, plane int, n int, dense boolean, docs binary"
)
_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
_FIELDS = {f.split()[0]: _TYPES[f.split()[1]] for f in _SCHEMA.split(", ")}


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of each id, one after the other."""

    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        sizes = np.array([len(t) for t in tokens], np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens in a row."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.data[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte.

    Fixed values: printable bytes of Latin-1 stand for themselves, the others follow from U+0100.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


# Fixed value: the pattern by which the byte-level pre-tokenizer cuts texts.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ids, and the ids one after the other."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return counts, np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum()))


class ByteLevel:
    """A byte-level BPE file of the tokenizers library; special tokens in texts are plain text.

    If the file has the standard pattern and no other rules, and ids in the order of merges, its
    entries are ranks: tiktoken then gives the same ids in a quarter of the time. Any other file is
    left to the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        import tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, entries, model = byte_letters(), spec["model"]["vocab"], spec["model"]
        entries = entries | {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            tokens[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.vocabulary = Vocabulary.of(tokens)
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        single = sorted(model["vocab"][c] for c in letters)
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        rules = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        self.ranked = (
            spec["normalizer"] is None
            and {k: (spec["pre_tokenizer"] or {}).get(k) for k in plain} == plain
            and not any(model.get(r) for r in rules)
            and single + made == list(range(len(model["vocab"])))
        )
        if self.ranked:
            ranks = {tokens[i]: i for i in model["vocab"].values()}
            self.ranks = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            self.tokenizer = tokenizers.Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = [" " + t for t in texts]
        if not self.ranked:
            return flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        ids = [self.ranks.encode_to_numpy(t, disallowed_special=()) for t in texts]
        return np.array([len(i) for i in ids], np.int64), np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)


class Pieces:
    """A SentencePiece model, which puts the blank in front itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.vocabulary = Vocabulary.of(
            [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        )

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat(self.model.encode(texts, num_threads=1) if texts else [])


def _decimals(n: int) -> np.ndarray:
    """One row per number below n: its digits, zeros before them, and room for a separator."""
    width = len(str(max(n - 1, 0)))
    numbers = np.arange(n)
    out = np.zeros((n, width + 1), np.uint8)
    for place in range(width):
        shown = (numbers >= 10**place) | (place == 0)
        out[shown, width - 1 - place] = 48 + (numbers[shown] // 10**place) % 10
    return out


@dataclass
class Aligned:
    """The documents of a slice: numbers of each, digests, and the links with their document."""

    counts: dict[str, np.ndarray]
    digests: list[str]
    has_tokens: np.ndarray
    pairs: np.ndarray
    owner: np.ndarray


class Aligner:
    def __init__(self, first, second):
        self.sides = (first, second)
        self.decimals = [_decimals(len(s.vocabulary.sizes)) for s in self.sides]

    def _fitting(self, part: Texts) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Documents with tokens, both sides' ids and numbers of ids, and the documents' sizes."""
        sizes = np.diff(part.offsets)
        docs = np.flatnonzero(sizes)
        texts = [part.text(i).decode("utf-8", "replace") for i in docs.tolist()]
        counts, ids = [], []
        for side in self.sides:
            own = side.encode(texts)
            counts.append(own[0])
            ids.append(own[1])
        size = sizes[docs] + 1
        for fits in (self._same_size, self._same_bytes):
            good = fits(part, docs, size, ids, counts)
            if not good.all():
                ids = [i[np.repeat(good, c)] for i, c in zip(ids, counts)]
                docs, size, counts = docs[good], size[good], [c[good] for c in counts]
        return docs, ids, counts, size

    def _same_size(self, part, docs, size, ids, counts) -> np.ndarray:
        good = np.ones(len(docs), bool)
        for side, i, c in zip(self.sides, ids, counts):
            good &= np.bincount(np.repeat(np.arange(len(docs)), c), side.vocabulary.sizes[i], len(docs)) == size
        return good

    def _same_bytes(self, part, docs, size, ids, counts) -> np.ndarray:
        good = np.ones(len(docs), bool)
        if not len(docs):
            return good
        ends = np.cumsum(size)
        starts = ends - size
        expected = part.data[np.maximum(np.repeat(part.offsets[docs] - 1 - starts, size) + np.arange(ends[-1]), 0)]
        expected[starts] = 32
        for side, i in zip(self.sides, ids):
            good &= ~np.logical_or.reduceat(side.vocabulary.joined(i) != expected, starts)
        return good

    def _shown(self, ids, ends, group_of, groups) -> np.ndarray:
        """One row per token in order of groups: its digits and what separates it from the next."""
        before = [np.searchsorted(e, groups, "right") for e in ends]  # tokens up to the end of each group
        zero = np.zeros(1, np.int64)
        at_a = np.arange(len(ids[0])) + np.concatenate([zero, before[1]])[group_of[0]]
        at_b = np.arange(len(ids[1])) + before[0][group_of[1]]
        width = max(d.shape[1] for d in self.decimals)
        rows = np.zeros((len(ids[0]) + len(ids[1]), width), np.uint8)
        for i, at, table in zip(ids, (at_a, at_b), self.decimals):
            rows[at, width - table.shape[1] :] = table[i]
        rows[:, -1] = ord(",")
        rows[at_a[before[0] - 1], -1] = ord("|")
        rows[at_b[before[1] - 1], -1] = ord(";")
        return rows

    def align(self, part: Texts) -> Aligned:
        docs, ids, counts, size = self._fitting(part)
        n_docs = len(docs)
        names = ("n_a", "n_b", "n_groups", "n_links")
        out = {name: np.zeros(part.n, np.int64) for name in names}
        digests = [""] * part.n
        has = np.zeros(part.n, bool)
        has[docs] = True
        if not n_docs:
            return Aligned(out, digests, has, np.zeros(0, np.int64), np.zeros(0, np.int64))
        ends = [np.cumsum(s.vocabulary.sizes[i]) for s, i in zip(self.sides, ids)]
        both = np.searchsorted(ends[1], ends[0])
        groups = ends[0][ends[1][both] == ends[0]]
        doc_ends = np.cumsum(size)
        n_groups = np.diff(np.searchsorted(groups, doc_ends, "right"), prepend=0)
        # the tokens of the other side from the one that covers a token's first byte to that of its last
        low = np.searchsorted(ends[1], ends[0] - self.sides[0].vocabulary.sizes[ids[0]], "right")
        n_linked = both - low + 1
        first = np.cumsum(n_linked) - n_linked
        other = np.repeat(low - first, n_linked) + np.arange(int(n_linked.sum()))
        pairs = (np.repeat(ids[0], n_linked) << SECOND) | ids[1][other]
        owner = np.repeat(np.repeat(docs, counts[0]), n_linked)
        for name, values in zip(names, (counts[0], counts[1], n_groups, counts[0] + counts[1] - n_groups)):
            out[name][docs] = values
        group_of = [np.searchsorted(groups, e) for e in ends]
        rows = self._shown(ids, ends, group_of, groups)
        sizes = np.count_nonzero(rows, axis=1)
        text = rows[rows != 0].tobytes()
        token_ends = np.cumsum(counts[0] + counts[1])
        at = np.concatenate([[0], np.cumsum(sizes)[token_ends - 1]]).tolist()
        for k, doc in enumerate(docs.tolist()):
            digests[doc] = hashlib.sha256(text[at[k] : at[k + 1] - 1]).hexdigest()
        return Aligned(out, digests, has, pairs, owner)


def _batch(length: int, **columns) -> pa.RecordBatch:
    arrays = [
        (c if isinstance(c, pa.Array) else pa.array(c, kind)) if (c := columns.get(name)) is not None else pa.nulls(length, kind)
        for name, kind in _FIELDS.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=list(_FIELDS))


def _bitmaps(block: int, plane: int, pairs: np.ndarray, slots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Postings in order of pair, then slot: one bitmap per pair."""
    if not len(pairs):
        return
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    n = np.diff(np.append(starts, len(pairs)))
    dense = n * 2 > DOCS // 8
    thin = np.flatnonzero(~dense)
    flat = slots[np.repeat(~dense, n)].astype("<u2")
    ends = np.concatenate([[0], np.cumsum(n[thin])])
    for at in range(0, len(thin), _ROWS):
        own = thin[at : at + _ROWS]
        a, b = ends[at], ends[at + len(own)]
        offsets = ((ends[at : at + len(own) + 1] - a) * 2).astype(np.int32)
        docs = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(offsets), pa.py_buffer(flat[a:b].tobytes())])
        k = len(own)
        yield _batch(k, block=np.full(k, block), pair=pairs[starts[own]], plane=np.full(k, plane, np.int32), n=n[own].astype(np.int32), dense=np.zeros(k, bool), docs=docs)
    thick = np.flatnonzero(dense)
    if len(thick):
        sets = []
        for i in thick.tolist():
            bits = np.zeros(DOCS, bool)
            bits[slots[starts[i] : starts[i] + n[i]]] = True
            sets.append(np.packbits(bits, bitorder="little").tobytes())
        k = len(thick)
        counted = np.bitwise_count(np.frombuffer(b"".join(sets), "<u8").reshape(k, -1)).sum(1).astype(np.int32)
        yield _batch(k, block=np.full(k, block), pair=pairs[starts[thick]], plane=np.full(k, plane, np.int32), n=counted, dense=np.ones(k, bool), docs=sets)


def _inverted(block: int, keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The bitmaps of a block: plane 0 of documents, plane j of the digit 2**(j - 1) of links - 1."""
    if not keys:
        return
    links = np.sort(np.concatenate(keys))
    starts = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]]))
    more = np.diff(np.append(starts, len(links))) - 1
    pairs, slots = links[starts] >> _SLOT, links[starts] & (DOCS - 1)
    yield from _bitmaps(block, 0, pairs, slots)
    for digit in range(int(more.max()).bit_length()):
        set_here = (more >> digit) & 1 == 1
        yield from _bitmaps(block, digit + 1, pairs[set_here], slots[set_here])


def _index(batches: Iterator[pa.RecordBatch], load) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    block, slot, keys, n_links, aligner = TaskContext.get().partitionId() << 32, 0, [], 0, None
    for batch in batches:
        aligner = aligner or load()
        for part in slices(batch.column(1)):
            done = aligner.align(part)
            ids = batch.column(0).slice(part.first, part.n)
            at, ends = 0, np.cumsum(np.bincount(done.owner, minlength=part.n))
            while at < part.n:
                # so many documents as the block takes; a document without tokens has no slot
                to = min(part.n, at + DOCS - slot)
                span = slice(at, to)
                has = done.has_tokens[span]
                slots = np.where(has, slot + np.cumsum(has) - 1, -1)
                links = slice(ends[at - 1] if at else 0, ends[to - 1])
                keys.append(done.pairs[links] << _SLOT | slots[done.owner[links] - at])
                yield _batch(
                    to - at, block=np.full(to - at, block), slot=slots.astype(np.int32), doc_id=ids.slice(at, to - at), groups_sha256=done.digests[span], **{k: v[span] for k, v in done.counts.items()}
                )
                slot, n_links, at = slot + int(has.sum()), n_links + links.stop - links.start, to
                if slot == DOCS or n_links >= LINKS:
                    yield from _inverted(block, keys)
                    block, slot, keys, n_links = block + 1, 0, [], 0
    yield from _inverted(block, keys)


def index(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents (pair is null) and postings (pair is not null), written to the shared folder.

    `first` is a file of the tokenizers library, `second` one of SentencePiece.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    load = functools.partial(_load, first, second)
    return stored(rows.mapInArrow(lambda batches: _index(batches, load), _SCHEMA), "pair-bitmaps")


def _load(first: str, second: str) -> Aligner:
    return Aligner(ByteLevel(first), Pieces(second))


def pair_counts(indexed: DataFrame) -> DataFrame:
    """(pair, a, b, n_docs, n_links): documents and links of each pair over all blocks."""
    weight = F.expr("shiftleft(cast(n as bigint), greatest(plane - 1, 0))")
    counted = (
        indexed.filter("pair is not null")
        .groupBy("pair")
        .agg(F.sum(F.when(F.col("plane") == 0, F.col("n")).otherwise(0)).alias("n_docs"), F.sum(weight).alias("n_links"))
    )
    a, b = F.shiftright("pair", SECOND), F.col("pair").bitwiseAND((1 << SECOND) - 1)
    return counted.select("pair", a.alias("a"), b.alias("b"), "n_docs", "n_links")


_RETURNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _add_scores(sums: np.ndarray, rows: pa.RecordBatch) -> None:
    """Add the postings of one block to the sums (count, best) of its slots."""
    plane, n, links, best, dense = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("plane", "n", "links", "best", "dense"))
    shift = np.maximum(plane.astype(np.int64) - 1, 0)
    weights = np.stack([links.astype(np.int64) << shift, np.where(best.astype(bool), 1 << shift, 0)])
    dense = dense.astype(bool)
    thin = np.flatnonzero(~dense)
    if len(thin):
        slots = np.frombuffer(b"".join(rows.column("docs").take(pa.array(thin)).to_pylist()), "<u2")
        for total, weight in zip(sums, weights[:, thin]):
            np.add.at(total, slots, np.repeat(weight, n[thin].astype(np.int64)))
    for i in np.flatnonzero(dense).tolist():
        bits = np.unpackbits(np.frombuffer(rows.column("docs")[i].as_buffer(), np.uint8), bitorder="little").astype(bool)
        sums[:, bits] += weights[:, i : i + 1]


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of some blocks with their scores.

    Sums take a small share of what the postings of their block take, so memory is bounded by the
    size of a shuffle partition; postings themselves are not held.
    """
    blocks: dict[int, np.ndarray] = {}
    docs: list[pa.RecordBatch] = []
    names = [c.split()[0] for c in _RETURNED.split(", ")]
    for batch in batches:
        is_doc = pc.is_null(batch.column("links"))
        docs.append(batch.filter(is_doc).select(["block", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]))
        postings = batch.filter(pc.invert(is_doc))
        own = postings.column("block").to_numpy()
        order = np.argsort(own, kind="stable")
        starts = np.flatnonzero(np.diff(own[order], prepend=-1))
        for at, rows in zip(starts.tolist(), np.split(order, starts[1:])):
            sums = blocks.setdefault(int(own[order[at]]), np.zeros((2, DOCS), np.int64))
            _add_scores(sums, postings.take(pa.array(rows)))
    for batch in docs:
        block, slot = (batch.column(c).to_numpy() for c in ("block", "slot"))
        sums = np.zeros((2, len(slot)), np.int64)
        for own in np.unique(block[slot >= 0]).tolist():
            here = (block == own) & (slot >= 0)
            sums[:, here] = blocks[own][:, slot[here]]
        columns = {c: batch.column(c) for c in batch.schema.names} | {"count_sum": pa.array(sums[0]), "n_best": pa.array(sums[1])}
        yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)


def align(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    indexed = index(docs, first, second, id_col, text_col)
    pairs = stored(pair_counts(indexed).select("pair", "b", F.col("n_links").alias("links")), "pairs")
    most = pairs.groupBy("b").agg(F.max("links").alias("most"))
    scored = pairs.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))
    postings = indexed.filter("pair is not null").select("pair", "block", "plane", "n", "dense", "docs").join(scored.hint("merge"), "pair").drop("pair")
    documents = indexed.filter("pair is null").select("block", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    by_block = documents.unionByName(postings, allowMissingColumns=True).repartition("block")
    return by_block.mapInArrow(_returned, _RETURNED)
