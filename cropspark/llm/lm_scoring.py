"""Scores of a context-tree weighting model over bytes, and of a unigram model over words.

The model. A byte is eight binary decisions, highest bit first; a decision is a node of the
byte's tree. For each node the contexts are the last 0 to `DEPTH` bytes (zeros before the
text). Every context of a node keeps how often each bit followed in the training texts, a
Krichevsky-Trofimov estimate of its bits, and the weighted probability: half the estimate plus
half the product over the contexts one byte longer. So the tree mixes all depths. A text is
scored with the trained tree held fixed: a decision's probability goes down the path of its
contexts, at each depth taking the posterior weight of the estimate and passing the rest on.

The work. A slice of texts is a sorted list of its distinct grams of `DEPTH` bytes of context and
a byte, cut by the last `SHALLOW` bytes of the context into compressed blocks, each for the task
that has all grams of those contexts. Blocks with counts are moved first; numpy works out the
contexts over `SHALLOW` bytes on the merged list. Above, node statistics go up the depths as
aggregations and weights come down as joins, one per depth, over distinct contexts. Then blocks that
also tell the texts of each gram are moved, in `ROUNDS` rounds over parts of the contexts: each
gram gets one number, the logarithm of its byte's probability, each block adds the numbers up for
its texts, and the sums of a slice's blocks are added up. What a round has moved is dropped when it
ends, so the disk holds the grams of one round at most. Grams of texts that are only scored have
count nil.

Words are counted by shuffles for the unigram model, and texts add up the numbers of their
words. The `CACHED` most frequent are sent to the tasks as flat arrays (at most 33 bytes each); the
rest is summed up per text and value, and joined on the shuffle. Both ways give the same sums,
whatever the share of each.

Defined results: null and empty texts have no bytes (score 0, bits per byte null) and one
token, the end; rows
without an id take part with the text "" in place of the id and are trained on; rows with one
id and text each give a row; without training texts every bit has probability one half; an
empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropspark.llm.frames import bound, stored
from cropspark.llm.text_arrays import Texts, slices, word_hashes
from cropspark.llm.worker_cache import kept

DEPTH = 8
SHALLOW = 4
CACHED = 1 << 21
SLICE_BYTES = 1 << 20
COUNT_WORDS = 1 << 20
COUNT_SLICE_BYTES = 8 << 20
ROUNDS = 3
KEY_BITS = 64
TABLE = 1 << 24
RANGE_GRAMS = 1 << 19
MIXED_ROWS = 1 << 20
PART_BYTES = 64 << 20
LEAST_PART_BYTES = 32 << 20
BATCH_ROWS = 1 << 16
UNIT = 2.0**-40
END = np.uint64(0x2545F4914F6CDD1D)


def tokens(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each word, A-Z in lower case, and of one end per text."""
    hashes, owner = word_hashes(part)
    return np.append(hashes, np.full(part.n, END)), np.append(owner, np.arange(part.n))


def _pieces(columns: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows as batches of at most `BATCH_ROWS`."""
    whole = pa.RecordBatch.from_arrays(columns, names=names)
    for at in range(0, whole.num_rows, BATCH_ROWS):
        yield whole.slice(at, BATCH_ROWS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind, value and training count of the distinct words of some slices, and the bytes of each batch."""

    def rows(kind: str, values: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from _pieces([pa.repeat(kind, len(values)), pa.array(values.view(np.int64)), pa.array(n)], ["kind", "value", "n"])

    def counts(words: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        held, own = (np.sort(np.concatenate(x)) for x in words)
        first = np.flatnonzero(_changes(own))
        values = own[first]
        yield from rows("word", values, np.diff(first, append=len(own)))
        held = held[_changes(held)]
        held = held[~np.isin(held, values, assume_unique=True)]
        yield from rows("word", held, np.zeros(len(held), np.int64))

    words, n = [[], []], 0
    for batch in batches:
        trained = batch.column(0).to_numpy(zero_copy_only=False)
        size = 0
        for part in slices(batch.column(1), SLICE_BYTES):
            values, owner = tokens(part)
            own = trained[part.first : part.first + part.n][owner]
            words[0].append(values[~own])
            words[1].append(values[own])
            n, size = n + len(values), size + len(part.data)
            if n >= COUNT_WORDS:
                yield from counts(words)
                words, n = [[], []], 0
        yield from rows("size", np.zeros(1, np.int64), np.array([size]))
    if n:
        yield from counts(words)


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(7) == 2
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), held_out.alias("held_out"))


def _log_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0, by Stirling's series eight places up."""
    y = x + F.lit(8.0)
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5))) - 1 / (1680 * F.pow(y, F.lit(7)))
    shift = F.lit(0.0)
    for k in range(8):
        shift = shift + F.log(x + F.lit(float(k)))
    return (y - 0.5) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + series - shift


def _log_estimate(zeros: Column, ones: Column) -> Column:
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones."""
    half = F.lit(0.5)
    value = _log_gamma(zeros + half) + _log_gamma(ones + half) - F.lit(math.log(math.pi)) - _log_gamma(zeros + ones + F.lit(1.0))
    return F.when(zeros + ones == 0, F.lit(0.0)).otherwise(value)


def _log_add(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def _log_rising(n: np.ndarray, start: float) -> np.ndarray:
    """ln of start (start + 1) ... for `n` factors, start being 0.5 or 1."""
    table = kept(("log rising", start), lambda: np.concatenate([[0.0], np.cumsum(np.log(np.arange(1 << 16) + start))]))
    out = table[np.minimum(n, 1 << 16)]
    large = np.flatnonzero(n > 1 << 16)
    x = n[large] + start
    out[large] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - math.lgamma(start)
    return out


def _estimates(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """`_log_estimate` of arrays; that of small counts is looked up."""

    def own(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
        return _log_rising(zeros, 0.5) + _log_rising(ones, 0.5) - _log_rising(zeros + ones, 1.0)

    table = kept(("log estimate",), lambda: own(np.arange(1 << 16) >> 8, np.arange(1 << 16) & 255))
    out = table[np.minimum(zeros, 255) << 8 | np.minimum(ones, 255)]
    large = np.flatnonzero((zeros | ones) > 255)
    out[large] = own(zeros[large], ones[large])
    return out


def _packed(numbers: list[int], arrays: list[np.ndarray]) -> bytes:
    """Numbers and arrays as one compressed block; equal bytes of the values of an array lie together."""
    head = np.array([*numbers, *[x for a in arrays for x in (len(a), a.itemsize)]], np.int64)
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays]
    whole = b"".join([head.tobytes(), *planes])
    return len(whole).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(whole, asbytes=True)


def _unpacked(block: bytes | pa.Buffer, n_numbers: int, kinds: str) -> tuple[list[int], list[np.ndarray]]:
    """The numbers, and the arrays, whose kinds are i, u or f."""
    block = memoryview(block)
    whole = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
    head = np.frombuffer(whole, np.int64, n_numbers + 2 * len(kinds)).tolist()
    at, out = 8 * len(head), []
    for size, width, kind in zip(head[n_numbers::2], head[n_numbers + 1 :: 2], kinds):
        planes = np.frombuffer(whole, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<{kind}{width}"))
        at += size * width
    return head[:n_numbers], out


def _narrow(values: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as they need."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


#: Of a block of grams, context by context: context, its grams, their bytes and training counts.
_COUNTS = "uuuu"
#: The same with what texts that are only scored add to the occurrences; then the text of each occurrence as a difference.
_GRAMS = "uuuuuu"
#: Of the block that tells the texts of a slice: ids, whether they are null, hashes of the texts.
_TEXTS = "iui"
_MIX = 1_000_003


def _part_of(top: np.ndarray, parts: int) -> np.ndarray:
    """The part of a context's last `SHALLOW` bytes, given as the upper half of the number."""
    return (top.astype(np.uint64) % np.uint64(_MIX)) % np.uint64(parts)


def _rounds() -> np.ndarray:
    """The round of each pair of the last bytes of a context."""
    return ((np.arange(1 << 16, dtype=np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(16)) % np.uint32(ROUNDS)).astype(np.uint8)


def _changes(values: np.ndarray) -> np.ndarray:
    """Where values begin that differ from the one before."""
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new


def _order(key: np.ndarray) -> np.ndarray:
    """What puts small numbers in order, the first of equal ones first."""
    bits = max(1, (len(key) - 1).bit_length())
    if int(key.max(initial=0)).bit_length() + bits > KEY_BITS - 1:
        return np.argsort(key, kind="stable")
    whole = key << bits
    whole |= np.arange(len(key))
    whole.sort()
    whole &= (1 << bits) - 1
    return whole


def _numbered(near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each pair of two-byte numbers among the distinct pairs in order, and those."""
    ranks, names = [], []
    for own in (near, far):
        there = np.zeros(1 << 16, bool)
        there[own] = True
        names.append(np.flatnonzero(there))
        ranks.append(np.cumsum(there, dtype=np.int32) - 1)
    size = len(names[1])
    kind = np.int32 if len(names[0]) * size <= TABLE else np.int64
    code = ranks[0].astype(kind)[near]
    code *= kind(size)
    code += ranks[1][far]
    if len(names[0]) * size <= TABLE:
        there = np.zeros(len(names[0]) * size, bool)
        there[code] = True
        distinct = np.flatnonzero(there)
        number = (np.cumsum(there, dtype=np.int32) - 1)[code]
    else:
        distinct = np.sort(code)
        distinct = distinct[_changes(distinct)]
        number = np.searchsorted(distinct, code)
    return number, names[0][distinct // size] << 16 | names[1][distinct % size]


class Slice:
    """The texts of a slice with `DEPTH` zeros before each; `pairs` holds the two bytes before each place."""

    def __init__(self, part: Texts):
        lengths = np.diff(part.offsets)
        self.n, self.data = part.n, np.zeros(len(part.data) + DEPTH * part.n, np.uint8)
        to = part.offsets + DEPTH * np.arange(1, part.n + 2)
        for a, b, at in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), to.tolist()):
            self.data[at : at + b - a] = part.data[a:b]
        self.pairs = np.zeros(len(self.data), np.uint16)
        self.pairs[2:] = self.data[1:-1]
        self.pairs[2:] <<= 8
        self.pairs[2:] |= self.data[:-2]
        kind = np.min_scalar_type(part.n)
        both = np.stack([np.full(part.n, part.n, kind), np.arange(part.n, dtype=kind)], axis=1).reshape(-1)
        self.owner = np.repeat(both, np.stack([np.full(part.n, DEPTH), lengths], axis=1).reshape(-1))
        self.round = np.where(self.owner == part.n, np.uint8(ROUNDS), _rounds()[self.pairs])


def gram_blocks(part: Slice, held_out: np.ndarray, parts: int, turn: int, texts: bool) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Part and arrays (`_GRAMS` or `_COUNTS`) of the distinct grams of a round of the slice, with or without their texts.

    Context, byte and text are put in order as one number of ranks, which sorts much faster than rows.
    """
    at = np.flatnonzero(part.round == turn)
    if not len(at):
        return
    text = part.owner[at]
    label = text.astype(np.uint64) if texts else held_out[text].astype(np.uint64)
    byte = part.data[at]
    near, tops = _numbered(part.pairs[at], part.pairs[at - 2])
    own = _part_of(tops, parts).astype(np.int64)
    by_part = np.argsort(own, kind="stable")
    rank = np.empty(len(tops), np.uint64)
    rank[by_part] = np.arange(len(tops))
    near, tops, own = rank[near], tops[by_part], own[by_part]
    far, ends = _numbered(part.pairs[at - 4], part.pairs[at - 6])
    del at, text
    far = far.astype(np.uint64)
    size = [np.uint64(max(1, (n - 1).bit_length())) for n in (len(ends), part.n if texts else 2)]
    if (len(tops) - 1).bit_length() + 8 + int(sum(size)) <= KEY_BITS:
        key = near
        for bits, more in ((size[0], far), (np.uint64(8), byte), (size[1], label)):
            key <<= bits
            key |= more
        del far, byte, label
        key.sort()
        label = (key & np.uint64((1 << int(size[1])) - 1)).astype(np.int32)
        key >>= size[1]
        first = np.flatnonzero(_changes(key))
        key = key[first]
        del near
        byte = key.astype(np.uint8)
        key >>= np.uint64(8)
        new = np.flatnonzero(_changes(key))
        near, far = (key >> size[0])[new], (key & np.uint64((1 << int(size[0])) - 1))[new]
    else:
        order = np.lexsort((label, byte, far, near))
        near, far, byte, label = near[order], far[order], byte[order], label[order].astype(np.int32)
        other = _changes(near) | _changes(far)
        first = np.flatnonzero(other | _changes(byte))
        new = np.flatnonzero(other[first])
        byte, near, far = byte[first], near[first[new]], far[first[new]]
    context = tops[near].astype(np.uint64) << np.uint64(32) | ends[far].astype(np.uint64)
    grams = np.diff(new, append=len(first))
    seen = np.diff(first, append=len(label))
    held = np.add.reduceat(held_out.astype(np.int8)[label] if texts else label, first, dtype=np.int64)
    if texts:
        step = np.diff(label, prepend=0)
        step[first] = label[first]
    edges = np.searchsorted(own[near], np.arange(parts + 1))
    rows, places = np.append(new, len(first))[edges], np.append(first, len(label))
    for p in np.flatnonzero(np.diff(edges)).tolist():
        a, b = rows[p], rows[p + 1]
        block = [context[edges[p] : edges[p + 1]], _narrow(grams[edges[p] : edges[p + 1]]), byte[a:b], _narrow(seen[a:b] - held[a:b])]
        yield p, [*block, _narrow(held[a:b]), _narrow(step[places[a] : places[b]])] if texts else block


_BLOCKS = "turn int, p int, kind int, data binary"
_TOLD, _COUNTED, _MIXED_IN = range(3)


def _block_row(turn: int, p: int, kind: int, data: bytes) -> pa.RecordBatch:
    numbers = [pa.array([x], pa.int32()) for x in (turn, p, kind)]
    return pa.RecordBatch.from_arrays([*numbers, pa.array([data], pa.binary())], names=["turn", "p", "kind", "data"])


def _count_blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Per slice of text and held_out the blocks of counts of all rounds."""
    for batch in batches:
        held_out = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for part in slices(batch.column(0), COUNT_SLICE_BYTES):
            whole, own = Slice(part), held_out[part.first : part.first + part.n]
            for turn in range(ROUNDS):
                for p, arrays in gram_blocks(whole, own, parts, turn, False):
                    yield _block_row(turn, p * ROUNDS + turn, _COUNTED, _packed([], arrays))


def _text_blocks(batches: Iterator[pa.RecordBatch], parts: int, turn: int) -> Iterator[pa.RecordBatch]:
    """Per slice its blocks of a round, and one that tells its texts (`_TEXTS`)."""
    number, task = count(), TaskContext.get().partitionId()
    for batch in batches:
        held_out = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        for part in slices(batch.column(1), COUNT_SLICE_BYTES):
            name = task << 32 | next(number)
            own = slice(part.first, part.first + part.n)
            ids = batch.column(0).slice(part.first, part.n)
            null = ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
            texts = [ids.fill_null(0).to_numpy(), null, batch.column(3).to_numpy()[own]]
            yield _block_row(turn, name % parts, _TOLD, _packed([name, part.n], texts))
            for p, arrays in gram_blocks(Slice(part), held_out[own], parts, turn, True):
                yield _block_row(turn, p, _COUNTED, _packed([name, part.n], arrays))


def merged(blocks: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context, byte and training count of the distinct grams of the blocks, in order; the number of each block's grams."""
    context, grams, byte = (np.concatenate([b[k] for b in blocks]) for k in range(3))
    n = np.concatenate([b[3].astype(np.int64) for b in blocks])
    distinct = np.sort(context)
    distinct = distinct[_changes(distinct)]
    key = np.repeat(np.searchsorted(distinct, context), grams) << 8
    key |= byte
    order = _order(key)
    key = key[order]
    new = _changes(key)
    first = np.flatnonzero(new)
    number = np.empty(len(key), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    key = key[first]
    return distinct[key >> 8], key.astype(np.uint8), np.add.reduceat(n[order], first, dtype=np.int64), number


class Depth:
    """The distinct pairs of a context of `depth` bytes and a byte, in order, with their training counts."""

    def __init__(self, context: np.ndarray, byte: np.ndarray, n: np.ndarray):
        self.context, self.byte, self.n = context, byte, n
        self.key = np.cumsum(_changes(context)) << 8
        self.key |= byte

    def shorter(self) -> tuple[Depth, np.ndarray]:
        """The pairs with contexts one byte shorter, and the number of the pair that each pair of these becomes."""
        context = self.context >> np.uint64(8)
        key = np.cumsum(_changes(context)) << 8
        key |= self.byte
        order = _order(key)
        new = _changes(key[order])
        first = np.flatnonzero(new)
        up = np.empty(len(key), np.int64)
        up[order] = np.cumsum(new) - 1
        own = order[first]
        return Depth(context[own], self.byte[own], np.add.reduceat(self.n[order], first)), up

    def nodes(self, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of one bit: the node of each pair; first pair, zeros and ones of each node."""
        new = _changes(self.key >> (8 - bit))
        first = np.flatnonzero(new)
        all_, ones = np.add.reduceat(self.n, first), np.add.reduceat(self.n * (self.byte >> (7 - bit) & 1), first)
        return np.cumsum(new) - 1, first, all_ - ones, ones


def deep_tree(context: np.ndarray, byte: np.ndarray, n: np.ndarray, mixed: tuple | None = None) -> Iterator[tuple]:
    """What the contexts over `SHALLOW` bytes give, bit by bit, for the sorted grams of some contexts of `SHALLOW` bytes.

    Without `mixed`: context, node, zeros, ones of each node of `SHALLOW` bytes, and the logarithm of the
    product over the contexts one byte longer. With the sorted (context, node) as one number, and what
    is left and mixed so far for a zero and a one there: the probability of the bit of each gram.
    """
    half = math.log(0.5)
    depths, ups = [Depth(context, byte, n)], []
    for _ in range(SHALLOW, DEPTH):
        shorter, up = depths[-1].shorter()
        depths.append(shorter)
        ups.append(up)
    for bit in range(8):
        below, parents, found = None, [], []
        for d, own in enumerate(depths):
            node, first, zeros, ones = own.nodes(bit)
            if d:
                parents.append(node[ups[d - 1][start]])
                below = np.bincount(parents[-1], w, len(first))
            start = first
            if d == len(depths) - 1:
                break
            e = _estimates(zeros, ones)
            if d:
                far = np.exp(-np.abs(below - e))
                w, stop = half + np.maximum(e, below) + np.log1p(far), np.where(below > e, far, 1.0) / (1.0 + far)
            else:
                w, stop = e, None
            found.append((zeros, ones, stop, node))
        top = depths[-1].context[first]
        name = (256 + depths[-1].byte[first].astype(np.int64)) >> (8 - bit)
        if mixed is None:
            yield top, name, zeros, ones, below
            continue
        at = np.searchsorted(mixed[0], top << np.uint64(8) | name.astype(np.uint64))
        left, q0, q1 = (x[at] for x in mixed[1:])
        for (zeros, ones, stop, node), parent in zip(reversed(found), reversed(parents)):
            left, q0, q1 = left[parent], q0[parent], q1[parent]
            share = (left if stop is None else left * stop) / (zeros + ones + 1.0)
            q0 = q0 + share * (zeros + 0.5)
            q1 = q1 + share * (ones + 0.5)
            left = left if stop is None else left - left * stop
        yield np.where(byte >> (7 - bit) & 1 == 1, q1[node], q0[node])


def _ranges(blocks: list[list[np.ndarray]]) -> Iterator[list[tuple[slice, slice]]]:
    """Where each block's contexts and grams of one range of contexts lie; no context of `SHALLOW` bytes is in two ranges."""
    sample = np.sort(np.concatenate([b[0][::16] for b in blocks]))
    n = sum(len(b[2]) for b in blocks) // RANGE_GRAMS + 1
    shift = np.uint64(8 * (DEPTH - SHALLOW))
    cuts = np.unique(sample[np.arange(1, n) * len(sample) // n] >> shift << shift)
    edges = [np.concatenate([[0], np.searchsorted(b[0], cuts), [len(b[0])]]) for b in blocks]
    grams = [np.append(0, np.cumsum(b[1], dtype=np.int64))[e].tolist() for b, e in zip(blocks, edges)]
    edges = [e.tolist() for e in edges]
    for k in range(len(cuts) + 1):
        if any(e[k] < e[k + 1] for e in edges):
            yield [(slice(e[k], e[k + 1]), slice(g[k], g[k + 1])) for e, g in zip(edges, grams)]


def _cut(blocks: list[list[np.ndarray]], places: list[tuple[slice, slice]]) -> list[list[np.ndarray]]:
    """Contexts, grams of each, bytes and counts of a range."""
    return [[b[0][i], b[1][i], b[2][j], b[3][j]] for b, (i, j) in zip(blocks, places)]


def _swapped(top: np.ndarray) -> np.ndarray:
    """A context of `SHALLOW` bytes with the byte just before in the lowest place, and the other way round."""
    return top.astype(np.uint32).byteswap().astype(np.int64)


_ABOVE = "context bigint, node int, zeros bigint, ones bigint, below double"
_MIXED_KINDS = "ufff"


def _above(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`deep_tree` of the grams of a part."""
    blocks = [_unpacked(data.as_buffer(), 0, _COUNTS)[1] for batch in batches for data in batch.column(3)]
    for places in _ranges(blocks) if blocks else ():
        context, byte, n, _ = merged(_cut(blocks, places))
        for top, node, zeros, ones, below in deep_tree(context, byte, n):
            columns = [_swapped(top), node.astype(np.int32), zeros, ones, below]
            yield from _pieces([pa.array(x) for x in columns], [x.split()[0] for x in _ABOVE.split(", ")])


def _mixed_blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Rows of `mixed_nodes` as blocks."""
    rounds = _rounds()

    def packed(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        top = _swapped(columns[0])
        p = _part_of(top, parts).astype(np.int64) * ROUNDS + rounds[top >> 16]
        order = np.argsort(p, kind="stable")
        p, top, node, left, q0, q1 = (x[order] for x in (p, top, *columns[1:]))
        name = top.astype(np.uint64) << np.uint64(8) | node.astype(np.uint64)
        edges = np.append(np.flatnonzero(_changes(p)), len(p)).tolist()
        for a, b in zip(edges, edges[1:]):
            yield _block_row(int(p[a]) % ROUNDS, int(p[a]) // ROUNDS, _MIXED_IN, _packed([], [x[a:b] for x in (name, left, q0, q1)]))

    held, rows = [], 0
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        rows += batch.num_rows
        if rows >= MIXED_ROWS:
            yield from packed([np.concatenate(x) for x in zip(*held)])
            held, rows = [], 0
    if rows:
        yield from packed([np.concatenate(x) for x in zip(*held)])


_SLICE_SUMS = "name bigint, texts boolean, data binary"


def _sum_row(name: int, texts: bool, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([texts]), pa.array([data], pa.binary())], names=["name", "texts", "data"])


def _slice_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block of grams the sums of its texts, in multiples of `UNIT`; blocks that tell a slice's texts are passed on."""
    names, grams, tables = [], [], []
    for batch in batches:
        for kind, data in zip(batch.column(2).to_pylist(), batch.column(3)):
            data = data.as_buffer()
            if kind == _TOLD:
                yield _sum_row(_unpacked(data, 2, _TEXTS)[0][0], True, data.to_pybytes())
            elif kind == _MIXED_IN:
                tables.append(_unpacked(data, 0, _MIXED_KINDS)[1])
            else:
                own, arrays = _unpacked(data, 2, _GRAMS)
                names.append(own)
                grams.append(arrays)
    if not grams:
        return
    table = [np.concatenate(x) for x in zip(*tables)]
    order = np.argsort(table[0])
    mixed = tuple(x[order] for x in table)
    sums, done = [np.zeros(size) for _, size in names], [0] * len(names)
    for places in _ranges(grams):
        own = _cut(grams, places)
        context, byte, n, number = merged(own)
        value = np.zeros(len(n))
        for probability in deep_tree(context, byte, n, mixed):
            value += np.log10(probability)
        at = 0
        for k, ((_, _, bytes_, trained), (_, rows), (*_, held, step)) in enumerate(zip(own, places, grams)):
            if not len(bytes_):
                continue
            seen = trained.astype(np.int64) + held[rows]
            step = step[done[k] : done[k] + int(seen.sum())]
            text, first = np.cumsum(step, dtype=np.int64), np.cumsum(seen) - seen
            text -= np.repeat(text[first] - step[first], seen)
            sums[k] += np.bincount(text, np.repeat(value[number[at : at + len(seen)]], seen), len(sums[k]))
            at, done[k] = at + len(seen), done[k] + len(step)
    for (name, _), own in zip(names, sums):
        yield _sum_row(name, False, _packed([], [np.rint(own / UNIT).astype(np.int64)]))


_SCORES = "doc_id bigint, row bigint, score double"


def _text_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, row and score of each text of the slices."""
    told, sums = {}, {}
    for batch in batches:
        for name, texts, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if texts:
                told[name] = _unpacked(data.as_buffer(), 2, _TEXTS)[1]
            else:
                own = _unpacked(data.as_buffer(), 0, "i")[1][0]
                sums[name] = sums[name] + own if name in sums else own
    for name, (ids, null, row) in told.items():
        own = sums.get(name, np.zeros(len(ids))) * UNIT
        yield from _pieces([pa.array(ids, mask=null == 1), pa.array(row), pa.array(own)], [x.split()[0] for x in _SCORES.split(", ")])


def mixed_nodes(solved: DataFrame) -> DataFrame:
    """(context, node, left, q0, q1): what the depths up to `SHALLOW` give in each node of `SHALLOW` bytes, and the weight left."""
    half = math.log(0.5)
    estimate = _log_estimate(F.col("zeros"), F.col("ones"))
    mixed = F.lit(half) + _log_add(F.col("e"), F.col("below"))
    # a context nobody was trained on has estimate and product one
    weighted = F.when(F.col("zeros") + F.col("ones") == 0, F.lit(0.0)).otherwise(mixed)
    level = solved.withColumn("e", estimate)
    levels = [stored(level.withColumn("w", weighted).drop("below", "e"), f"context-{SHALLOW}")]
    for depth in reversed(range(SHALLOW)):
        mask = (1 << (8 * depth)) - 1
        up = (
            levels[-1]
            .groupBy(F.col("context").bitwiseAND(F.lit(mask)).alias("context"), "node")
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("w").alias("below"))
            .withColumn("e", estimate)
        )
        levels.append(stored(up.withColumn("w", weighted).drop("below", "e"), f"context-{depth}"))
    down = None
    for depth, own in enumerate(reversed(levels)):
        total = F.col("zeros") + F.col("ones") + F.lit(1.0)
        weight = F.exp(F.lit(half) + F.col("e") - F.col("w"))
        rows = own.withColumn("e", estimate).select("context", "node", weight.alias("weight"), ((F.col("zeros") + 0.5) / total).alias("p0"), ((F.col("ones") + 0.5) / total).alias("p1"))
        if down is None:
            above = rows.withColumn("left", F.lit(1.0)).withColumn("q0", F.lit(0.0)).withColumn("q1", F.lit(0.0))
        else:
            mask = (1 << (8 * (depth - 1))) - 1
            parent = down.select(F.col("context").alias("parent"), "node", "left", "q0", "q1")
            above = rows.withColumn("parent", F.col("context").bitwiseAND(F.lit(mask))).join(parent, ["parent", "node"])
        share = F.col("left") * F.col("weight")
        down = above.select(
            "context", "node", (F.col("left") * (F.lit(1.0) - F.col("weight"))).alias("left"),
            (F.col("q0") + share * F.col("p0")).alias("q0"), (F.col("q1") + share * F.col("p1")).alias("q1"),
        )
        down = stored(down, f"mixed-{depth}") if depth < SHALLOW else down
    return down


def gram_scores(rows: DataFrame, parts: int) -> DataFrame:
    """(doc_id, row, score) per doc_id and row (a hash of the text) of doc_id, text, held_out and row."""
    counts = rows.select("text", "held_out").mapInArrow(lambda b: _count_blocks(b, parts), _BLOCKS)
    solved = counts.repartitionById(parts * ROUNDS, F.col("p")).mapInArrow(_above, _ABOVE)
    nodes = mixed_nodes(solved)
    mixed = stored(nodes.mapInArrow(lambda b: _mixed_blocks(b, parts), _BLOCKS), "mixed")
    own = rows.select("doc_id", "text", "held_out", "row")
    scores = []
    for turn in range(ROUNDS):
        blocks = own.mapInArrow(lambda b, turn=turn: _text_blocks(b, parts, turn), _BLOCKS).union(mixed.filter(F.col("turn") == turn))
        sums = blocks.repartitionById(parts, F.col("p")).mapInArrow(_slice_sums, _SLICE_SUMS)
        texts = sums.repartition(parts, "name").mapInArrow(_text_sums, _SCORES)
        scores.append(stored(texts.groupBy("doc_id", "row").agg(F.first("score").alias("score")), f"scores-{turn}"))
    return reduce(DataFrame.union, scores).groupBy("doc_id", "row").agg(F.sum("score").alias("score"))


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a job shuffles goes when the job has ended, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _summed(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """Per text the sums over cached words, and the words that are not cached."""
    keys, numbers, known = sent.value
    for batch in batches:
        for part in slices(batch.column(1), SLICE_BYTES):
            values, owner = tokens(part)
            codes, distinct = pd.factorize(values)
            order = np.argsort(distinct)
            at = np.empty(len(distinct), np.int64)
            at[order] = np.searchsorted(keys, distinct[order])
            hit = np.zeros(len(distinct), bool)
            if len(keys):
                at = np.minimum(at, len(keys) - 1)
                hit = keys[at] == distinct
            number = np.where(hit, numbers[at] if len(keys) else 0.0, 0.0)
            seen = np.where(hit, known[at] if len(keys) else False, False)
            base = np.bincount(owner, number[codes], part.n).astype(np.float64)  # of no rows it is int
            n_known = np.bincount(owner, seen[codes], part.n).astype(np.int64)
            n = np.bincount(owner, minlength=part.n).astype(np.int64)
            ids, held, row = (batch.column(k).slice(part.first, part.n) for k in (0, 2, 3))
            yield pa.RecordBatch.from_arrays(
                [ids, held, row, pa.nulls(part.n, pa.int64()), pa.array(np.diff(part.offsets)), pa.array(n), pa.array(n_known), pa.array(base)],
                names=_SUM_NAMES,
            )
            missed = np.flatnonzero(~hit[codes])
            if len(missed):
                pairs, times = np.unique(owner[missed] * len(distinct) + codes[missed], return_counts=True)
                own = pa.array(pairs // len(distinct))
                yield from _pieces(
                    [
                        ids.take(own), held.take(own), row.take(own), pa.array(distinct[pairs % len(distinct)].view(np.int64)),
                        pa.nulls(len(own), pa.int64()), pa.array(times), pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.float64()),
                    ],
                    names=_SUM_NAMES,
                )


_SUMS = "doc_id bigint, held_out boolean, row bigint, value bigint, n_bytes bigint, n bigint, n_known bigint, base_score double"
_SUM_NAMES = [x.split()[0] for x in _SUMS.split(", ")]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cached: int = CACHED) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte per row."""
    with _shuffles_freed(docs.sparkSession):
        return _scored(docs, id_col, text_col, cached)


def _scored(docs: DataFrame, id_col: str, text_col: str, cached: int) -> DataFrame:
    spark = docs.sparkSession
    rows = _prepared(docs, id_col, text_col)
    found = rows.select((~F.col("held_out")).alias("trained"), "text").mapInArrow(_counted, "kind string, value bigint, n bigint")
    counts = stored(found.groupBy("kind", "value").agg(F.sum("n").alias("n")), "counts")
    words = counts.filter("kind = 'word'")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    below = math.log10(total[0] + total[1] + 1)
    size = counts.filter("kind = 'size'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_parts = max(math.ceil(size / PART_BYTES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / LEAST_PART_BYTES)), 1)
    numbers = words.select("value", "n", (F.log10(F.col("n") + F.lit(1.0)) - F.lit(below)).alias("log10"))
    top = numbers.orderBy(F.desc("n"), "value").limit(cached).toArrow()
    values = top.column(0).to_numpy().view(np.uint64)
    order = np.argsort(values)
    sent = spark.sparkContext.broadcast((values[order], top.column(2).to_numpy()[order], top.column(1).to_numpy()[order] > 0))
    marked = rows.select("doc_id", "text", "held_out", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"))
    parts = stored(marked.mapInArrow(lambda b: _summed(b, sent), _SUMS), "sums")
    key = ["doc_id", "row"]
    missing = parts.filter("value is not null").select(*key, "value", F.col("n").alias("times")).distinct()
    rest = missing.join(numbers, "value").groupBy(*key).agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.col("log10")).alias("more_base"),
    )
    whole = parts.filter("value is null").drop("value").alias("x")
    same = F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.row") == F.col("y.row"))
    by_gram = gram_scores(marked, n_parts)
    scores = F.col("x.doc_id").eqNullSafe(F.col("z.doc_id")) & (F.col("x.row") == F.col("z.row"))
    joined = whole.join(rest.alias("y"), same, "left").join(by_gram.alias("z"), scores)

    def plus(name: str, more: str, zero: object) -> Column:
        return F.col(f"x.{name}") + F.coalesce(F.col(f"y.{more}"), F.lit(zero))

    scored = joined.select(
        "x.doc_id", "x.held_out", F.col("x.n").alias("n_tokens"), plus("n_known", "more_known", 0).alias("n_known"),
        F.lit(total[0]).cast("bigint").alias("train_tokens"), plus("base_score", "more_base", 0.0).alias("base_score"), "z.score", "x.n_bytes",
    )
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") * F.lit(math.log2(10)) / F.col("n_bytes"))
    return scored.withColumn("bits_per_byte", bits)
