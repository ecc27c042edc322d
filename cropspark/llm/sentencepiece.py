"""SentencePiece encoding and decoding by a lattice of pieces for each distinct word of a task.

Encoding. A text gets a blank in front, and is cut before each run of blanks that follows
another character: no piece lies across such a cut, so words can be encoded on their own. A task
encodes each distinct word of its texts once; nothing is shuffled, collected or broadcast but the
piece table, which is bounded by the model file:

* an Arrow pass numbers the words. The substrings of new words, up to the longest piece, are
  exploded as arrays and equi-joined to the piece table by hash; what is found is the word's
  lattice.
* for a unigram model the words go on in rows of `WORDS`, ahead of the rows whose texts hold them,
  and the lattices are folded with `aggregate`. This is Viterbi: the best sum of scores for each
  end, the longer last piece where sums are equal, then the way back. A second Arrow pass, in the
  same task and order, puts the texts' ids together.
* scores of a BPE model are ranks of merges, whose best sum is not what such a model means, so its
  lattices are folded by merges: from single characters on, step by step, the best-ranked piece that
  joins two neighbours, the leftmost of equals. All new words of a length take a step at once, as
  arrays, and the same pass puts the texts' ids together.
* a character without a piece stands for the unknown piece, written as byte pieces if the model has
  them. The ids of the words so far are kept (about 20 bytes a word of the partition).
* words of over `LONG` characters take the same rule in plain Python, where a step doesn't cost
  the length of the word, as do words that hold joined pieces of one score (runs of blanks).

Decoding puts the pieces' bytes together and takes the first blank away.

The result is that of the library for the model. (Its unigram sums are 32-bit, so it may
differ where a text mixes scores of very different sizes.)

Defined results: null or empty texts have no ids; the sign U+2581 counts as a blank, so it is
decoded as one; equal rows each give a row; an empty table gives no rows; other columns are
passed through, whatever their names, but one named like the result is replaced by it.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from cropspark.llm.frames import bound
from cropspark.llm.text_arrays import Texts, as_binary, gram, slices

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
LONG = 64
#: Words of a row, and rows of a batch, on their way to the fold and back.
WORDS = 128
ROWS = 64
_NONE = 2**31 - 1
_SLOTS = 1 << 18
SLICE_BYTES = 1 << 19


@dataclass(frozen=True)
class Model:
    """What encoding and decoding need of a model file."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    usable: tuple[bool, ...]
    byte_ids: tuple[int, ...]
    unknown: int
    unknown_score: float
    merges: bool

    @functools.cached_property
    def longest(self) -> int:
        return max((len(p) for p, ok in zip(self.pieces, self.usable) if ok), default=1)

    def ids_of_unknown(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]


def load_model(path: str) -> Model:
    """Read a SentencePiece model file with identity normalisation and a blank put in front."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    kind = proto.ModelProto.SentencePiece
    spec = model.normalizer_spec
    if spec.name != "identity" or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only identity normalisation with a blank in front is supported")
    pieces = model.pieces
    by_byte = {p.piece: i for i, p in enumerate(pieces) if p.type == kind.BYTE}
    normal = [p.score for p in pieces if p.type == kind.NORMAL]
    return Model(
        pieces=tuple(p.piece for p in pieces),
        scores=tuple(float(p.score) for p in pieces),
        usable=tuple(p.type in (kind.NORMAL, kind.USER_DEFINED) for p in pieces),
        byte_ids=tuple(by_byte[f"<0x{b:02X}>"] for b in range(256)) if by_byte else (),
        unknown=next(i for i, p in enumerate(pieces) if p.type == kind.UNKNOWN),
        unknown_score=min(normal, default=0.0) - UNKNOWN_PENALTY,
        merges=model.trainer_spec.model_type == proto.TrainerSpec.BPE,
    )


def viterbi(word: str, model: Model, table: dict[str, tuple[int, float]]) -> list[int]:
    """The best segmentation of one word by the recurrence of the fold."""
    best, back, longest = [0.0], [None], model.longest
    for end in range(1, len(word) + 1):
        found = None
        for start in range(max(0, end - longest), end):
            piece = table.get(word[start:end])
            if piece is None and end - start == 1:
                piece = (-1, model.unknown_score)
            if piece is not None and (found is None or best[start] + piece[1] > found[0]):
                found = (best[start] + piece[1], start, piece[0])
        best.append(found[0])
        back.append(found[1:])
    out, at = [], len(word)
    while at:
        start, piece = back[at]
        out.append(model.ids_of_unknown(word[start:at]) if piece < 0 else [piece])
        at = start
    return [i for ids in reversed(out) for i in ids]


def merged(word: str, model: Model, table: dict[str, tuple[int, float]]) -> list[int]:
    """One word by merges: the best-scored join of two neighbours first, the leftmost of equals."""
    after, before, agenda = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1)), []

    def offer(at: int) -> None:
        if at >= 0 and after[at] < len(word):
            joined = table.get(word[at : after[after[at]]]) if after[after[at]] - at <= model.longest else None
            if joined is not None:
                heapq.heappush(agenda, (-joined[1], at, after[after[at]]))

    for at in range(len(word) - 1):
        offer(at)
    alive = [True] * len(word)
    while agenda:
        _, at, end = heapq.heappop(agenda)
        middle = after[at]
        if not alive[at] or middle >= len(word) or after[middle] != end:
            continue
        alive[middle], after[at] = False, end
        if end < len(word):
            before[end] = at
        offer(before[at])
        offer(at)
    out, at = [], 0
    while at < len(word):
        piece = table.get(word[at : after[at]])
        out += model.ids_of_unknown(word[at : after[at]]) if piece is None else [piece[0]]
        at = after[at]
    return out


def _in_front(part: Texts) -> Texts:
    """The slice with a blank in front of each text that isn't empty, U+2581 as a blank."""
    texts = [part.text(i) for i in range(part.n)]
    texts = [b" " + t.replace(BLANK.encode(), b" ") if t else t for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return Texts(np.frombuffer(b"".join(texts), np.uint8), offsets, part.first)


def _word_starts(part: Texts) -> np.ndarray:
    blank = part.data == 32
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    start[part.offsets[:-1][np.diff(part.offsets) > 0]] = True
    return np.flatnonzero(start)


def _hashes(part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = _word_starts(part)
    ends = np.append(starts[1:], len(part.data)) if len(starts) else starts
    return gram(part.prefix(), starts, ends), starts, ends


def _fold(n: Column, edges: Column) -> Column:
    """Ids of the best path over edges (e, s, score, ids) of a word of n characters."""

    def step(state: Column, end: Column) -> Column:
        into = F.filter(edges, lambda x: x["e"] == end)
        ways = F.transform(into, lambda x: F.struct((F.get(state["best"], x["s"]) + x["score"]).alias("t"), (-x["s"]).alias("s"), x["ids"].alias("ids")))
        return bound(
            F.array_max(ways),
            lambda m: F.struct(
                F.concat(state["best"], F.array(m["t"])).alias("best"),
                F.concat(state["back"], F.array(F.struct((-m["s"]).alias("s"), m["ids"].alias("ids")))).alias("back"),
            ),
        )

    def back(states: Column) -> Column:
        def walk(state: Column, _: Column) -> Column:
            own = F.get(states, state["at"] - F.lit(1))
            moved = F.struct(own["s"].alias("at"), F.concat(own["ids"], state["ids"]).alias("ids"))
            return F.when(state["at"] == 0, state).otherwise(moved)

        start = F.struct(n.alias("at"), F.array().cast("array<int>").alias("ids"))
        return F.aggregate(F.sequence(F.lit(1), n), start, walk)["ids"]

    nothing = F.struct(F.array(F.lit(0.0)).alias("best"), F.array().cast("array<struct<s:int,ids:array<int>>>").alias("back"))
    return bound(F.aggregate(F.sequence(F.lit(1), n), nothing, step)["back"], back)


def _merge_fold(lattice: np.ndarray, base: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pieces of words of `n` characters, one after the other, and their numbers.

    At `base + start * n + end` the lattice holds the place in the order of merges of the piece
    between the two, `_NONE` if there is none. The words of one length that are not done have
    equally many cuts, since a step takes one out of each.
    """
    sizes, found = np.zeros(len(n), np.int64), []
    for length in np.unique(n).tolist():
        words = np.flatnonzero(n == length)
        cuts = np.broadcast_to(np.arange(length + 1, dtype=np.int32), (len(words), length + 1))
        while len(words):
            row, left = base[words, None], cuts.shape[1]
            if left > 2:
                # for each cut, the piece from there over the next cut to the one after it
                joins = lattice[row + cuts[:, :-2] * length + cuts[:, 2:]]
                first = joins.argmin(1)
                more = joins[np.arange(len(words)), first] < _NONE
            else:
                first, more = np.zeros(len(words), np.int64), np.zeros(len(words), bool)
            done = ~more
            sizes[words[done]] = left - 1
            found.append((words[done], lattice[row[done] + cuts[done, :-1] * length + cuts[done, 1:]]))
            kept = np.arange(left) != first[more, None] + 1
            words, cuts = words[more], cuts[more][kept].reshape(np.count_nonzero(more), max(left - 1, 0))
    ends, values = np.cumsum(sizes), np.empty(int(sizes.sum()), np.int32)
    for words, places in found:
        values[(ends - sizes)[words, None] + np.arange(places.shape[1])] = places
    return values, sizes


class _Pieces:
    """The piece table by hash, in the order of merges: the relation that substrings are joined to."""

    def __init__(self, model: Model):
        rows = [(p, i, s) for i, (p, s, ok) in enumerate(zip(model.pieces, model.scores, model.usable)) if ok]
        rows.sort(key=lambda r: -r[2])
        data = [p.replace(BLANK, " ").encode() for p, _, _ in rows]
        ends = np.cumsum([0, *map(len, data)])
        part = Texts(np.frombuffer(b"".join(data), np.uint8), ends, 0)
        self.table = {p: (i, s) for p, i, s in rows}
        self.hashes = gram(part.prefix(), ends[:-1], ends[1:])
        self.ids = np.array([i for _, i, _ in rows], np.int32)
        self.scores = np.array([s for _, _, s in rows])
        self.longest = model.longest
        #: pieces of equal score join from left to right, which places in an order can't tell
        _, of_score, shared = np.unique(self.scores, return_inverse=True, return_counts=True)
        self.tied = model.merges & (shared[of_score] > 1) & np.array([len(p) > 1 for p, _, _ in rows])
        # slots by some bits of the hash; a piece whose slot is taken goes to the next table
        self.tables, left, shift = [], np.arange(len(rows)), 0
        while len(left):
            slots = (self.hashes[left] >> np.uint64(shift)) & np.uint64(_SLOTS - 1)
            _, first = np.unique(slots, return_index=True)
            table = np.zeros(_SLOTS, np.int32)
            table[slots[first]] = left[first]
            self.tables.append((np.uint64(shift), table))
            left, shift = np.delete(left, first), (shift + 7) % 46

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash in the table, -1 if it has none."""
        found = np.full(len(hashes), -1, np.int32)
        for shift, table in self.tables:
            at = table[(hashes >> shift) & np.uint64(_SLOTS - 1)]
            np.copyto(found, at, where=self.hashes[at] == hashes)
        return found


_EDGE = pa.struct([("e", pa.int32()), ("s", pa.int32()), ("score", pa.float64()), ("ids", pa.list_(pa.int32()))])
_WORD = pa.struct([("n", pa.int32()), ("edges", pa.list_(_EDGE)), ("ids", pa.list_(pa.int32()))])


def _lattices(words: list[bytes], model: Model, pieces: _Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """The lattices of the words, where each begins, its size, the words' characters, and ids of some.

    Words that are long or hold tied pieces have ids; the long ones have no lattice.
    """
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    # where each character begins; starts and ends of substrings are among these
    edge = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    last = np.searchsorted(edge[:-1], ends)  # one past the characters of each word
    n = np.diff(last, prepend=0)
    plain = n > LONG
    square = np.where(plain, 0, n * n + 1)
    base = np.cumsum(square) - square
    of_char = np.repeat(np.arange(len(words)), n)
    at = np.arange(len(of_char)) - np.repeat(last - n, n)
    left, row = n[of_char] - at, base[of_char] + at * (n[of_char] + 1)
    sums = Texts(data, np.array([0, len(data)]), 0).prefix()
    lattice = np.full(int(square.sum()), _NONE, np.int32)
    own, tied = np.flatnonzero(~plain[of_char]), []
    for length in range(1, min(pieces.longest, int(n.max(initial=0))) + 1):
        own = own[left[own] >= length]
        found = pieces.find(gram(sums, edge[own], edge[own + length]))
        lattice[row[own] + length] = np.where(found < 0, _NONE, found)
        tied.append(of_char[own[(found >= 0) & pieces.tied[found]]])
        if length == 1:
            for k in own[found < 0].tolist():
                lattice[row[k] + 1] = -1 - ord(data[edge[k] : edge[k + 1]].tobytes().decode("utf-8", "replace"))
    ids = [None] * len(words)
    for i in np.unique(np.concatenate([np.flatnonzero(plain), *tied])).tolist():
        ids[i] = (merged if model.merges else viterbi)(words[i].decode("utf-8", "replace").replace(" ", BLANK), model, pieces.table)
    return lattice, base, square, n, ids


def _words(words: list[bytes], model: Model, pieces: _Pieces) -> pa.Array:
    """One `_WORD` per word, for the fold by Viterbi."""
    lattice, base, square, n, ids = _lattices(words, model, pieces)
    edges = [_edges(lattice[b : b + q], k, model, pieces) if q else [] for b, q, k in zip(base.tolist(), square.tolist(), n.tolist())]
    columns = [pa.array(n.astype(np.int32)), pa.array(edges, pa.list_(_EDGE)), pa.array(ids, pa.list_(pa.int32()))]
    return pa.StructArray.from_arrays(columns, names=["n", "edges", "ids"])


def _merged_words(words: list[bytes], model: Model, pieces: _Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words by merges, one after the other, and their numbers."""
    lattice, base, _, n, ids = _lattices(words, model, pieces)
    own = np.array([k for k, i in enumerate(ids) if i is None], np.int64)
    flat, sizes = _spelled(*_merge_fold(lattice, base[own], n[own]), model, pieces)
    if len(own) == len(words):
        return flat, sizes
    parts, begin = [np.array(i, np.int32) if i is not None else None for i in ids], np.cumsum(sizes) - sizes
    for k, b, size in zip(own.tolist(), begin.tolist(), sizes.tolist()):
        parts[k] = flat[b : b + size]
    return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)


def _edges(lattice: np.ndarray, n: int, model: Model, pieces: _Pieces) -> list[dict]:
    """The lattice of a word as edges with scores, for the fold by Viterbi."""
    out = []
    for k in np.flatnonzero(lattice != _NONE).tolist():
        s, e, found = (k - 1) // n, (k - 1) % n + 1, int(lattice[k])
        known = found >= 0
        ids = [int(pieces.ids[found])] if known else model.ids_of_unknown(chr(-1 - found))
        out.append({"e": e, "s": s, "score": float(pieces.scores[found]) if known else model.unknown_score, "ids": ids})
    return out


class _Numbers:
    """Numbers for the distinct words of a task, by their hashes: a few bytes a word."""

    def __init__(self):
        self.known, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def of(self, part: Texts) -> tuple[np.ndarray, np.ndarray, Iterator[list[bytes]]]:
        """Numbers of the words of the texts, where those of each text end, and the new words in lists."""
        hashes, starts, ends = _hashes(part)
        found, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, found)
        old = np.append(self.known, np.uint64(0))[place] == found
        old &= place < len(self.known)
        fresh, number = np.flatnonzero(~old), np.empty(len(found), np.int32)
        number[old] = self.numbers[place[old]]
        number[fresh] = np.arange(len(self.known), len(self.known) + len(fresh))
        self.known, self.numbers = np.insert(self.known, place[fresh], found[fresh]), np.insert(self.numbers, place[fresh], number[fresh])

        def new() -> Iterator[list[bytes]]:
            for at in range(0, len(fresh), WORDS * ROWS):
                own = first[fresh[at : at + WORDS * ROWS]]
                yield [part.data[a:b].tobytes() for a, b in zip(starts[own].tolist(), ends[own].tolist())]

        return number[inverse], np.searchsorted(starts, part.offsets).astype(np.int32), new()


def _numbered(batches: Iterator[pa.RecordBatch], column: int, model: Model) -> Iterator[pa.RecordBatch]:
    """The rows with their texts as word numbers, and before them rows with the lattices of new words."""
    pieces, numbers = _Pieces(model), _Numbers()
    for batch in batches:
        kinds = [f.type for f in batch.schema]
        names = [*batch.schema.names, "codes", "words"]
        for raw in slices(batch.column(column), SLICE_BYTES):
            codes, per_text, new = numbers.of(_in_front(raw))
            for words in new:
                cuts = np.append(np.arange(0, len(words), WORDS), len(words)).astype(np.int32)
                rows = len(cuts) - 1
                lists = [pa.nulls(rows, pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array(cuts), _words(words, model, pieces))]
                yield pa.RecordBatch.from_arrays([*[pa.nulls(rows, k) for k in kinds], *lists], names=names)
            own = batch.slice(raw.first, raw.n)
            lists = [pa.ListArray.from_arrays(pa.array(per_text), pa.array(codes)), pa.nulls(raw.n, pa.list_(_WORD))]
            yield pa.RecordBatch.from_arrays([*own.columns, *lists], names=names)


def _by_merges(batches: Iterator[pa.RecordBatch], column: int, model: Model) -> Iterator[pa.RecordBatch]:
    """The rows with the ids of their texts, of a model of merges."""
    pieces, numbers, known = _Pieces(model), _Numbers(), _Known()
    for batch in batches:
        for raw in slices(batch.column(column), SLICE_BYTES):
            codes, per_text, new = numbers.of(_in_front(raw))
            for words in new:
                known.add(*_merged_words(words, model, pieces))
            for at in range(0, raw.n, ROWS):
                ends = per_text[at : at + ROWS + 1]
                ids, total = known.of(codes[ends[0] : ends[-1]])
                found = pa.ListArray.from_arrays(pa.array(total[ends - ends[0]].astype(np.int32)), pa.array(ids))
                own = batch.slice(raw.first + at, len(ends) - 1)
                yield pa.RecordBatch.from_arrays([*own.columns, found], names=[*batch.schema.names, "ids"])


class _Known:
    """The ids of the words of a task so far, one after the other."""

    def __init__(self):
        self.flat, self.ends, self.n = np.zeros(1 << 12, np.int32), np.zeros(1 << 10, np.int64), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        used = int(self.ends[self.n])
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(sizes) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[used : used + len(ids)] = ids
        self.ends[self.n + 1 : self.n + 1 + len(sizes)] = used + np.cumsum(sizes)
        self.n += len(sizes)

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, one after the other, and where those of each end."""
        begin, size = self.ends[codes], self.ends[codes + 1] - self.ends[codes]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.flat[np.repeat(begin - total[:-1], size) + np.arange(total[-1])], total


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Known()
    for batch in batches:
        lists, codes = batch.column("words"), batch.column("codes")
        is_text = codes.is_valid().to_numpy(zero_copy_only=False)
        # runs of word rows and of text rows, in the order in which they came
        cuts = np.append(np.flatnonzero(np.diff(is_text, prepend=~is_text[:1])), len(is_text)).tolist()
        for a, b in zip(cuts, cuts[1:]):
            if not is_text[a]:
                ids = lists.slice(a, b - a).flatten()
                known.add(ids.flatten().to_numpy(zero_copy_only=False), _sizes(ids))
                continue
            for at in range(a, b, ROWS):
                own = codes.slice(at, min(ROWS, b - at))
                ids, total = known.of(own.flatten().to_numpy(zero_copy_only=False))
                ends = total[np.concatenate([[0], np.cumsum(_sizes(own))])].astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
                columns = [batch.column(i).slice(at, len(own)) for i in range(batch.num_columns - 2)]
                yield pa.RecordBatch.from_arrays([*columns, found], names=[*batch.schema.names[:-2], "ids"])


def _spelled(values: np.ndarray, sizes: np.ndarray, model: Model, pieces: _Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids and number of ids of each word from merges: places become ids, unknown characters their bytes."""
    if not len(values) or values.min() >= 0:
        return pieces.ids[values], sizes
    bytes_of = {int(v): model.ids_of_unknown(chr(-1 - int(v))) for v in np.unique(values[values < 0])}
    longer = np.ones(len(values), np.int64)
    for v, own in bytes_of.items():
        longer[values == v] = len(own)
    ids = np.repeat(pieces.ids[np.maximum(values, 0)], longer)
    begin = np.cumsum(longer) - longer
    for k in np.flatnonzero(values < 0).tolist():
        ids[begin[k] : begin[k] + longer[k]] = bytes_of[int(values[k])]
    return ids, np.bincount(np.repeat(np.arange(len(sizes)), sizes), longer, len(sizes)).astype(np.int64)


def encode(docs: DataFrame, model: Model, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The rows of `docs` with the ids of their texts in `ids_col`."""
    at = docs.columns.index(text_col)
    inner = [f"c{i}" for i in range(len(docs.columns))]
    fields = [T.StructField(c, f.dataType) for c, f in zip(inner, docs.schema)]
    done = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    texts = docs.toDF(*inner)
    if model.merges:
        rows = texts.mapInArrow(lambda batches: _by_merges(batches, at, model), done)
    else:
        more = [T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("words", T.ArrayType(from_arrow_type(_WORD)))]
        numbered = texts.mapInArrow(lambda batches: _numbered(batches, at, model), T.StructType(fields + more))
        word = lambda w: F.when(w["ids"].isNull(), _fold(w["n"], w["edges"])).otherwise(w["ids"])
        rows = numbered.withColumn("words", F.transform("words", word)).select(*inner, "words", "codes").mapInArrow(_put_together, done)
    kept = [i for i, c in enumerate(docs.columns) if c.lower() != ids_col.lower()]
    return rows.select(*[inner[i] for i in kept], "ids").toDF(*[docs.columns[i] for i in kept], ids_col)


def _piece_bytes(model: Model) -> tuple[np.ndarray, np.ndarray]:
    byte_of = {i: bytes([b]) for b, i in enumerate(model.byte_ids)}
    shown = {model.unknown: " ⁇ ".encode()}
    parts = [byte_of.get(i) or shown.get(i) or (p.replace(BLANK, " ").encode() if ok else b"") for i, (p, ok) in enumerate(zip(model.pieces, model.usable))]
    return np.concatenate([[0], np.cumsum([len(p) for p in parts])]), np.frombuffer(b"".join(parts), np.uint8)


def _decoded(batches: Iterator[pa.RecordBatch], column: int, model: Model) -> Iterator[pa.RecordBatch]:
    places, data = _piece_bytes(model)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            own = batch.slice(at, 256)
            lists = own.column(column)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            if len(ids) and (ids.min() < 0 or ids.max() >= len(places) - 1):
                raise ValueError("an id is outside the model")
            size = places[ids + 1] - places[ids]
            total = np.concatenate([[0], np.cumsum(size)])
            flat = data[np.repeat(places[ids] - total[:-1], size) + np.arange(total[-1])].tobytes()
            counts = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
            ends = total[np.concatenate([[0], np.cumsum(counts)])].tolist()
            texts = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
            texts = [(t[1:] if t[:1] == b" " else t).decode("utf-8", "replace") for t in texts]
            valid = [t if x.is_valid else None for t, x in zip(texts, lists)]
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(valid, pa.string())], names=[*own.schema.names, "_text"])


def decode(rows: DataFrame, model: Model, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """`rows` with the text of their ids in `text_col`; null ids give null, ids out of range fail."""
    at = rows.columns.index(ids_col)
    inner = [f"c{i}" for i in range(len(rows.columns))]
    schema = T.StructType([*[T.StructField(c, f.dataType) for c, f in zip(inner, rows.schema)], T.StructField("_text", T.StringType())])
    done = rows.toDF(*inner).mapInArrow(lambda batches: _decoded(batches, at, model), schema)
    kept = [i for i, c in enumerate(rows.columns) if c.lower() != text_col.lower()]
    return done.select(*[inner[i] for i in kept], "_text").toDF(*[rows.columns[i] for i in kept], text_col)
