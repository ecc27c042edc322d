"""Fill-in-middle transformation with content-defined chunks that are summarised once.

A text is cut at two of its line borders into prefix, middle and suffix, which are put in another
order behind marks. Where the cuts lie follows from the document's id alone, so a rerun gives the
same result.

1. A hash of the last `WINDOW` bytes runs over the text; a chunk ends where it is 0 modulo
   `DIVISOR`, unless another such place comes shortly before. So equal passages fall into equal
   chunks, wherever they stand.
2. A chunk's summary holds its line feeds (offsets, and characters up to each), its characters, and
   what its neighbours need: whether a mark lies in it, and its first and last bytes, in which a
   mark may run over the border. Summaries are kept by the chunk's hash together with its
   bytes; a summary is used again only if the bytes are the same.
3. Sums of the summaries over a text's chunks give its number of lines, and place the line of
   each cut in a chunk, and the cut in that chunk, without a look at the text.

Each task keeps up to `KEPT` bytes of chunks, and reads slices of a megabyte or one longer text.

Defined results: a null text counts as empty; empty texts, texts that hold a mark and texts
left plain by the rate keep their text, and their numbers of characters are null; rows without
an id are cut as by an empty id; equal rows each give a row; an empty table gives no rows; only
the id and text columns are read. Bytes that are not UTF-8 start a character each unless they
are continuation bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropspark.llm.text_arrays import Texts, gram, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
RATE = 100
SUFFIX_FIRST = 50
WINDOW = 64
DIVISOR = 1024
APART = WINDOW
KEPT = 32 << 20

_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
_EDGE = max(map(len, _MARKS)) - 1
_SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _has_mark(data: bytes) -> bool:
    return any(m in data for m in _MARKS)


@dataclass(frozen=True, slots=True)
class Summary:
    """What a chunk adds to its text."""

    content: bytes
    lines: np.ndarray  #: offset behind each line feed
    chars_at: np.ndarray  #: characters up to there
    chars: int
    marked: bool

    @classmethod
    def of(cls, content: bytes) -> Summary:
        data = np.frombuffer(content, np.uint8)
        chars = np.cumsum((data & 0xC0) != 0x80)
        feeds = np.flatnonzero(data == 10)
        return cls(content, feeds + 1, chars[feeds], int(chars[-1]), _has_mark(content))


class Memo:
    """Summaries of chunks by hash; the bytes decide whether one is used again."""

    def __init__(self, kept: int = KEPT):
        self.kept, self.size, self.found, self.reused = kept, 0, {}, 0

    def of(self, key: int, content: bytes) -> Summary:
        known = self.found.get(key)
        if known is not None and known.content == content:
            self.reused += 1
            return known
        fresh = Summary.of(content)
        if known is None:
            if self.size > self.kept:
                self.found.clear()
                self.size = 0
            self.found[key] = fresh
            self.size += len(content)
        return fresh


def chunk_borders(part: Texts, sums: np.ndarray) -> np.ndarray:
    """Where the chunks of a slice begin and end; the ends of texts are among them."""
    at = np.arange(WINDOW, len(part.data) + 1)
    hit = at[gram(sums, at - WINDOW, at) % np.uint64(DIVISOR) == 0]
    # a place counts only if its whole window lies in its text
    hit = hit[hit - WINDOW >= part.offsets[np.searchsorted(part.offsets, hit, "left") - 1]]
    hit = hit[np.diff(hit, prepend=-APART) >= APART]
    return np.unique(np.concatenate([part.offsets, hit]))


class Chunks:
    """The summaries of one text, and their sums."""

    def __init__(self, parts: list[Summary]):
        self.parts = parts
        self.line_sums = np.cumsum([0, *[len(p.lines) for p in parts]])
        self.byte_sums = np.cumsum([0, *[len(p.content) for p in parts]])
        self.char_sums = np.cumsum([0, *[p.chars for p in parts]])
        open_end = bool(parts) and not parts[-1].content.endswith(b"\n")
        self.n = int(self.line_sums[-1]) + open_end

    @property
    def marked(self) -> bool:
        edges = zip(self.parts, self.parts[1:])
        return any(p.marked for p in self.parts) or any(_has_mark(a.content[-_EDGE:] + b.content[:_EDGE]) for a, b in edges)

    def cut(self, lines: int) -> tuple[int, int]:
        """Bytes and characters of the first so many lines."""
        if lines == 0:
            return 0, 0
        if lines > self.line_sums[-1]:  # the last line, which no line feed ends
            return int(self.byte_sums[-1]), int(self.char_sums[-1])
        k = int(np.searchsorted(self.line_sums, lines, "left")) - 1
        line = lines - int(self.line_sums[k]) - 1
        return int(self.byte_sums[k] + self.parts[k].lines[line]), int(self.char_sums[k] + self.parts[k].chars_at[line])


def chunked(part: Texts, memo: Memo) -> Iterator[Chunks]:
    """The chunks of each text of a slice."""
    sums = part.prefix()
    borders = chunk_borders(part, sums)
    keys = gram(sums, borders[:-1], borders[1:]).tolist()
    data, edges = part.data.tobytes(), borders.tolist()
    parts = [memo.of(key, data[a:b]) for key, a, b in zip(keys, edges, edges[1:])]
    places = np.searchsorted(borders, part.offsets).tolist()
    for a, b in zip(places, places[1:]):
        yield Chunks(parts[a:b])


def numbers(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit numbers of a document."""
    shown = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(shown[i : i + 8], 16) for i in range(0, 32, 8)]


def _rearranged(doc_id: int | None, text: bytes, chunks: Chunks, seed: int, rate: int, suffix_first: int) -> tuple:
    h1, h2, h3, h4 = numbers(doc_id, seed)
    if not text or h3 % 100 >= rate or chunks.marked:
        return doc_id, chunks.n, "plain", None, None, text
    (a, chars_a), (b, chars_b) = (chunks.cut(x) for x in sorted((h1 % (chunks.n + 1), h2 % (chunks.n + 1))))
    p, s, m = (mark + piece for mark, piece in zip(_MARKS, (text[:a], text[b:], text[a:b])))
    form, output = ("spm", s + p + m) if h4 % 100 < suffix_first else ("psm", p + s + m)
    return doc_id, chunks.n, form, chars_a, chars_b - chars_a, output


def _transform(batches: Iterator[pa.RecordBatch], **rule: int) -> Iterator[pa.RecordBatch]:
    memo = Memo()
    names = [f.split()[0] for f in _SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for part in slices(batch.column(1)):
            ids = batch.column(0).slice(part.first, part.n).to_pylist()
            rows = [_rearranged(i, part.text(k), c, **rule) for k, (i, c) in enumerate(zip(ids, chunked(part, memo)))]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            columns[-1] = pa.Array.from_buffers(pa.string(), len(rows), columns[-1].buffers())  # bytes as they came
            yield pa.RecordBatch.from_arrays(columns, names=names)


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row of `docs`.

    Of a hundred documents `rate` are rearranged, and of a hundred of those `suffix_first` in the
    form spm (suffix, prefix, middle), the others as psm.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(lambda batches: _transform(batches, seed=seed, rate=rate, suffix_first=suffix_first), _SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that `transform` rearranged, from its output and form."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)

    def behind_mark(piece: Column) -> Column:
        return F.substring(piece, len(PREFIX) + 1, 2**31 - 1)

    psm = F.concat(behind_mark(F.substring_index(head, SUFFIX, 1)), middle, F.substring_index(head, SUFFIX, -1))
    spm = F.concat(F.substring_index(head, PREFIX, -1), middle, behind_mark(F.substring_index(head, PREFIX, 1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
