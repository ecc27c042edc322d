"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and items are compared in a plain form: A-Z in lower case, every run of ASCII characters
that are neither letters nor digits as one blank. An item of n bytes may be edited in
k = `EDIT_RATE` * n places. A copy with k edits or fewer shares at least n - Q + 1 - k * Q
q-grams with the item, and they lie on diagonals no more than k apart. So the q-grams that a
text shares with an item are counted in overlapping bands of diagonals, each 2k wide; bands that
meet the bound are kept, and the region below them is aligned with the item, in the cells of the
band alone.

An item of over `LONG` plain bytes is looked for by windows of that size, half of it apart, each with
its own budget. So a text that quotes a good part of an item word for word holds it, and the work
for an item grows with its length, not with the square.

The benchmark is a query set against all rows, taken in blocks of about `BLOCK_BYTES`: items go
to blocks by hash, a block's q-gram index is broadcast (its size is bounded by the block's) and
built once a task. Text work is on byte arrays and row by row, so copies and long texts need no
shuffle.

Defined results: null or blank texts match nothing; items whose plain form is shorter than `Q`
match nothing; the budget of short items is lowered until the lemma asks for one q-gram; equal
texts, items and ids are each matched on their own; empty tables give no rows; only the named
columns are read. `edits` are those of the best window; the place is from the first to the last
window found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropspark.llm.text_arrays import slices

Q = 8
EDIT_RATE = 0.08
LONG = 256
BLOCK_BYTES = 4 << 20
FILTER_BITS = 22

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Plain bytes, offsets of the texts in them, and where each byte came from."""
    out = _PLAIN[data]
    blank = out == 32
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1] & ~edge[1:-1]
    source = np.flatnonzero(keep)
    return out[source], np.searchsorted(source, offsets), source


def grams(data: np.ndarray) -> np.ndarray:
    """The `Q` = 8 bytes from each place as one number."""
    n = max(0, len(data) - Q + 1)
    out = np.empty(n, np.uint64)
    for s in range(min(Q, n)):
        own = data[s : s + (len(data) - s) // 8 * 8]
        out[s::8] = np.frombuffer(own.tobytes(), "<u8")[: len(out[s::8])]
    return out


def windows(size: int) -> list[int]:
    """Where the windows of an item begin; the last one ends with it."""
    return [0] if size <= LONG else [*range(0, size - LONG, LONG // 2), size - LONG]


class Index:
    """The q-grams of a block of items, by windows; `of` numbers the item of each."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids, self.of, self.texts, all_grams, owner, place, known = [], [], [], [], [], [], -1
        for item_id, text in items:
            raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            data = plain(raw, np.array([0, len(raw)]))[0]
            data = data[: len(data) - 1] if len(data) and data[-1] == 32 else data
            if len(data) < Q:
                continue
            known += 1
            for at in windows(len(data)):
                part = data[at : at + LONG]
                g = grams(part)
                all_grams.append(g)
                owner.append(np.full(len(g), len(self.ids)))
                place.append(np.arange(len(g)))
                self.ids.append(item_id)
                self.of.append(known)
                self.texts.append(part)
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.minimum((self.sizes * EDIT_RATE).astype(np.int64), (self.sizes - Q) // Q)
        self.need = np.maximum(1, self.sizes - Q + 1 - self.edits * Q)
        self.widths = np.maximum(1, self.edits)
        flat = np.concatenate(all_grams) if all_grams else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.grams, self.first, self.counts = np.unique(flat[order], return_index=True, return_counts=True)
        self.owner = np.concatenate(owner)[order] if owner else np.zeros(0, np.int64)
        self.place = np.concatenate(place)[order] if place else np.zeros(0, np.int64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.slot(self.grams)] = True

    @staticmethod
    def slot(g: np.ndarray) -> np.ndarray:
        return (g * _MIX) >> np.uint64(64 - FILTER_BITS)

    def bands(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, band) where the band has as many shared q-grams as the lemma asks for."""
        g = grams(data)
        at = np.flatnonzero(self.filter[self.slot(g)])
        found = np.searchsorted(self.grams, g[at])
        real = self.grams[np.minimum(found, len(self.grams) - 1)] == g[at]
        at, found = at[real], found[real]
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + Q <= offsets[text + 1]
        at, found, text = at[inside], found[inside], text[inside]
        # a text with fewer shared q-grams than any item asks for is out
        enough = np.bincount(text, minlength=len(offsets))[text] >= self.need.min()
        at, found, text = at[enough], found[enough], text[enough]
        times = self.counts[found]
        entry = np.repeat(self.first[found] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum()) if len(at) else np.zeros(0, np.int64)
        text, at = np.repeat(text, times), np.repeat(at, times)
        item = self.owner[entry]
        # diagonals count from the last place of the item, so none is negative
        band = (at - offsets[text] - self.place[entry] + self.sizes[item]) // self.widths[item] + 1
        most = int(band.max(initial=0)) + 2
        key = (text * len(self.ids) + item) * most + band
        key, count = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        item = key // most % max(1, len(self.ids))
        for k in key[count >= self.need[item]].tolist():
            yield k // most // len(self.ids), k // most % len(self.ids), k % most

    def aligned(self, text: np.ndarray, item: int, band: int) -> tuple[int, int, int] | None:
        """Edits, start and end of the best place for the item below the band, if within budget."""
        low = (band - 1) * int(self.widths[item]) - int(self.sizes[item])
        start = max(0, low - int(self.edits[item]))
        region = text[start : low + 2 * int(self.widths[item]) + int(self.sizes[item]) + int(self.edits[item])]
        most = int(self.edits[item])
        edits, end = placed(self.texts[item], region, most)
        if edits > most:
            return None
        _, back = placed(self.texts[item][::-1], region[:end][::-1], most, anchored=True)
        return edits, start + end - back, start + end


def placed(item: np.ndarray, region: np.ndarray, most: int, anchored: bool = False) -> tuple[int, int]:
    """Fewest edits of the item against a part of the region, and the (first) end of that part.

    Only cells that a path of `most` edits can reach are filled: a column starts at most that far
    before the row, and ends that far behind it and the region's surplus (none if the part has to
    start where the region does). Without such a path the edits are more than `most`.
    """
    n, m = len(item), len(region)
    slack = 0 if anchored else max(0, m - n)
    width = slack + 2 * most + 1
    if m < n - most:
        return most + 1, 0
    # cell b of row i stands for column i - most + b of the region
    steps = np.arange(width)
    far = n + m + width
    column = steps - most
    row = np.where((column >= 0) & (column <= m), column if anchored else 0, far)
    padded = np.concatenate([np.zeros(most, np.int64), region.astype(np.int64), np.full(width + n, -1)])
    for i, byte in enumerate(item.tolist(), 1):
        column = column + 1
        inside = (column >= 0) & (column <= m)
        # the byte before column j is region[j - 1]
        new = row + (padded[i - 1 : i - 1 + width] != byte)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new = np.where(inside, new, far)
        row = np.where(inside, np.minimum.accumulate(new - steps) + steps, far)
    best = int(row.argmin())
    return int(min(row[best], most + 1)), int(best + n - most)


_FOUND = "doc_id bigint, item_id bigint, edits int, start bigint, end bigint"


def _hits(index: Index, part) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """By text and item: edits and window of the best place, and the bytes from the first place to the last."""
    data, offsets, source = plain(part.data, part.offsets)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for text, window, band in index.bands(data, offsets) if index.ids and len(data) else ():
        place = index.aligned(data[offsets[text] : offsets[text + 1]], window, band)
        if place is not None and place < best.get((text, window), (1 << 60,)):
            best[text, window] = place
    found: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for (text, window), (edits, a, b) in sorted(best.items()):
        start = int(source[offsets[text] + a] - part.offsets[text])
        end = int(source[offsets[text] + b - 1] + 1 - part.offsets[text])
        key = (text, index.of[window])
        known = found.get(key, (1 << 60, window, start, end))
        found[key] = min(known[0], edits), known[1], min(known[2], start), max(known[3], end)
    return found


def _search(items: list[tuple], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = Index(items)
    for batch in batches:
        for part in slices(batch.column(1)):
            ids = batch.column(0).slice(part.first, part.n)
            rows = sorted(_hits(index, part).items())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array([t for (t, _), _ in rows], pa.int64())),
                    pa.array([index.ids[w] for _, (_, w, _, _) in rows], pa.int64()),
                    pa.array([e for _, (e, _, _, _) in rows], pa.int32()),
                    pa.array([a for _, (_, _, a, _) in rows], pa.int64()),
                    pa.array([b for _, (_, _, _, b) in rows], pa.int64()),
                ],
                names=["doc_id", "item_id", "edits", "start", "end"],
            )


def _clean(items: list[tuple], batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    index = Index(items)
    for batch in batches:
        kept = np.ones(batch.num_rows, bool)
        for part in slices(batch.column(column)):
            kept[[part.first + text for text, _ in _hits(index, part)]] = False
        yield batch.filter(pa.array(kept))


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str) -> Iterator:
    """The items in broadcasts of about `BLOCK_BYTES`."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).alias("text")).filter("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in own.collect()])


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, edits, start, end): the items found in each text; places are UTF-8 bytes."""
    plain_docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for sent in _blocks(benchmark, item_col, item_text_col):
        found = plain_docs.mapInArrow(lambda batches, sent=sent: _search(sent.value, batches), _FOUND)
        out = found if out is None else out.union(found)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text holds no item, unchanged, whatever their ids; read once."""
    at = docs.columns.index(text_col)
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    for sent in _blocks(benchmark, "item_id", "text"):
        inner = inner.mapInArrow(lambda batches, sent=sent: _clean(sent.value, batches, at), inner.schema)
    return inner.toDF(*docs.columns)
