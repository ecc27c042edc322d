"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one vector a group.

1. Equal vectors become one node with their number, so copies are never compared.
2. Centres are fitted by spherical k-means on `SAMPLE` vectors (those of smallest hash, so the
   choice is stable) of each length. Every vector is assigned to the cell of its nearest centre.
   The number of cells grows with the root of the number of vectors, up to `MOST_CELLS`, so the
   centres that go to the tasks have a known bound.
3. Cells alone would lose links over their borders. The border between the cells of centres a and b
   is a plane; two vectors of cosine `COSINE` are no further apart than sqrt(2 - 2 * COSINE), so
   one of them is at most half of that from the plane, and that one visits the other's cell.
   Every link is found in a cell, whatever centres were fitted: the result is exact.
4. A cell's own vectors are cut into blocks, and its visitors into groups, of bounded size; a block
   is held as a matrix, visitors go past in batches. Counts of links and a spanning set of each
   block's links go on, never all pairs. Products closer than `CLOSE` to the limit are summed again
   without rounding, so a tie doesn't depend on the blocks.
5. The spanning links give components; the vector with the smallest id stays.

Defined results: vectors that are null, empty, zero, or hold a null or a number that is not finite
link with nothing, as do rows without an id; such rows are their own component (null without an
id) and kept. Vectors of different lengths never link. Rows with equal ids are compared as any
others and are kept alike. An empty table gives no rows; only the id and vector columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropspark.llm.components import components
from cropspark.llm.frames import fresh, stored

COSINE = 0.95
SAMPLE = 16_384
MOST_CELLS = 2048
#: Numbers that the centres and the sample may hold; longer vectors get fewer of both.
MOST_NUMBERS = 1 << 22
ITERATIONS = 8
BLOCK = 4096
GROUP = 65_536
ROWS = 1024
CLOSE = 1e-9

_NODES = "vec_id bigint, node binary, dim int, vec binary"


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's vector as little-endian doubles with its digest; both null if it can't link."""
    for batch in batches:
        ids, lists = batch.column(0), batch.column(1)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")  # null becomes NaN
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        vectors = []
        for a, b in zip([0, *ends.tolist()], ends.tolist()):
            own = flat[a:b] + 0.0  # -0.0 becomes 0.0
            vectors.append(own.tobytes() if b > a and np.isfinite(own).all() and own.any() else None)
        vectors = [v if known else None for v, known in zip(vectors, ids.is_valid().to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([v and hashlib.blake2b(v, digest_size=16).digest() for v in vectors], pa.binary()),
                pa.array([v and len(v) // 8 for v in vectors], pa.int32()),
                pa.array(vectors, pa.binary()),
            ],
            names=["vec_id", "node", "dim", "vec"],
        )


def unit(vectors: list[bytes], dim: int) -> np.ndarray:
    """Rows of length 1; the largest component is taken out first, so no square overflows."""
    x = np.frombuffer(b"".join(vectors), "<f8").reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def exact_cosine_reaches(x: bytes, y: bytes, limit: float) -> bool:
    """Whether the cosine of two vectors is `limit` at least, by sums without rounding."""
    a, b = np.frombuffer(x, "<f8"), np.frombuffer(y, "<f8")
    a, b = (v / np.abs(v).max() for v in (a, b))
    dot, aa, bb = (math.fsum((p * q).tolist()) for p, q in ((a, b), (a, a), (b, b)))
    return dot / math.sqrt(aa * bb) >= limit


def fit(x: np.ndarray, cells: int, seed: int = 11) -> np.ndarray:
    """Centres of spherical k-means over the unit rows of `x`."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(ITERATIONS):
        nearest = np.concatenate([(x[i : i + ROWS] @ centres.T).argmax(1) for i in range(0, len(x), ROWS)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def centres_of(nodes: DataFrame, rows: int) -> dict[int, np.ndarray]:
    """Centres by length of vector, fitted on the driver on a bounded sample."""
    widest = nodes.agg(F.max("dim")).first()[0] or 1
    size = max(1, min(SAMPLE, MOST_NUMBERS // widest))
    sample = nodes.select("dim", "vec").orderBy(F.xxhash64("node"), "node").limit(size).collect()
    by_dim: dict[int, list[bytes]] = {}
    for row in sample:
        by_dim.setdefault(row["dim"], []).append(bytes(row["vec"]))
    cells = max(1, min(MOST_CELLS, math.ceil(math.sqrt(rows) / 2), size // 4))
    return {dim: fit(unit(own, dim), math.ceil(cells * len(own) / len(sample))) for dim, own in by_dim.items()}


def half_gap(cosine: float) -> float:
    """How far from a border one of two vectors of that cosine is at most, a little widened."""
    return math.sqrt(2 - 2 * cosine) / 2 + 1e-6


def margins(centres: np.ndarray, cosine: float) -> np.ndarray:
    """By how much a vector may be nearer to its own centre than to another one whose cell it visits."""
    return half_gap(cosine) * np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))


def cells_of(x: np.ndarray, centres: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each row, and which cells it visits (a boolean row per row)."""
    near = x @ centres.T
    home = near.argmax(1)
    visits = near[np.arange(len(x)), home][:, None] - near <= margin[home]
    visits[np.arange(len(x)), home] = False
    return home, visits


_ASSIGNED = "node binary, dim int, n bigint, vec binary, home int, visits array<int>"


def _assign(batches: Iterator[pa.RecordBatch], centres: dict[int, np.ndarray], cosine: float) -> Iterator[pa.RecordBatch]:
    margin = {dim: margins(c, cosine) for dim, c in centres.items()}
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
            for at in range(0, rows.num_rows, ROWS):
                own = rows.slice(at, ROWS)
                home, visits = np.zeros(own.num_rows, np.int32), np.zeros((own.num_rows, 1), bool)
                if dim in centres:
                    home, visits = cells_of(unit(own.column("vec").to_pylist(), dim), centres[dim], margin[dim])
                ends = np.concatenate([[0], np.cumsum(visits.sum(1))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(visits)[1].astype(np.int32)))
                columns = [own.column(c) for c in ("node", "dim", "n", "vec")] + [pa.array(home.astype(np.int32)), lists]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _ASSIGNED.split(", ")])


def tiles(assigned: DataFrame) -> DataFrame:
    """One row per vector and tile (dim, cell, block, part): a block of a cell and some visitors.

    `role` is 0 for the block's own vectors, which come first, and 1 for visitors: those of other
    cells, and those of the cell's later blocks. Own vectors are compared with each other in part 0.
    """
    own = assigned.groupBy("dim", F.col("home").alias("cell")).agg(F.count("*").alias("own"))
    coming = assigned.select("dim", F.explode("visits").alias("cell")).groupBy("dim", "cell").agg(F.count("*").alias("coming"))
    sizes = own.join(coming, ["dim", "cell"], "left").select(
        "dim",
        "cell",
        F.ceil(F.col("own") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("own") + F.coalesce("coming", F.lit(0))) / GROUP).cast("int").alias("parts"),
    )
    each = assigned.select("*", F.explode(F.concat(F.array("home"), "visits")).alias("cell")).join(stored(sizes, "cells"), ["dim", "cell"])
    by = F.xxhash64("node")
    mine, part = F.pmod(by, "blocks").cast("int"), F.pmod(F.shiftright(by, 32), "parts").cast("int")
    is_home = F.col("cell") == F.col("home")
    # the last block that looks at the vector as a visitor
    last = F.when(is_home, mine - 1).otherwise(F.col("blocks") - 1)
    as_visitor = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda b: F.struct(b.alias("block"), part.alias("part"), F.lit(1).alias("role"))))
    as_own = F.when(is_home, F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(mine.alias("block"), p.alias("part"), F.lit(0).alias("role"))))
    none = F.array().cast("array<struct<block:int,part:int,role:int>>")
    to = F.concat(F.coalesce(as_visitor, none), F.coalesce(as_own, none))
    visits = F.when(F.col("t.role") == 0, F.col("visits"))
    placed = each.select("node", "dim", "cell", "home", "n", "vec", "visits", F.explode(to).alias("t"))
    return placed.select("dim", "cell", "t.block", "t.part", "t.role", "node", "home", "n", "vec", visits.alias("visits"))


class _Block:
    """The own vectors of a tile, and what was found so far."""

    def __init__(self, rows: list[pa.RecordBatch], dim: int, cell: int, part: int, cosine: float):
        self.dim, self.cell, self.cosine = dim, cell, cosine
        self.nodes, self.vectors, homes_visits = [], [], []
        for batch in rows:
            self.nodes += batch.column("node").to_pylist()
            self.vectors += batch.column("vec").to_pylist()
            homes_visits += batch.column("visits").to_pylist()
        self.weight = np.concatenate([b.column("n").to_numpy() for b in rows])
        self.x = unit(self.vectors, dim)
        width = max((max(v) for v in homes_visits if v), default=-1) + 2
        self.visits = np.zeros((len(rows) and len(self.nodes), width), bool)
        for i, v in enumerate(homes_visits):
            self.visits[i, v] = True
        self.links = np.zeros(len(self.nodes), np.int64)
        self.root = np.arange(len(self.nodes))
        if part == 0:
            for at in range(0, len(self.nodes), ROWS):
                self._own(at)

    def _linked(self, x: np.ndarray, vectors: list[bytes]) -> np.ndarray:
        product = x @ self.x.T
        linked = product >= self.cosine
        for i, j in np.argwhere(np.abs(product - self.cosine) < CLOSE).tolist():
            linked[i, j] = exact_cosine_reaches(vectors[i], self.vectors[j], self.cosine)
        return linked

    def _join(self, linked: np.ndarray) -> np.ndarray:
        """Own vectors that a row links with are of one component; the first of them, by row."""
        first = linked.argmax(1)
        i, j = np.nonzero(linked)
        pairs = np.unique(first[i] * linked.shape[1] + j)
        a, b = pairs // linked.shape[1], pairs % linked.shape[1]
        while True:  # the smaller root wins until nothing changes
            low = np.minimum(self.root[a], self.root[b])
            before = self.root.copy()
            for side in (a, b):
                np.minimum.at(self.root, before[side], low)
                np.minimum.at(self.root, side, low)
            self.root = self.root[self.root]
            if (before == self.root).all():
                return first

    def _own(self, at: int) -> None:
        to = min(at + ROWS, len(self.nodes))
        linked = self._linked(self.x[at:to], self.vectors[at:to])
        linked[np.arange(to - at), np.arange(at, to)] = False
        self.links[at:to] += linked @ self.weight
        if linked.any():
            linked[np.arange(to - at), np.arange(at, to)] = True  # a row is joined to what it links with
            self._join(linked)

    def visited_by(self, batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, list[bytes]]:
        """Visitors with links, how many, and one own vector that each links with."""
        vectors, home = batch.column("vec").to_pylist(), batch.column("home").to_numpy()
        linked = self._linked(unit(vectors, self.dim), vectors)
        # if each visits the other's cell, the link counts in the cell of the smaller number
        twice = (home < self.cell) & (home < self.visits.shape[1])
        linked[twice] &= ~self.visits[:, home[twice]].T
        some = np.flatnonzero(linked.any(1))
        if not len(some):
            return [], np.zeros(0, np.int64), []
        linked = linked[some]
        self.links += batch.column("n").to_numpy()[some] @ linked
        first = self._join(linked)
        nodes = batch.column("node").take(pa.array(some)).to_pylist()
        return nodes, linked @ self.weight, [self.nodes[i] for i in first.tolist()]

    def own_links(self) -> tuple[list[bytes], np.ndarray, list[bytes | None]]:
        some = np.flatnonzero((self.links > 0) | (self.root != np.arange(len(self.nodes))))
        to = [self.nodes[r] if r != i else None for i, r in zip(some.tolist(), self.root[some].tolist())]
        return [self.nodes[i] for i in some.tolist()], self.links[some], to


_FOUND = "node binary, links bigint, other binary"


def _found(nodes, links, other) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.binary()), pa.array(links, pa.int64()), pa.array(other, pa.binary())], names=["node", "links", "other"]
    )


def _compare(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by tile and role: a tile's block is complete when its first visitor comes."""
    now, held, block = None, [], None

    def complete():
        return _Block(held, now[0], now[1], now[3], cosine)

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "cell", "block", "part", "role")], 1)
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            *tile, role = keys[a].tolist()
            if tile != now:
                if block is None and held:
                    block = complete()
                if block is not None:
                    yield _found(*block.own_links())
                now, held, block = tile, [], None
            if role == 0:
                held.append(batch.slice(a, b - a))
                continue
            if block is None:
                if not held:  # no own vector has this block's number
                    continue
                block, held = complete(), []
            for at in range(a, b, ROWS):
                yield _found(*block.visited_by(batch.slice(at, min(ROWS, b - at))))
    if block is None and held:
        block = complete()
    if block is not None:
        yield _found(*block.own_links())


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """Per row of `vectors`: vec_id, n_links, component_id (smallest id reachable), kept."""
    plain = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = stored(plain.mapInArrow(_nodes, _NODES), "vectors")
    nodes = stored(
        rows.filter("node is not null").groupBy("node").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("dim").alias("dim"), F.first("vec").alias("vec")),
        "nodes",
    )
    centres = centres_of(nodes, nodes.count())
    assigned = stored(nodes.select("node", "dim", "n", "vec").mapInArrow(lambda b: _assign(b, centres, cosine), _ASSIGNED), "assigned")
    tile = ["dim", "cell", "block", "part"]
    dealt = tiles(assigned).repartition(*tile).sortWithinPartitions(*tile, "role")
    found = stored(dealt.mapInArrow(lambda b: _compare(b, cosine), _FOUND), "found")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.filter("other is not null"), "node", "other")
    labelled = nodes.select("node", "rep", "n").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    done = stored(
        labelled.join(least, "component").join(linked, "node", "left").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")),
        "linked",
    )
    out = rows.select("vec_id", "node").join(done, "node", "left")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )


def keep_one(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """The rows of `vectors` that stay, unchanged: one id of each group."""
    name = fresh(vectors, "_id")
    gone = near_duplicates(vectors, id_col, vector_col, cosine).filter("not kept").select(F.col("vec_id").alias(name)).distinct()
    return vectors.join(gone, F.col(f"`{id_col}`").cast("bigint") == F.col(name), "left_anti")
