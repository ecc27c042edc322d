"""Exact repeats of `MIN_BYTES` bytes or more from the interval trees of sampled suffix arrays.

Sampling. Of the `GRAM`-byte grams in each `MIN_BYTES`-byte string the one with the least hash
(the leftmost of equals) is an anchor. Equal strings choose it at the same place, so a repeated
string is found at an anchor that repeats. Suffixes are kept at repeated anchors only, each
with the bytes that a string around the anchor can reach: its context. Equal contexts are one
row, however often they occur; equal texts are one text.

Trees. The contexts of one anchor hash, sorted by the suffix, are a part of the suffix array.
With the common-prefix lengths of neighbours a stack scan gives its common-prefix intervals.
In each interval, members sorted by what stands to their left show how far they extend to the
left together: an interval whose members differ there is a maximal repeat (as far as the
context reaches), and all its members are its occurrences. A member is covered as far as the
longest left extension that it shares with any other member of the interval.

Hot anchors. A hash with more than `GROUP` different contexts is split by what the strings
around it contain: those that reach half of the way or more to the left share that left part,
the others share a right part; and so on, until groups are small. Contexts are cut to what is
left to reach each time, and those that are equal then become one, so strings that many copies
share soon leave one row. So no group is ever collected whole, and none is cut.

Defined results: null is an empty text; texts below `MIN_BYTES` bytes have no repeats except as
copies have none either; copies of one longer text are removed whole; overlapping repeats of a
text with itself count; rows with equal or null ids each give a row; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropspark.llm.frames import stored
from cropspark.llm.text_arrays import Texts, gram, slices

MIN_BYTES = 400
GRAM = 64
GROUP = 1000
SENT_HASHES = 8_000_000
LEFT = MIN_BYTES - GRAM
SLICE_BYTES = 1 << 18
#: A context's bytes before its anchor, and from there on in the lower bits.
REACH_BITS = 10


def _least_so_far(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of `width` values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place in the slice and text of each anchor."""
    width = LEFT + 1
    if len(part.data) < MIN_BYTES:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.arange(len(part.data) - GRAM + 1)
    hashes = gram(part.prefix(), starts, starts + GRAM)
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | starts.astype(np.uint64)
    chosen = (_least_so_far(ranked, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.arange(len(chosen))
    owner = np.repeat(np.arange(part.n), np.diff(part.offsets))
    chosen = chosen[first + MIN_BYTES <= part.offsets[1:][owner[: len(chosen)]]]
    chosen = chosen[np.diff(chosen, prepend=-1) != 0]
    return hashes[chosen], chosen, owner[chosen]


def _digests(part: Texts) -> list[bytes]:
    return [hashlib.md5(part.text(i)).digest() for i in range(part.n)]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(0), SLICE_BYTES):
            hashes, places, owner = anchors(part)
            own = _place_keys(_digests(part), owner, places - part.offsets[owner])
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(own)], names=["h", "p"])


_PLACES = "h bigint, t binary, at bigint, c binary, reach int"
_CONTEXTS = "h bigint, c binary, before binary, after binary"


def _place_keys(texts: list[bytes], owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One number for each place in a text, as `_place_key` gives it; two agree by a chance of 2**-64.

    An empty digest stands for a text without places.
    """
    return np.array([int.from_bytes(t[:8], "big", signed=True) for t in texts], np.int64)[owner] ^ at


def _place_key() -> Column:
    first = F.conv(F.hex(F.substring("t", F.lit(1), F.lit(8))), 16, -10).cast("bigint")
    return first.bitwiseXOR(F.col("at"))


def _known(sent, values: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array that was sent; all if none was."""
    if sent is None:
        return np.ones(len(values), bool)
    at = np.minimum(np.searchsorted(sent.value, values), max(0, len(sent.value) - 1))
    return sent.value[at] == values if len(sent.value) else np.zeros(len(values), bool)


def _context_rows(batches: Iterator[pa.RecordBatch], hashes_sent, places_sent, content: bool) -> Iterator[pa.RecordBatch]:
    """Contexts of the anchors that were sent: where they are and how long, or their bytes."""
    for batch in batches:
        for part in slices(batch.column(0), SLICE_BYTES):
            hashes, places, owner = anchors(part)
            keep = _known(hashes_sent, hashes)
            hashes, places, owner = hashes[keep], places[keep], owner[keep]
            own = set(owner.tolist())
            by_text = [hashlib.md5(part.text(i)).digest() if i in own else b"" for i in range(part.n)]
            at = places - part.offsets[owner]
            if content:
                keep = _known(places_sent, _place_keys(by_text, owner, at))
                hashes, places, owner = hashes[keep], places[keep], owner[keep]
            data = part.data.tobytes()
            low = np.maximum(part.offsets[owner], places - LEFT)
            high = np.minimum(part.offsets[owner + 1], places + MIN_BYTES)
            edges = list(zip(low.tolist(), places.tolist(), high.tolist()))
            ids = pa.array([hashlib.md5(b"%d:" % (p - a) + data[a:b]).digest() for a, p, b in edges], pa.binary())
            h = pa.array(hashes.view(np.int64))
            if content:
                before, after = [data[a:p] for a, p, _ in edges], [data[p:b] for _, p, b in edges]
                yield pa.RecordBatch.from_arrays([h, ids, pa.array(before, pa.binary()), pa.array(after, pa.binary())], names=["h", "c", "before", "after"])
            else:
                digests = pa.array(by_text, pa.binary()).take(pa.array(owner))
                reach = ((places - low) << REACH_BITS | (high - places)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([h, digests, pa.array(at), ids, pa.array(reach)], names=["h", "t", "at", "c", "reach"])


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading values the rows of `a` and `b` share (ends are padded differently)."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _padded(rows: list[bytes], width: int) -> np.ndarray:
    out = np.full((len(rows), width), -1, np.int16)
    for i, row in enumerate(rows):
        out[i, : len(row)] = np.frombuffer(row, np.uint8)
        out[i, len(row) :] = -1 - (i & 1)
    return out


def intervals(common: np.ndarray, least: int) -> list[tuple[int, int, int, int]]:
    """(depth, first, last, parent) of the common-prefix intervals of depth `least` or more.

    `common[i]` is the common prefix of suffixes i - 1 and i. A node comes before its parent,
    which is given by its place in the result, -1 for none.
    """
    out, stack, waiting = [], [], []  # stack: (depth, first, children)
    for i in range(1, len(common) + 1):
        depth = int(common[i]) if i < len(common) else -1
        first, waiting = i - 1, []
        while stack and stack[-1][0] > depth:
            own, first, children = stack.pop()
            if waiting:
                children += waiting
            out.append([own, first, i - 1, -1])
            for child in children:
                out[child][3] = len(out) - 1
            waiting = [len(out) - 1]
        if depth >= least:
            if stack and stack[-1][0] == depth:
                stack[-1][2].extend(waiting)
            else:
                stack.append((depth, first, list(waiting)))
    return [tuple(x) for x in out]


_SOLVED = "key bigint, c binary, node int, parent int, depth int, extent int, members int, spans array<struct<a:int,b:int>>"


def solve(key: int, rows: list[dict]) -> Iterator[tuple]:
    """Tree and cover of the contexts of one group, sorted by suffix.

    Rows of `_SOLVED`: for a node c is null, `extent` is its common left extension; for a
    context `node` is its deepest interval, and spans are relative to the anchor.
    """
    low, high = rows[0]["low"], rows[0]["high"]
    spans: list[set[tuple[int, int]]] = [set() for _ in rows]
    deepest = [-1] * len(rows)
    for i, row in enumerate(rows):
        if row["many"]:
            left, right = min(high, len(row["before"])), max(low, MIN_BYTES - len(row["after"]))
            if left >= right:
                spans[i].add((-left, MIN_BYTES - right))
    if len(rows) > 1:
        after = _padded([r["after"] for r in rows], MIN_BYTES)
        common = np.concatenate([[0], _agree(after[:-1], after[1:])])
        nodes = intervals(common, max(1, MIN_BYTES - high))
        if nodes:
            backward = [r["before"][::-1] for r in rows]
            order = sorted(range(len(rows)), key=backward.__getitem__)
            before = _padded([backward[i] for i in order], LEFT)
            shared = np.concatenate([[0], _agree(before[:-1], before[1:])])
            rank = np.empty(len(rows), np.int64)
            rank[order] = np.arange(len(rows))
        for number, (depth, first, last, parent) in enumerate(nodes):
            ranks = np.sort(rank[first : last + 1])
            between = np.minimum.reduceat(shared[: ranks[-1] + 1], ranks[:-1] + 1)
            longest = np.minimum(high, np.maximum(np.append(between, 0), np.insert(between, 0, 0)))
            least = max(low, MIN_BYTES - depth)
            for r, reach in zip(ranks.tolist(), longest.tolist()):
                if reach >= least:
                    spans[order[r]].add((-reach, MIN_BYTES - least))
            for i in range(first, last + 1):
                if deepest[i] < 0:
                    deepest[i] = number
            yield key, None, number, parent, depth, int(between.min()), last - first + 1, []
    for row, found, node in zip(rows, spans, deepest):
        yield key, row["c"], node, None, None, None, None, [{"a": a, "b": b} for a, b in sorted(found)]


def _solve_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`solve` for each run of rows with one key; rows are sorted by key and suffix."""
    names = [x.split()[0] for x in _SOLVED.split(", ")]
    kinds = [pa.int64(), pa.binary(), *[pa.int32()] * 5, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))]

    def shown(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    held, out = [], []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["key"] != row["key"]:
                out.extend(solve(held[0]["key"], held) if len(held) > 1 or held[0]["many"] else ())
                held = []
                if len(out) > 5000:
                    yield shown(out)
                    out = []
            held.append(row)
    if held and (len(held) > 1 or held[0]["many"]):
        out.extend(solve(held[0]["key"], held))
    yield shown(out)


def _split(rows: DataFrame) -> DataFrame:
    """Each row for the strings that reach the middle to the left, and for the others.

    Contexts are cut to what those strings can reach; `c` is the context before, in group `above`,
    and `cut` the context after, in group `key`.
    """
    rows = rows.withColumn("middle", F.floor((F.col("low") + F.col("high") + 1) / 2).cast("int"))
    reach = F.lit(MIN_BYTES + 1) - F.col("middle")

    def ends(name: str, length) -> Column:
        return F.substring(name, F.octet_length(name) - F.least(length, F.octet_length(name)) + F.lit(1), length)

    left = F.struct(
        F.xxhash64("key", F.lit("left"), ends("before", F.col("middle"))).alias("key"), F.col("key").alias("above"), "c",
        "before", F.substring("after", F.lit(1), F.lit(MIN_BYTES) - F.col("middle")).alias("after"), "many", F.col("middle").alias("low"), "high",
    )
    right = F.struct(
        F.xxhash64("key", F.lit("right"), F.substring("after", F.lit(1), reach)).alias("key"), F.col("key").alias("above"), "c",
        ends("before", F.col("middle") - F.lit(1)).alias("before"), "after", "many", "low", (F.col("middle") - 1).alias("high"),
    )
    parts = F.array(F.when(F.octet_length("before") >= F.col("middle"), left), F.when(F.octet_length("after") >= reach, right))
    both = rows.select(F.inline(F.array_compact(parts)))
    content = F.concat(F.octet_length("before").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("before"), F.col("after"))
    return both.withColumn("cut", F.unhex(F.md5(content)))


def _sent(spark, df: DataFrame, values, limit: int):
    """The sorted values of a small table as a broadcast, None for a table of over `limit` rows."""
    return spark.sparkContext.broadcast(np.sort(values(df.toArrow()))) if df.count() <= limit else None


def _whole_spans(before: Column, after: Column, low: Column, high: Column) -> Column:
    """The span of all strings around an anchor that its context can hold."""
    left, right = F.least(high, before).cast("int"), F.greatest(low, F.lit(MIN_BYTES) - after).cast("int")
    span = F.struct((-left).alias("a"), (F.lit(MIN_BYTES) - right).alias("b"))
    return F.when(left >= right, F.array(span)).otherwise(F.array().cast("array<struct<a:int,b:int>>"))


def trees(docs: DataFrame, text_col: str = "text", sent_hashes: int = SENT_HASHES, group: int = GROUP) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The nodes, the spans (c, s) of the contexts, and the places (t, at, c) of the contexts, also of copies of a text."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(text_col, F.lit("")).alias("text"))
    found = texts.mapInArrow(_anchor_rows, "h bigint, p bigint")
    repeated = found.groupBy("h").agg(F.min("p").alias("x"), F.max("p").alias("y")).filter("x <> y").select("h")
    repeated = stored(repeated, "anchors")
    hashes = _sent(spark, repeated, lambda t: t.column(0).to_numpy().view(np.uint64), sent_hashes)
    places = texts.mapInArrow(lambda b: _context_rows(b, hashes, None, False), _PLACES)
    places = stored(places if hashes is not None else places.join(repeated, "h", "left_semi"), "places")
    own = places.select(F.col("h").alias("key"), "c", "reach", _place_key().alias("p"))
    contexts = own.groupBy("key", "c").agg(F.min("p").alias("first"), F.max("p").alias("last"), F.max("reach").alias("reach"))
    contexts = stored(contexts.select("key", "c", "first", (F.col("first") != F.col("last")).alias("many"), "reach"), "contexts")
    sizes = contexts.groupBy("key").agg(F.count("*").alias("n"))
    contexts = stored(contexts.join(sizes, "key").filter("many or n > 1"), "contexts")
    # one context that occurs more than once is covered as far as it reaches, whatever its bytes
    before, after = F.shiftright("reach", REACH_BITS), F.col("reach").bitwiseAND(F.lit((1 << REACH_BITS) - 1))
    alone = contexts.filter("n = 1").select("c", F.explode(_whole_spans(before, after, F.lit(0), F.lit(LEFT))).alias("s"))
    wanted = contexts.filter("n > 1")
    keys = _sent(spark, wanted.select("first").distinct(), lambda t: t.column(0).to_numpy(), sent_hashes)
    content = texts.mapInArrow(lambda b: _context_rows(b, hashes, keys, True), _CONTEXTS).withColumnRenamed("h", "key")
    content = content.groupBy("key", "c").agg(F.first("before").alias("before"), F.first("after").alias("after"))
    todo = wanted.select("key", "c", "many").join(content, ["key", "c"]).withColumn("low", F.lit(0)).withColumn("high", F.lit(LEFT))
    todo, nodes, reaches, above = stored(todo, "groups"), [], [], []
    while True:
        # the few large groups are named, so that the rest is moved once; a row alone in its group gives nothing
        hot = stored(todo.groupBy("key").agg(F.count("*").alias("n")).filter(f"n > {group}").select("key"), "hot")
        small = todo.join(hot, "key", "left_anti")
        solved = stored(small.repartition("key").sortWithinPartitions("key", "after").mapInArrow(_solve_groups, _SOLVED), "solved")
        nodes.append(solved.filter("c is null").drop("c", "spans"))
        reaches.append(_reach(solved.filter("c is not null").select("key", "c", F.inline("spans"))))
        if hot.isEmpty():
            break
        large = todo.join(hot, "key")
        parts = stored(_split(large.filter("low < high")), "parts")
        above.append(parts.select("above", F.col("c").alias("whole"), "key", F.col("cut").alias("c")))
        todo = parts.groupBy("key", F.col("cut").alias("c"), "low", "high").agg(
            F.first("before").alias("before"), F.first("after").alias("after"), ((F.count("*") > 1) | F.max("many")).alias("many")
        )
        todo = stored(todo, "groups")
    # back level by level: a context reaches as far as the contexts that were cut from it
    reach = reaches[-1]
    for own, cuts in zip(reversed(reaches[:-1]), reversed(above)):
        up = stored(reach, "reach").join(cuts, ["key", "c"]).select(F.col("above").alias("key"), F.col("whole").alias("c"), "a", "b")
        reach = _reach(own.unionByName(up))
    tree = nodes[0]
    for more in nodes[1:]:
        tree = tree.unionByName(more)
    spans = alone.unionByName(reach.select("c", F.struct("a", "b").alias("s")))
    return tree, spans, places.select("t", "at", "c")


def _reach(spans: DataFrame) -> DataFrame:
    """The first and last byte (key, c, a, b) covered in each context: all its spans hold the anchor, so they overlap."""
    return spans.groupBy("key", "c").agg(F.min("a").alias("a"), F.max("b").alias("b"))


def covered(docs: DataFrame, text_col: str = "text", sent_hashes: int = SENT_HASHES, group: int = GROUP) -> DataFrame:
    """(t, spans): per text (its MD5) the merged byte ranges [a, b) of repeated strings."""
    _, spans, places = trees(docs, text_col, sent_hashes, group)
    # a context has one span as a rule, and its ranges are merged below if it has more
    reach = spans.select("c", "s.a", "s.b")
    found = places.join(reach, "c").select("t", (F.col("at") + F.col("a")).alias("a"), (F.col("at") + F.col("b")).alias("b")).distinct()
    # a run begins where all ranges before have ended; a window holds the ranges of one text
    before = Window.partitionBy("t").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.max("b").over(before) < F.col("a"), F.lit(True)).cast("int")
    run = F.sum("begins").over(Window.partitionBy("t").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, 0))
    runs = found.withColumn("begins", begins).withColumn("run", run).groupBy("t", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return stored(runs.groupBy("t").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans")), "spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sent_hashes: int = SENT_HASHES, group: int = GROUP) -> DataFrame:
    """Per row: doc_id, text, n_bytes, n_removed, n_spans, kept (the bytes left), kept_sha256."""
    spans = covered(docs, text_col, sent_hashes, group)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("t", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    copies = rows.groupBy("t").agg(F.count("*").alias("n")).filter("n > 1").select("t", F.lit(True).alias("copies"))
    marks = stored(spans.join(copies, "t", "full_outer"), "marks")
    joined = rows.join(marks.hint("merge"), "t", "left")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    whole = F.coalesce("copies", F.lit(False)) & (F.col("n_bytes") >= MIN_BYTES)
    span = F.struct(F.lit(0).cast("bigint").alias("a"), F.col("n_bytes").alias("b"))
    spans = F.when(whole, F.array(span)).otherwise(F.coalesce("spans", F.array().cast("array<struct<a:bigint,b:bigint>>")))
    marked = joined.withColumn("n_bytes", F.octet_length(data).cast("bigint")).withColumn("spans", spans)
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.col("spans.b"))
    ends = F.concat(F.col("spans.a"), F.array("n_bytes"))
    left = F.zip_with(starts, ends, lambda a, b: F.substring(data, (a + 1).cast("int"), (b - a).cast("int")).cast("string"))
    done = marked.withColumn("kept", F.array_join(left, "").cast("binary"))
    return done.select(
        "doc_id", "text", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        "kept", F.sha2("kept", 256).alias("kept_sha256"),
    )
