"""MinHash near-duplicates by an inverted join on (coordinate, value) of the signatures.

1. Each text gives its set of 5-word shingles (as 64-bit hashes) and a signature of `COORDINATES`
   minima. Equal sets become one node.
2. Nodes are posted under each coordinate-value pair. Pairs of nodes at the similarity limit
   agree in three quarters of the coordinates on average; those that agree in fewer than
   `MATCHES` are not looked at (chance for a pair at the limit: about 3 in a million, less
   above it). So a node needs to be posted only under the prefix of its pairs in a common order,
   rarest first, that leaves out the last `MATCHES - 1`; values that nobody shares come first
   and generate nothing.
3. Within a posting list, nodes are tried against a centre; a verified link makes them one
   component, and lists are contracted to components before the next round, so a group of
   copies is never expanded into all pairs. Between the components that are left, pairs come
   from a join on the rarest shingles of the full sets: the components are those of all links.
4. For pairs that come from posting lists, collisions over the whole signature are counted; links
   are confirmed on the full sets. Pairs from the full sets are confirmed whatever their collisions.

Defined results: null or blank text has an empty set, links with nothing and is kept; rows
without an id are not compared, have no component and are kept; equal rows each give a row;
only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropspark.llm.components import components
from cropspark.llm.frames import fresh, stored
from cropspark.llm.text_arrays import mixed, shingle_sets, slices

COORDINATES = 64
MATCHES = 32
PERCENT = 75
CENTRE_ROUNDS = 2
SIZE_STEP = 1.06

_rng = np.random.Generator(np.random.PCG64(7))
_SCALE = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """One row of `COORDINATES` 32-bit values per non-empty set."""
    sizes = np.array([len(s) for s in sets])
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = np.concatenate(sets)
    out = np.empty((len(sets), COORDINATES), np.uint64)
    for j in range(COORDINATES):
        out[:, j] = np.minimum.reduceat(flat * _SCALE[j] + _SHIFT[j], at)
    return (mixed(out) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(1)):
            ids = batch.column(0).slice(part.first, part.n)
            sets = list(shingle_sets(part))
            full = [i for i, s in enumerate(sets) if len(s)]
            lengths = np.zeros(part.n + 1, np.int32)
            lengths[np.array(full, np.int64) + 1] = COORDINATES
            flat = _minima([sets[i] for i in full]).ravel() if full else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(flat)),
                ],
                names=["doc_id", "n_shingles", "node", "signature"],
            )


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, node, signature): node identifies the set, null for an empty one."""
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(_sign, "doc_id bigint, n_shingles bigint, node binary, signature array<int>")


def _prefixes(nodes: DataFrame) -> DataFrame:
    """(post, rep, node, common): the posting lists of the prefixes; common counts shared values."""
    post = (F.shiftleft(F.col("j").cast("bigint"), 32) + F.col("v").cast("bigint")).alias("post")
    posts = nodes.select("rep", "node", F.posexplode("signature").alias("j", "v")).select("rep", "node", post)
    shared = posts.groupBy("post").agg(F.count("*").alias("n")).filter("n > 1")
    per_node = (
        posts.join(shared, "post")
        .groupBy("rep", "node")
        .agg(F.sort_array(F.collect_list(F.struct("n", "post"))).alias("posts"))
        .filter(F.size("posts") >= MATCHES)
    )
    prefix = F.slice("posts", F.lit(1), F.size("posts") - F.lit(MATCHES - 1))
    listed = per_node.select("rep", "node", F.size("posts").alias("common"), F.explode(prefix).alias("p"))
    return listed.select("p.post", "rep", "node", "common")


def _collisions(left: Column, right: Column) -> Column:
    return F.size(F.filter(F.zip_with(left, right, lambda x, y: x == y), lambda same: same))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(1)):
            nodes = batch.column(0).slice(part.first, part.n).to_pylist()
            found = [(n, s) for n, s in zip(nodes, shingle_sets(part)) if hashlib.md5(s.tobytes()).digest() == n]
            ends = np.cumsum([0, *[len(s) for _, s in found]], dtype=np.int32)
            flat = np.concatenate([s for _, s in found]).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in found], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["node", "shingles"],
            )


def _confirmed(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, matches: int) -> DataFrame:
    """The pairs (a, b) that agree in at least `matches` coordinates and whose sets are similar enough."""
    small = nodes.select("node", "n_shingles", "signature")
    a = small.toDF("a", "na", "sa")
    b = small.toDF("b", "nb", "sb")
    sized = pairs.join(a, "a").join(b, "b").filter(F.lit(100) * F.least("na", "nb") >= F.lit(PERCENT) * F.greatest("na", "nb"))
    if matches:
        sized = sized.filter(_collisions(F.col("sa"), F.col("sb")) >= matches)
    likely = sized.select("a", "b", "na", "nb")
    shared = (
        likely.join(sets.toDF("a", "xa"), "a")
        .join(sets.toDF("b", "xb"), "b")
        .select("a", "b", "na", "nb", F.size(F.array_intersect("xa", "xb")).cast("bigint").alias("both"))
    )
    return shared.filter("100 * both >= 75 * (na + nb - both)".replace("75", str(PERCENT))).select("a", "b").distinct()


def _labelled(lists: DataFrame, links: DataFrame) -> DataFrame:
    """Lists with each node's component, without those that lie within one component."""
    found = components(links, "a", "b")
    rows = lists.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed_lists = rows.groupBy("post").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    return rows.join(mixed_lists.select("post"), "post").select("post", "rep", "node", "common", "component")


def _rest_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs between components that can still be similar, by a prefix of the full sets.

    Similar sets of given sizes share a least number of elements, so they meet in the rarest
    shingles that remain when that number, less one, is cut off the end. Nodes are posted for
    each size class of partners; a heavily edited copy has too many shingles of its own to be
    posted for its like.
    """
    nodes = rows.select("node", "component").distinct()
    posts = sets.join(nodes, "node").select("node", "component", F.size("shingles").alias("size"), F.explode("shingles").alias("g"))
    shared = posts.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1")

    def size_class(n: Column) -> Column:
        return F.floor(F.log(n) / F.lit(math.log(SIZE_STEP)))

    part = PERCENT / 100
    partners = F.sequence(size_class(F.greatest(F.floor(F.col("size") * part), F.lit(1))), size_class(F.ceil(F.col("size") / part)))
    per_node = (
        posts.join(shared, "g")
        .groupBy("node", "component", "size")
        .agg(F.sort_array(F.collect_list(F.struct("n", "g"))).alias("posts"))
        .filter(F.size("posts") >= F.col("size") * part)
        .select("*", F.explode(partners).alias("partner"))
    )
    # the overlap of similar sets of these sizes, taken a little low against rounding
    least = F.greatest(F.col("size") * part, (F.col("size") + F.pow(F.lit(SIZE_STEP), "partner")) * (part / (1 + part)))
    need = F.ceil(least - F.lit(1e-6)).cast("int")
    prefix = F.slice("posts", F.lit(1), F.size("posts") - need + F.lit(1))
    own = size_class(F.col("size"))
    lists = (
        per_node.filter(F.size("posts") >= need)
        .select("node", "component", F.least(own, "partner").alias("s"), F.greatest(own, "partner").alias("t"), "size", F.size("posts").alias("all"), F.posexplode(prefix).alias("at", "p"))
        .select("p.g", "s", "t", "node", "component", "size", (F.col("all") - F.col("at")).alias("left"))
    )
    lists = stored(lists, "rest")
    key = ["g", "s", "t"]
    between = lists.groupBy(*key).agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select(*key)
    lists = lists.join(between, key)
    one = lists.select(*key, F.col("node").alias("a"), F.col("component").alias("ca"), F.col("size").alias("na"), F.col("left").alias("ra"))
    other = lists.select(*key, F.col("node").alias("b"), F.col("component").alias("cb"), F.col("size").alias("nb"), F.col("left").alias("rb"))
    # from the first shingle they share on, both must have as many left as sets of these sizes share
    enough = F.least("ra", "rb") * F.lit(100 + PERCENT) >= F.lit(PERCENT) * (F.col("na") + F.col("nb"))
    return one.join(other, key).filter(F.expr("ca <> cb and a < b") & enough).select("a", "b").distinct()


def _centre_pairs(rows: DataFrame, order: Column) -> DataFrame:
    centre = rows.groupBy("post").agg(F.min(F.struct(order.alias("o"), "node", "component")).alias("c"))
    return (
        rows.join(centre, "post")
        .filter((F.col("node") != F.col("c.node")) & (F.col("component") != F.col("c.component")))
        .select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b"))
        .distinct()
    )


def links(docs: DataFrame, signed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Confirmed links (a, b) between nodes, enough of them to give the components of all links."""
    nodes = stored(
        signed.filter("node is not null and doc_id is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")),
        "nodes",
    )
    lists = stored(_prefixes(nodes), "posts")
    wanted = lists.select("rep", "node").distinct()
    texts = docs.select(F.col(id_col).cast("bigint").alias("rep"), F.col(text_col).alias("text"))
    sets = stored(
        texts.join(wanted, "rep").select("node", "text").mapInArrow(_sets, "node binary, shingles array<bigint>").dropDuplicates(["node"]),
        "sets",
    )
    rows = lists.withColumn("component", F.col("node"))
    tried = None
    found = None
    for step in range(CENTRE_ROUNDS):
        # first the node with the fewest values of its own, which an original is among its copies
        order = F.struct(-F.col("common"), "rep") if step == 0 else F.xxhash64(F.lit(step), "node")
        pairs = _centre_pairs(rows, order)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        more = stored(_confirmed(pairs, nodes, sets, MATCHES), "links")
        tried = pairs if tried is None else tried.union(pairs)
        found = more if found is None else found.union(more)
        rows = stored(_labelled(lists, found), "lists")
    rest = stored(_rest_pairs(rows, sets).join(tried, ["a", "b"], "left_anti"), "pairs")
    return stored(found.union(_confirmed(rest, nodes, sets, 0)), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id (smallest id reachable), kept."""
    signed = stored(signatures(docs, id_col, text_col), "signatures")
    found = components(links(docs, signed, id_col, text_col), "a", "b")
    nodes = signed.filter("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("rep"))
    labelled = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    ids = stored(labelled.join(least, "component").select("node", "component_id"), "components")
    rows = signed.select("doc_id", "n_shingles", "node").join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose document is the first of its group, unchanged."""
    dropped, mark = fresh(docs, "_id"), near_duplicates(docs, id_col, text_col)
    gone = mark.filter("not kept").select(F.col("doc_id").alias(dropped)).distinct()
    return docs.join(gone, F.col(f"`{id_col}`").cast("bigint") == F.col(dropped), "left_anti")
