"""Token counts from flat token files: find the separators, stitch the documents.

A flat file is a run of little-endian unsigned integers of `WIDTH` bytes with the end-of-document
id after each document and no index. Each file is cut into blocks of `BLOCK` ids, and a block
reports its size and the places of its separators, found by one vectorised comparison. Where a
document starts depends on all blocks before it, so three exclusive prefix scans (ids so far,
separators so far, last separator so far) run over the blocks: inside parts of the block
order, then over one row a part, so no task takes all blocks.

Files follow in order of path, runs of digits compared as numbers (part-99999 comes before
part-100000). A document may run over blocks and files; ids after the last
separator form a last document without an end. `write_flat` keeps files small; a file is read
whole, so foreign files should be below the executors' memory and 2 GB.

Defined results: null and empty texts are documents of no ids; an empty table or folder without
ids gives no rows; equal rows are documents of their own; a trailing part of an id is an error.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cropspark.llm.frames import stored
from cropspark.llm.text_arrays import slices
from cropspark.llm.worker_cache import kept

WIDTH = 2
BLOCK = 1 << 16
FILE_BYTES = 4 << 20


def load_encoding(path: str, pattern: str):
    """The byte-pair encoding of a rank file, which a worker reads once."""
    import tiktoken

    def read():
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return kept(("encoding", path, pattern), read)


def _runs(batches: Iterator[pa.RecordBatch], path: str, pattern: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Files' worth of documents without the last separator."""
    encoding, kind = load_encoding(path, pattern), np.dtype(f"<u{WIDTH}")
    end = np.array([end_id], kind).tobytes()
    held, size = [], 0
    for batch in batches:
        for part in slices(batch.column(0)):
            for i in range(part.n):
                ids = encoding.encode_to_numpy(part.text(i).decode("utf-8", "replace"), disallowed_special=())
                held.append(ids.astype(kind).tobytes())
                size += len(held[-1]) + WIDTH
                if size >= FILE_BYTES:
                    yield pa.RecordBatch.from_pydict({"run": pa.array([end.join(held)], pa.binary())})
                    held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pydict({"run": pa.array([end.join(held)], pa.binary())})


def write_flat(docs: DataFrame, path: str, ranks: str, pattern: str, end_id: int, text_col: str = "text") -> None:
    """Encode the texts and write flat files below `path`; the separator ends each file."""
    if not 0 <= end_id < 1 << (8 * WIDTH):
        raise ValueError(f"the end id doesn't fit {WIDTH} bytes")
    runs = docs.select(F.col(text_col).alias("text")).mapInArrow(lambda b: _runs(b, ranks, pattern, end_id), "run binary")
    separator = end_id.to_bytes(WIDTH, "little").decode("latin-1")
    writer = runs.select(F.col("run").cast("string").alias("value")).write
    writer.option("encoding", "ISO-8859-1").option("lineSep", separator).option("maxRecordsPerFile", 1).text(path)


def _scanned(batches: Iterator[pa.RecordBatch], end_id: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column(0), batch.column(1)):
            ids = np.frombuffer(content.as_buffer(), f"<u{WIDTH}")
            for at in range(0, len(ids), BLOCK):
                block = ids[at : at + BLOCK]
                ends = np.flatnonzero(block == end_id)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name.as_py()]),
                        pa.array([at // BLOCK], pa.int64()),
                        pa.array([len(block)], pa.int64()),
                        pa.array([ends.tolist()], pa.list_(pa.int64())),
                    ],
                    names=["file", "block", "n", "ends"],
                )


def in_number_order(path: Column) -> Column:
    """A text that sorts as the path does with its runs of digits taken as numbers; the path ends it."""

    def padded(part: Column) -> Column:
        digits = F.ltrim(part, F.lit("0"))
        return F.when(part.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 4, "0"), digits)).otherwise(part)

    runs = F.regexp_extract_all(path, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    return F.concat(F.array_join(F.transform(runs, padded), ""), F.lit("\n"), path)


def _before(what, order: list[str], how=F.sum):
    window = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return how(what).over(window)


def count_tokens(spark: SparkSession, path: str, end_id: int) -> DataFrame:
    """(document, file, start, n_tokens, ended): each document's number, where it starts, its ids.

    `start` counts all ids before it, separators included; `file` holds its end.
    """
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")
    found = files.mapInArrow(lambda b: _scanned(b, end_id), "file string, block bigint, n bigint, ends array<bigint>")
    order = ["rank", "block"]
    ranked = found.withColumn("rank", in_number_order(F.col("file")))
    blocks = stored(ranked.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "blocks")
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"), F.sum(F.size("ends")).alias("seps"))
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        "part", F.coalesce(F.sum("n").over(over_parts), F.lit(0)).alias("n0"), F.coalesce(F.sum("seps").over(over_parts), F.lit(0)).alias("s0")
    )
    placed = blocks.join(carried, "part").select(
        "part", *order, "file", "n", "ends",
        (F.col("n0") + F.coalesce(_before(F.col("n"), order), F.lit(0))).alias("at"),
        (F.col("s0") + F.coalesce(_before(F.size("ends"), order), F.lit(0))).alias("number"),
    )
    last = F.when(F.size("ends") > 0, F.col("at") + F.element_at("ends", -1))
    placed = stored(placed.withColumn("last", last), "placed")
    by_part = placed.groupBy("part").agg(F.max("last").alias("last"))
    carry = by_part.select("part", F.max("last").over(over_parts).alias("l0"))
    stitched = placed.join(carry, "part").withColumn("last", F.coalesce(_before(F.col("last"), order, F.max), F.col("l0"), F.lit(-1)))
    ends = stitched.select("file", "number", "at", "last", "ends", F.posexplode("ends").alias("k", "end"))
    start = F.when(F.col("k") > 0, F.col("at") + F.get("ends", F.col("k") - F.lit(1))).otherwise(F.col("last")) + F.lit(1)
    docs = ends.select(
        (F.col("number") + F.col("k")).alias("document"), "file", start.alias("start"),
        (F.col("at") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("ended"),
    )
    total = placed.agg(
        F.max(F.col("at") + F.col("n")).alias("all"), F.max("last").alias("last"), F.sum(F.size("ends")).alias("document"), F.max_by("file", "rank").alias("file")
    )
    start = F.coalesce("last", F.lit(-1)) + F.lit(1)
    rest = total.filter(F.col("all") > start).select(
        "document", "file", start.alias("start"), (F.col("all") - start).alias("n_tokens"), F.lit(False).alias("ended")
    )
    return docs.unionByName(rest)
