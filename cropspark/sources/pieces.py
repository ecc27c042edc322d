"""Records of text files whose separators also occur inside quotes, without whole-file tasks.

Spark's text reader cuts a file into blocks, and each block into pieces at one character: a line
feed for CSV, a closing brace for JSON arrays. Whether that character ends a record depends on
everything before it: on the number of quotes, and on the depth of brackets. Both are sums, so
they are scanned as prefix sums: inside each block, and over one row per block for what comes
before it. A file of many gigabytes is many tasks, and a record that runs over pieces or blocks
is put together by its number.

Pieces are written once, so all passes see the same blocks whatever the number of executors.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropspark.session import written_once

_PLACE = ["file", "block", "at"]


def _count(text: Column, characters: str) -> Column:
    """How many of the characters (inside of a regular expression's brackets) a text holds."""
    return F.length(F.regexp_replace(text, f"[^{characters}]", ""))


def read_pieces(spark: SparkSession, path: str, separator: str, quotes: Column) -> DataFrame:
    """(file, block, at, text, quotes) of each piece; `quotes` counts those of column `text`.

    `block` is where the block starts in its file, `at` grows inside a block.
    """
    rows = spark.read.option("lineSep", separator).option("recursiveFileLookup", True).text(path)
    pieces = rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("text"),
    )
    return written_once(pieces.withColumn("quotes", quotes), "pieces")


def running(rows: DataFrame, value: str, out: str) -> DataFrame:
    """The sum of `value` over all rows of the file before each row.

    `rows` should be stored, as they are read twice. The window over a file has a row per block.
    """
    within = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy("file", "block")
        .agg(F.sum(value).alias("_own"))
        .select("file", "block", F.coalesce(F.sum("_own").over(earlier), F.lit(0)).alias("_before"))
    )
    summed = rows.withColumn(out, F.coalesce(F.sum(value).over(within), F.lit(0)))
    return summed.join(before, ["file", "block"]).withColumn(out, F.col(out) + F.col("_before")).drop("_before")


def _joined(parts: DataFrame, separator: str) -> DataFrame:
    """(file, number, record): the pieces of each record in order, put together again."""
    grouped = parts.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "at", "text"))).alias("_parts"))
    return grouped.select("file", "number", F.array_join(F.col("_parts.text"), separator).alias("record"))


# --- JSON arrays ---------------------------------------------------------------


def json_array_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The elements of files that each hold one JSON array of objects.

    First frame: (file, number, record), numbered from 0, the text of each element. Second frame:
    (file, whole), whole being whether quotes and brackets add up to one array between the first
    and the last character. Elements may hold objects, arrays, and any character inside quotes;
    they are not parsed here, so what else stands between them is seen when they are.
    """
    without_escapes = F.regexp_replace("text", r"(?s)\\.", "")
    pieces = read_pieces(spark, path, "}", _count(without_escapes, '"'))
    placed = running(pieces, "quotes", "_quotes")
    inside = F.col("_quotes") % 2 == 1
    # a text that began in an earlier piece, and one that runs on into the next, are cut away too
    bare = F.regexp_replace(F.when(inside, F.concat(F.lit('"'), without_escapes)).otherwise(without_escapes), r'"[^"]*(?:"|\z)', "")
    closes = ((F.col("_quotes") + F.col("quotes")) % 2 == 0).cast("int")
    net = _count(bare, r"\[{") - _count(bare, r"\]") - closes
    known = written_once(placed.select(*_PLACE, "text", "quotes", inside.alias("inside"), closes.alias("closes"), net.alias("net")), "pieces")
    # from here on without the texts
    deep = running(known.select(*_PLACE, "inside", "closes", "net"), "net", "depth")
    ends = (F.col("closes") == 1) & (F.col("depth") + F.col("net") == 1)
    alone = ends & (F.col("depth") == 1) & ~F.col("inside")
    shape = written_once(deep.select(*_PLACE, ends.cast("int").alias("ends"), alone.alias("alone")), "shape")
    numbered = running(shape, "ends", "number")
    parts = known.select(*_PLACE, "text").join(numbered, _PLACE)
    single = parts.where("alone").select("file", "number", F.col("text").alias("record"))
    rest = parts.where("not alone").select(*_PLACE, "number", "text")
    totals = shape.groupBy("file").agg(F.sum("ends").alias("_all"))
    put_together = _joined(rest, "}").join(totals, "file")
    found = single.unionByName(put_together.where("number < _all").select("file", "number", "record"))
    records = found.select(
        "file", "number", F.concat(F.regexp_replace("record", r"^\s*[\[,]?\s*", ""), F.lit("}")).alias("record")
    )
    tail = put_together.where("number = _all").select("file", F.col("record").rlike(r"^\s*(\[\s*)?\]\s*$").alias("closed"))
    # the last piece counts a brace that isn't there
    sums = known.groupBy("file").agg(
        ((F.sum("net") == -1) & (F.sum("quotes") % 2 == 0)).alias("balanced"),
        F.min_by("text", F.struct("block", "at")).rlike(r"^\s*\[").alias("opened"),
    )
    files = sums.join(tail, "file", "left").select(
        "file", (F.col("balanced") & F.col("opened") & F.coalesce("closed", F.lit(False))).alias("whole")
    )
    return records, files


# --- CSV -----------------------------------------------------------------------


def has_quoted_breaks(spark: SparkSession, path) -> bool:
    """Whether some line of the files holds an odd number of quotes, so that lines aren't rows."""
    return not spark.read.text(path).where(_count(F.col("value"), '"') % 2 == 1).isEmpty()


def csv_records(spark: SparkSession, path) -> DataFrame:
    """(file, record): the rows of CSV files without each file's header row.

    A row ends at a line feed (with or without a carriage return before it) that an even
    number of quotes precede, so every quote inside a value must be doubled and the value quoted.
    """
    pieces = read_pieces(spark, path, "\n", _count(F.col("text"), '"'))
    ends = ((F.col("_quotes") + F.col("quotes")) % 2 == 0).cast("int")
    placed = written_once(
        running(pieces, "quotes", "_quotes").select(*_PLACE, "text", (F.col("_quotes") % 2 == 0).alias("starts"), ends.alias("ends")), "pieces"
    )
    numbered = running(placed.select(*_PLACE, "ends"), "ends", "number").drop("ends")
    alone = F.col("starts") & (F.col("ends") == 1)
    first = placed.groupBy("file").agg(F.min(F.struct("block", "at")).alias("first"))
    single = placed.where(alone).join(first, "file").where(F.struct("block", "at") != F.col("first"))
    rest = placed.where(~alone).join(numbered, _PLACE).where("number > 0")
    rows = single.select("file", F.col("text").alias("record")).unionByName(_joined(rest, "\n").select("file", "record"))
    rows = rows.withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return rows.where(F.trim("record") != "")


def parse_csv(records: DataFrame, schema: T.StructType, options: Mapping[str, object]) -> DataFrame:
    """The columns of one CSV row per record; a value that doesn't fit its type is NULL."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    plain = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if k != "header"}
    return records.select(F.from_csv("record", ddl, plain | {"multiLine": "true"}).alias("_row")).select("_row.*")
