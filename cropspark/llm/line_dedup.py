"""Line dedup by content-defined chunks of lines.

A text is cut into lines at \\n, and a rolling hash runs over the hashes of `WINDOW` lines. Where it
is not divisible by `DIVISOR`, its last line ends chunks; where its quotient isn't, its first line
begins chunks. From each line a chunk runs to the next end, and up to each line one runs from the
last beginning before it: two lines or more, `MOST_LINES` at most. All borders depend on the lines
of the chunk alone, so lines put in around a passage don't change the chunks inside it, and the two
families together cover nearly every passage: one of two lines has no chunk with a chance of one in
sixteen, longer ones lose a line at an end more rarely still (measured recall: see the tests).

A chunk that occurred before, in order of id and place, is removed wherever it occurs again: the
lines that lie in such chunks go. Chunks are told apart by the 64-bit hashes of their lines, in
order; the lines of repeated chunks are compared byte by byte, by grouping their whole texts, and
a chunk with a hash of two different lines is not removed. Single lines are never chunks.

Only built-in expressions are used. Counts and comparisons are combined before their shuffles,
and joins on a chunk or a document leave the large side splittable. The time for one text grows
with its lines: positions are looked up in sets, and chunks are short.

Defined results: null stays null and has no lines; an empty text is one empty line; rows
without an id are returned unchanged and not counted; rows with one id count as one document;
an empty table gives an empty result; columns other than id and text are returned as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropspark.llm.frames import bound, one_row, packed, stored

WINDOW = 2
DIVISOR = 4
MOST_LINES = 16
MODULUS = 2147483647
FACTOR = 31
#: A chunk is kept as its first line times this plus its number of lines.
_SPAN = 32


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("bigint")


def _rolled(hashes: Column) -> Column:
    """The rolling hash of each run of `WINDOW` lines."""

    def value(i: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for k in range(WINDOW):
            out = (out * F.lit(FACTOR) + F.get(hashes, i + F.lit(k))) % F.lit(MODULUS)
        return out

    last = F.size(hashes) - F.lit(WINDOW)
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), value)).otherwise(F.array().cast("array<bigint>"))


def _hits(rolled: Column, hit) -> Column:
    at = F.transform(rolled, lambda r, i: F.when(hit(r), i))
    return F.array_compact(at)


def _spans(rolled: Column) -> Column:
    """The chunks of a text, from the rolling hashes of its lines."""
    last = F.size(rolled)  # the number of the last line
    none = F.array().cast("array<array<bigint>>")

    def numbered(start: Column, end: Column) -> Column:
        return start.cast("bigint") * F.lit(_SPAN) + end - start + F.lit(1)

    def forward(ends: Column) -> Column:
        def own(e: Column, k: Column) -> Column:
            first = F.when(k > 0, F.get(ends, k - F.lit(1))).otherwise(0)
            return F.transform(F.sequence(first, e - F.lit(1)), lambda i: numbered(i, F.least(e, i + F.lit(MOST_LINES - 1))))

        return F.transform(ends, own)

    def backward(starts: Column) -> Column:
        def own(s: Column, k: Column) -> Column:
            to = F.coalesce(F.get(starts, k + F.lit(1)), last)
            return F.transform(F.sequence(s + F.lit(1), to), lambda j: numbered(F.greatest(s, j - F.lit(MOST_LINES - 1)), j))

        return F.transform(starts, own)

    # the last line always ends, and the first always begins, a chunk
    ends = F.array_distinct(F.concat(F.transform(_hits(rolled, lambda r: r % F.lit(DIVISOR) != 0), lambda i: i + F.lit(1)), F.array(last)))
    begins = _hits(rolled, lambda r: F.floor(r / F.lit(DIVISOR)) % F.lit(DIVISOR) != 0)
    starts = F.array_distinct(F.concat(F.array(F.lit(0)), begins))
    both = F.concat(bound(ends, forward), bound(starts, backward))
    return F.array_distinct(F.flatten(F.when(last >= 1, both).otherwise(none)))


def chunks(docs: DataFrame, keep: list[str], text: Column) -> DataFrame:
    """`keep` and a struct `_m` of the lines `l`, their hashes `h` and the chunks `c` of each text."""
    lines = one_row(docs, keep, l=F.split(text, "\n"))
    own = F.col("_m.l")
    rolled = one_row(lines, keep, l=own, h=F.transform(own, lambda line: F.xxhash64(line)), r=F.when(own.isNotNull(), bound(F.transform(own, _line_hash), _rolled)))
    return one_row(rolled, keep, l=own, h=F.col("_m.h"), c=F.when(own.isNotNull(), bound(F.col("_m.r"), _spans)))


def _part(values: Column, span: Column) -> Column:
    at, n = F.floor(span / F.lit(_SPAN)).cast("int"), (span % F.lit(_SPAN)).cast("int")
    return F.slice(values, at + F.lit(1), n)


def _lines_of(spans: Column) -> Column:
    """The numbers of all lines in some chunks."""

    def own(span: Column) -> Column:
        at = F.floor(span / F.lit(_SPAN)).cast("int")
        return F.sequence(at, at + (span % F.lit(_SPAN)).cast("int") - F.lit(1))

    return F.array_distinct(F.flatten(F.transform(spans, own)))


def _removals(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, gone): per document the chunks to remove, as (span, h), h being the hash of its lines' hashes."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    cut = chunks(named, ["id"], F.col("text"))
    keyed = F.transform("_m.c", lambda c: F.struct(c.alias("span"), _part(F.col("_m.h"), c).alias("key")))
    seen = stored(cut.select("id", F.explode(keyed).alias("x")).select("id", "x.*"), "chunks")
    counted = seen.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("id", "span")).alias("first"))
    repeated = stored(counted.filter("n > 1").select("key", "first"), "repeated-chunks")
    again = seen.join(repeated, "key").select("id", "span", "key", "first")

    # the bytes of the lines of repeated chunks: a hash of two different lines is not to be trusted
    found = stored(again.groupBy("id").agg(F.collect_set("span").alias("spans")), "found-chunks")
    texts = cut.join(found.hint("merge"), "id").select("_m", "spans")
    # an id may have several rows, whose chunks differ: only lines that the row has
    numbers = F.filter(_lines_of(F.col("spans")), lambda i: i < F.size("_m.l"))
    lines = texts.select("_m", F.explode(numbers).alias("i")).select(F.get("_m.h", F.col("i")).alias("h"), F.get("_m.l", F.col("i")).alias("line"))
    unlike = lines.groupBy("h", "line").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count("*").alias("texts")).filter("texts > 1").select("h")
    unlike = stored(unlike, "unlike-lines")
    keys = repeated.select("key", F.explode("key").alias("h")).join(unlike, "h", "left_semi").select("key").distinct()
    later = again.filter("id <> first.id or span <> first.span").join(keys, "key", "left_anti")
    gone = later.groupBy("id").agg(F.collect_set(F.struct("span", F.xxhash64("key").alias("h"))).alias("gone"))
    return stored(gone, "removed-chunks")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A struct `doc` of the columns of `docs`, the text that is left, and counts, per row."""
    gone = _removals(docs, id_col, text_col)
    rows = packed(docs, "doc", F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(gone.hint("merge"), "id", "left")
    cut = chunks(rows, ["doc", "gone"], F.col("text"))
    lines, hashes, parts = F.col("_m.l"), F.col("_m.h"), F.col("_m.c")
    # a row that shares its id with others loses only what it holds itself
    own = F.filter("gone", lambda g: F.xxhash64(_part(hashes, g["span"])) == g["h"])
    removed = one_row(cut, ["doc"], l=lines, c=parts, r=F.transform(F.when(F.col("gone").isNotNull(), own), lambda g: g["span"]))
    lines, parts, out = F.col("_m.l"), F.col("_m.c"), F.col("_m.r")
    number = F.sequence(F.lit(0), F.size(lines) - F.lit(1))
    covered = one_row(removed, ["doc"], l=lines, c=parts, r=out, g=F.when(out.isNotNull(), F.array_intersect(_lines_of(out), number)))
    lines, parts, out, lost = (F.col(f"_m.{c}") for c in ("l", "c", "r", "g"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - F.lit(1)), lost), lambda i: F.get(lines, i))
    return covered.select(
        "doc",
        F.when(lost.isNotNull() & (F.size(lost) > 0), F.array_join(kept, "\n")).otherwise(F.array_join(lines, "\n")).alias("text_left"),
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size(parts), F.lit(0)).alias("n_chunks"),
        F.coalesce(F.size(out), F.lit(0)).alias("n_removed_chunks"),
        F.coalesce(F.size(lost), F.lit(0)).alias("n_removed_lines"),
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """`docs` with repeated chunks taken out of the texts; a text that is wholly removed loses its row."""
    done = dedup_lines(docs, id_col, text_col)
    new = {text_col: F.col("text_left")}
    if length_col in docs.columns:
        new[length_col] = F.when(F.col("n_removed_lines") > 0, F.length("text_left")).otherwise(F.col(f"doc.`{length_col}`"))
    kept = done.filter((F.col("n_removed_lines") == 0) | (F.col("n_removed_lines") < F.col("n_lines")))
    return kept.select(*[new.get(c, F.col(f"doc.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
