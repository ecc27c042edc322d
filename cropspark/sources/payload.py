"""Landed API payloads: one JSON array per document, element 0 is a header.

Small documents are lines of text files, or files of their own; a document of any size is a file
that `landed_cells` reads in blocks.
"""

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropspark import fixed_values as fv
from cropspark.functions.numbers import parse_locale_number, to_number, to_year
from cropspark.functions.text import lookup_or
from cropspark.operators.reshape import attach_unit, pivot_first_nonnull
from cropspark.operators.rows import add_missing_columns, project_ordered
from cropspark.schemas import PAYLOAD, PAYLOAD_CELL
from cropspark.session import written_once
from cropspark.sources.pieces import json_array_records


def read_payloads(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed documents with the file they came from: (payload, url_origem).

    `whole_files=True` is for one response per file; otherwise every line is a
    document, which keeps large landings splittable.
    """
    return spark.read.text(path, wholetext=whole_files).select(
        F.col("value").alias("payload"), F.col("_metadata.file_path").alias("url_origem")
    )


def payload_to_cells(
    payloads: DataFrame,
    collected_at: str | Column,
    variables: Mapping[str, str] = fv.VARIABLES,
    source: str = fv.SOURCE_NAME,
    table: str = fv.TABLE_CODE,
    number_mode: str = "pt_BR",
) -> DataFrame:
    """One typed row per payload cell; a malformed document yields no rows
    (`rejected_documents` lists them).

    `payloads` has `payload` and `url_origem`. `posicao` is the place of the cell
    in its document and orders duplicates of one cell.
    """
    cells = payloads.select(
        "url_origem", F.posexplode(F.from_json("payload", PAYLOAD)).alias("posicao", "_cell")
    ).where("posicao > 0")
    return _typed(cells, collected_at, variables, source, table, number_mode)


def _typed(
    cells: DataFrame,
    collected_at: str | Column,
    variables: Mapping[str, str] = fv.VARIABLES,
    source: str = fv.SOURCE_NAME,
    table: str = fv.TABLE_CODE,
    number_mode: str = "pt_BR",
) -> DataFrame:
    """Columns of cells that are parsed: (url_origem, posicao, _cell)."""
    moment = F.lit(collected_at) if isinstance(collected_at, str) else collected_at
    cells = cells.withColumn("coletado_em", moment)

    def field(key: str) -> Column:
        return F.coalesce(F.col(f"_cell.{key}"), F.lit(""))

    code = field("D2C")
    return cells.select(
        field("D4N").alias("produto"),
        field("D4C").alias("produto_cod"),
        field("NN").alias("nivel_territorial"),
        field("D1C").alias("cod_territorial"),
        field("D1N").alias("nome_territorial"),
        field("D3N").alias("ano"),
        code.alias("variavel_cod"),
        lookup_or(code, variables, F.concat(F.lit("var_"), code)).alias("variavel_col"),
        field("MN").alias("unidade_api"),
        parse_locale_number(field("V"), number_mode).alias("valor"),
        F.lit(source).alias("fonte"),
        F.lit(table).alias("tabela_sidra"),
        "url_origem",
        "coletado_em",
        "posicao",
    )


def write_arrays(cells: DataFrame, path: str, document: str, order: Sequence[str], cell: str, header: Column) -> None:
    """Each document as one file with one JSON array: the header, then its cells by `order`.

    `cell` and `header` are JSON texts. Rows of a document go past its file's writer one by
    one, so no array is held in memory; the folder of a file carries its document's name.
    """
    names = cells.select(document).distinct()
    # an empty file of texts would be no array: the border rows come from the documents themselves
    def border(kind: int, text: Column) -> DataFrame:
        no_order = [F.lit(None).cast(cells.schema[c].dataType).alias(c) for c in order]
        return names.select(document, F.lit(kind).alias("_kind"), *no_order, text.alias("value"))

    rows = cells.select(document, F.lit(1).alias("_kind"), *order, F.concat(F.lit(","), F.col(cell)).alias("value"))
    rows = border(0, F.concat(F.lit("["), header)).unionByName(rows).unionByName(border(2, F.lit("]")))
    dealt = rows.repartition(document).sortWithinPartitions(document, "_kind", *order)
    dealt.select(document, "value").write.partitionBy(document).text(path)


def read_arrays(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(url_origem, posicao, _cell) of array files of any size, and (url_origem, aceito) per file.

    Borders of cells are found by `pieces.json_array_records`, so a file is read by many
    tasks; each cell is parsed by `from_json`. As for small documents, one that isn't a JSON
    array of objects from its first character to its last gives no rows.
    """
    schema = T.StructType([*PAYLOAD_CELL.fields, T.StructField("_corrupt_record", T.StringType())])
    records, files = json_array_records(spark, path)
    parsed = written_once(
        records.select("file", "number", F.from_json("record", schema).alias("_cell"))
        .withColumn("_bad", F.col("_cell").isNull() | F.col("_cell._corrupt_record").isNotNull())
        .withColumn("_cell", F.col("_cell").dropFields("_corrupt_record")),
        "records",
    )
    bad = parsed.where("_bad").select("file").distinct()
    accepted = written_once(
        files.join(bad.withColumn("_has_bad", F.lit(True)), "file", "left").select(
            "file", (F.col("whole") & F.col("_has_bad").isNull()).alias("aceito")
        ),
        "files",
    )
    good = parsed.join(accepted.where("aceito").select("file"), "file", "left_semi")
    cells = good.select(F.col("file").alias("url_origem"), F.col("number").cast("int").alias("posicao"), "_cell")
    return cells, accepted.withColumnRenamed("file", "url_origem")


def landed_cells(spark: SparkSession, path: str, collected_at: str | Column, **options) -> tuple[DataFrame, DataFrame]:
    """`payload_to_cells` for array files of any size, and whether each file was accepted."""
    cells, files = read_arrays(spark, path)
    return _typed(cells.where("posicao > 0"), collected_at, **options), files


def rejected_documents(payloads: DataFrame) -> DataFrame:
    """The documents that are not a JSON array of cells, which give no rows."""
    return payloads.where(F.from_json("payload", PAYLOAD).isNull())


def collect_wide(payloads: DataFrame, collected_at: str | Column, **options) -> DataFrame:
    """All landed payloads to typed, sorted raw wide rows."""
    return collect_cells(payload_to_cells(payloads, collected_at, **options))


def collect_cells(cells: DataFrame) -> DataFrame:
    """Cells of any number of blocks to typed, sorted raw wide rows.

    The cells are written once: the pivot and the unit both read them.
    """
    cells = written_once(cells, "cells")
    wide = (
        pivot_first_nonnull(cells)
        .transform(attach_unit, cells=cells)
        .transform(add_missing_columns)
        .withColumn("ano", to_year(F.col("ano")))
    )
    return project_ordered(wide).orderBy(
        F.col("produto").asc_nulls_last(),
        F.col("ano").asc_nulls_last(),
        F.col("nome_territorial").asc_nulls_last(),
    )


def header_named_cells(
    payloads: DataFrame, columns: Mapping[str, str] = fv.SECOND_FORM_COLUMNS
) -> DataFrame:
    """Cells whose columns are found by the header's text instead of fixed keys.

    The header row of each document says which key holds which column; `columns`
    maps header text to output name. A column the header lacks is NULL.
    """
    docs = payloads.select(F.from_json("payload", "array<map<string,string>>").alias("_doc"))
    cells = docs.select(
        F.try_element_at("_doc", F.lit(1)).alias("_header"),
        F.posexplode("_doc").alias("posicao", "_cell"),
    ).where("posicao > 0")

    def named(title: str) -> Column:
        matching = F.map_filter("_header", lambda _, text: text == title)
        return F.try_element_at("_cell", F.try_element_at(F.map_keys(matching), F.lit(1)))

    return cells.select(*[named(title).alias(name) for title, name in columns.items()])


def clean_long_values(
    cells: DataFrame, value: str = "valor", mark: str = fv.MISSING_MARK_SECOND_TABLE
) -> DataFrame:
    """Drop marked and unreadable values of the second long form."""
    return (
        cells.where(F.col(value) != mark)
        .withColumn(value, to_number(F.col(value)))
        .na.drop(subset=[value])
    )


def union_blocks(blocks: Sequence[DataFrame]) -> DataFrame:
    """Accumulate blocks of cells, matching columns by name."""
    return functools.reduce(lambda a, b: a.unionByName(b), blocks)
