"""Raw-layer snapshots: names, CSV / JSON / Parquet writers, manifest, newest scan.

A snapshot is a path `<root>/<format>/<name>.<format>`, written in parallel as a
folder of part files, or a single file made elsewhere; both are read the same way.
"""

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropspark import fixed_values as fv
from cropspark import schemas
from cropspark.functions.numbers import round_half_even
from cropspark.functions.text import lookup_or
from cropspark.operators.rows import project_ordered
from cropspark.sources.pieces import csv_records, has_quoted_breaks, parse_csv

FORMATS = ("csv", "json", "parquet")
# A quote inside a value is doubled; blanks around a value are kept.
CSV_OPTIONS = {
    "header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}

# Snapshot file name, prefix_level_years_date.extension
NAME_PREFIX = "ibge_pam"
NAME_PATTERN = r"(ibge_pam_([a-z]+)_([0-9]{4}(?:_[0-9]{4})*)_([0-9]{8}))\.(csv|json|parquet)"


# --- names -------------------------------------------------------------------


def snapshot_name(level: Column, years: Column, day: Column) -> Column:
    """prefix_level_year_year_YYYYMMDD from a level, an array of years and a date."""
    sorted_years = F.array_join(F.array_sort(F.transform(years, lambda y: y.cast("string"))), "_")
    return F.concat_ws("_", F.lit(NAME_PREFIX), level, sorted_years, F.date_format(day, "yyyyMMdd"))


def parse_snapshot_name(name: Column) -> dict[str, Column]:
    """Parts of a snapshot file name or path; NULL where the name does not fit."""

    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(name, NAME_PATTERN, i), F.lit(""))

    return {
        "base": part(1),
        "nivel": part(2),
        "anos": F.transform(F.split(part(3), "_"), lambda y: y.cast("int")),
        "data": F.try_to_date(part(4), "yyyyMMdd"),
        "formato": part(5),
    }


def _base_name(level: str, years: Sequence[int], day: str) -> str:
    return "_".join([NAME_PREFIX, level, *[str(y) for y in sorted(years)], day])


# --- writers -------------------------------------------------------------------


# A backslash is written twice, a line feed as \\n, a carriage return as \\r.
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def _escape_breaks(text: Column) -> Column:
    for plain, written in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def _restore_breaks(text: Column) -> Column:
    # every second part of a split at doubled backslashes is free of them
    parts = F.transform(
        F.split(text, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    )
    return F.array_join(parts, "\\")


def _in_texts(df: DataFrame, change) -> DataFrame:
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[change(F.col(c)).alias(c) if c in texts else c for c in df.columns])


def write_csv(
    df: DataFrame, path: str, order: Sequence[str] = fv.RAW_COLUMNS, single_file: bool = False, escaped: bool = False
) -> None:
    """CSV with header and fixed column order, one part per task.

    `single_file=True` gives one part that starts with a byte-order mark for
    spreadsheet programs; use it for small exports only. `escaped=True` writes line
    breaks as backslash sequences, so that any reader of lines can take the files; read them back
    with `read_csv(..., escaped=True)`. Otherwise values with breaks are quoted, which
    `read_csv` finds. CSV has no sign for an empty text: it is read back as NULL.
    """
    out = project_ordered(df, order)
    if escaped:
        out = _in_texts(out, _escape_breaks)
    if single_file:
        first, *rest = out.columns
        out = out.select(F.col(first).alias("﻿" + first), *rest).coalesce(1)
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def json_envelopes(
    snapshot: DataFrame,
    level: str,
    years: Sequence[int],
    collected_at: str,
    per_document: int = 10_000,
    source: str = fv.SOURCE_NAME,
    table: str = fv.TABLE_CODE,
) -> DataFrame:
    """Metadata envelopes around at most `per_document` records each.

    `snapshot` is read from Parquet files: a record's document is given by its file
    and row number there, so documents stay small and a retried task rebuilds the
    same ones. `total_registros` counts the records of the whole snapshot.
    """
    total = snapshot.agg(F.count(F.lit(1))).scalar()
    chunk = [
        F.col("_metadata.file_path").alias("_file"),
        F.floor(F.col("_metadata.row_index") / per_document).alias("_chunk"),
    ]
    documents = (
        snapshot.select(*chunk, F.struct(*snapshot.columns).alias("_record"))
        .groupBy("_file", "_chunk")
        .agg(F.collect_list("_record").alias("registros"))
    )
    return documents.select(
        F.lit(source).alias("fonte"),
        F.lit(table).alias("tabela"),
        F.lit(level).alias("nivel"),
        F.array(*[F.lit(y).cast("bigint") for y in years]).alias("anos"),
        total.alias("total_registros"),
        F.lit(collected_at).alias("coletado_em"),
        "registros",
    )


def write_json(envelopes: DataFrame, path: str) -> None:
    """One envelope per line, so the file stays splittable. NULL fields are kept."""
    envelopes.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_raw_layer(
    df: DataFrame, root: str, level: str, years: Sequence[int], day: str, collected_at: str
) -> Mapping[str, str]:
    """Save one frame in three formats under one snapshot name: format -> path.

    The frame is computed once, for the Parquet copy; the other formats and every
    count are taken from that copy.
    """
    name = _base_name(level, years, day)
    paths = {fmt: f"{root}/{fmt}/{name}.{fmt}" for fmt in FORMATS}
    write_parquet(project_ordered(df), paths["parquet"])
    snapshot = df.sparkSession.read.parquet(paths["parquet"])
    write_csv(snapshot, paths["csv"])
    write_json(json_envelopes(snapshot, level, years, collected_at), paths["json"])
    return paths


# --- readers -------------------------------------------------------------------


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = schemas.RAW_WIDE,
    escaped: bool = False,
) -> DataFrame:
    """CSV with header; a byte-order mark is dropped.

    If a quoted value of the files holds a line break, rows are put together from lines by the
    quotes before them (`pieces`), so files are split among tasks either way. `escaped=True` is
    for files that were written with it, whose lines are rows.
    """
    if not escaped and has_quoted_breaks(spark, path):
        return parse_csv(csv_records(spark, path), schema, CSV_OPTIONS)
    rows = spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
    return _in_texts(rows, _restore_breaks) if escaped else rows


def read_json_envelopes(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Records out of envelopes. `multi_line=True` reads one indented document per file."""
    docs = spark.read.schema(schemas.ENVELOPE).option("multiLine", multi_line).json(path)
    return docs.select(F.inline("registros"))


def list_snapshots(spark: SparkSession, folder: str, suffix: str = "csv") -> DataFrame:
    """(path, base, nivel, anos, data, formato) of the snapshots in a folder.

    Only file names are listed; no file content is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(f"{folder}/{NAME_PREFIX}_*.{suffix}")
    )
    path = F.regexp_extract("path", rf"^(.*/{NAME_PREFIX}_[^/]*\.{suffix})(?:/|$)", 1)
    listed = files.select(path.alias("path")).distinct()
    return listed.select("path", *[c.alias(n) for n, c in parse_snapshot_name(F.col("path")).items()])


def newest_snapshot(
    spark: SparkSession, folder: str, by: str = "name", suffix: str = "csv"
) -> str | None:
    """Path of the newest snapshot, or None.

    `by="name"` takes the last file name, so level and years outrank the date;
    `by="date"` takes the latest date in the name.
    """
    if by not in ("name", "date"):
        raise ValueError(f"unknown order {by!r}")
    name = F.element_at(F.split("path", "/"), -1)
    rank = name if by == "name" else F.struct("data", name.alias("name"))
    try:
        listed = list_snapshots(spark, folder, suffix)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if by == "date":
        listed = listed.where(F.col("data").isNotNull())
    return listed.agg(F.max_by("path", rank).alias("path")).first()["path"]


def scan_latest_snapshot(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = schemas.RAW_WIDE,
    by: str = "name",
) -> DataFrame:
    """The newest CSV snapshot; older ones are not opened."""
    path = newest_snapshot(spark, folder, by)
    if path is None:
        return spark.createDataFrame([], schema)
    return read_csv(spark, path, schema)


def first_available(sources: Mapping[str, DataFrame], tag: str = "fonte_carga") -> DataFrame:
    """The first source with any row, tagged with its name (the last one if all are empty)."""
    *preferred, last = sources.items()
    for name, df in preferred:
        if not df.isEmpty():
            return df.withColumn(tag, F.lit(name))
    name, df = last
    return df.withColumn(tag, F.lit(name))


# --- manifest ------------------------------------------------------------------


def snapshot_files(
    spark: SparkSession, paths: Mapping[str, str], rows: Column | int | None = None
) -> DataFrame:
    """(formato, path, linhas, tamanho_bytes, tamanho_kb) per written format."""
    listed = spark.read.format("binaryFile").load(list(paths.values())).select("path", "length")
    fmt = parse_snapshot_name(F.col("path"))["formato"]
    root = lookup_or(fmt, paths, F.lit(None).cast("string"))
    sizes = (
        listed.select(fmt.alias("formato"), root.alias("path"), "length")
        .groupBy("formato", "path")
        .agg(F.sum("length").alias("tamanho_bytes"))
    )
    counted = rows if isinstance(rows, Column) else F.lit(rows)
    return sizes.select(
        "formato",
        "path",
        counted.cast("bigint").alias("linhas"),
        "tamanho_bytes",
        round_half_even(F.col("tamanho_bytes") / 1024, 2).alias("tamanho_kb"),
    )


def manifest(
    files: DataFrame,
    pipeline: str,
    level: str,
    years: Sequence[int],
    created_at: str,
    source: str = fv.SOURCE_NAME,
    table: str = fv.TABLE_CODE,
) -> DataFrame:
    """One nested row describing a snapshot; `arquivos` maps format to file facts.

    `files` comes from `snapshot_files`: one row per format.
    """
    facts = F.struct(
        "path", "formato", "linhas", "tamanho_bytes", "tamanho_kb", F.lit(created_at).alias("salvo_em")
    )
    entries = F.array_sort(F.collect_list(F.struct("formato", facts.alias("facts"))))
    return files.agg(F.map_from_entries(entries).alias("arquivos"), F.max("linhas").alias("n")).select(
        F.lit(pipeline).alias("pipeline"),
        F.lit("raw").alias("camada"),
        F.lit(source).alias("fonte"),
        F.lit(table).alias("tabela"),
        F.lit(level).alias("nivel"),
        F.array(*[F.lit(y) for y in years]).alias("anos"),
        F.col("n").alias("total_linhas"),
        F.lit(created_at).alias("gerado_em"),
        "arquivos",
    )


def write_manifest(described: DataFrame, root: str) -> str:
    """Save the one-row manifest as JSON at the root of the raw layer; returns its path."""
    path = f"{root}/manifesto.json"
    described.write.mode("overwrite").json(path)
    return path


def format_size_report(files: DataFrame, baseline: str = "csv") -> DataFrame:
    """Size of each format as a percentage of the CSV size."""
    base = files.where(F.col("formato") == baseline).agg(F.max("tamanho_bytes")).scalar()
    return files.select(
        "formato",
        "tamanho_kb",
        round_half_even(F.try_divide(F.col("tamanho_bytes") * 100.0, base), 1).alias("pct_do_csv"),
    )
