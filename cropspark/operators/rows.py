"""Projections, filters and row-wise clean-up steps."""

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark.functions import numbers as num
from cropspark.functions import text as txt


def _any(conditions: Sequence[Column]) -> Column:
    return functools.reduce(lambda a, b: a | b, conditions)


# --- projections -------------------------------------------------------------


def project_ordered(df: DataFrame, order: Sequence[str] = fv.RAW_COLUMNS) -> DataFrame:
    """The columns of `order` that exist, in that order; other columns are dropped."""
    return df.select(*[name for name in order if name in df.columns])


def rename_if_present(
    df: DataFrame, names: Mapping[str, str] = fv.SECOND_FORM_COLUMNS
) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def add_missing_columns(
    df: DataFrame, names: Sequence[str] = fv.METRICS, kind: str = "double"
) -> DataFrame:
    return df.withColumns(
        {name: F.lit(None).cast(kind) for name in names if name not in df.columns}
    )


def add_lineage(
    df: DataFrame, processed_at: str | Column, version: str = fv.ETL_VERSION
) -> DataFrame:
    """Stamp the run time and version; the time is a parameter, never the clock."""
    moment = F.lit(processed_at) if isinstance(processed_at, str) else processed_at
    return df.withColumns(
        {"processado_em": moment.cast("timestamp_ntz"), "versao_etl": F.lit(version)}
    )


# --- filters -----------------------------------------------------------------


def filter_isin(df: DataFrame, selections: Mapping[str, Sequence]) -> DataFrame:
    """Keep rows whose column is in the selection; an empty selection keeps all."""
    for name, wanted in selections.items():
        if wanted:
            df = df.where(F.col(name).isin(*wanted))
    return df


def drop_any_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.na.drop(how="any", subset=list(names))


def drop_all_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.na.drop(how="all", subset=list(names))


def partial_records(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("status_dado") == fv.STATUS_PARTIAL)
        .select("produto", "ano", *fv.METRICS, "status_dado")
        .orderBy(F.col("ano").desc())
    )


# --- clean-up chain ----------------------------------------------------------


def coerce_types(
    df: DataFrame,
    codes: Sequence[str] = ("produto_cod", "tabela_sidra", "cod_territorial"),
    year: str = "ano",
    timestamps: Sequence[str] = ("coletado_em",),
    metrics: Sequence[str] = fv.METRICS,
    places: int = 2,
) -> DataFrame:
    """Trim codes, coerce year, times and metrics; what cannot be read is NULL."""
    return df.withColumns(
        {
            **{c: txt.strip(F.col(c).cast("string")) for c in codes},
            year: num.to_year(F.col(year)),
            **{c: num.to_timestamp(F.col(c)) for c in timestamps},
            **{c: num.round_half_even(num.to_number(F.col(c)), places) for c in metrics},
        }
    )


def completeness_status(
    df: DataFrame, metrics: Sequence[str] = fv.METRICS, out: str = "status_dado"
) -> DataFrame:
    partial = _any([F.col(c).isNull() for c in metrics])
    return df.withColumn(
        out, F.when(partial, fv.STATUS_PARTIAL).otherwise(fv.STATUS_COMPLETE)
    )


def standardize_categories(
    df: DataFrame,
    product: str = "produto",
    original: str = "produto_nome_ibge",
    titled: Sequence[str] = ("nivel_territorial", "nome_territorial"),
    uppered: Sequence[str] = ("unidade_qtd", "fonte"),
    names: Mapping[str, str] = fv.CANONICAL_NAMES,
) -> DataFrame:
    """Canonical product names (original kept), title-case places, upper-case units."""
    return df.withColumns(
        {
            original: txt.strip(F.col(product)),
            product: txt.canonical_name(F.col(product), names),
            **{c: txt.title_case(txt.strip(F.col(c))) for c in titled},
            **{c: F.upper(txt.strip(F.col(c))) for c in uppered},
        }
    )


def _year_ok(year: str, first: int, last: int) -> Column:
    return F.coalesce(txt.bound(F.col(year), lambda y: y.between(first, last)), F.lit(False))


def _code_ok(code: str) -> Column:
    return F.coalesce(txt.is_digits(F.col(code)), F.lit(False))


def validate_rows(
    df: DataFrame,
    year: str = "ano",
    code: str = "produto_cod",
    metrics: Sequence[str] = fv.METRICS,
    min_year: int = fv.YEAR_MIN,
    max_year: int = fv.YEAR_MAX,
) -> DataFrame:
    """Keep rows with a valid year and a numeric code; negative metrics become NULL."""
    kept = df.where(_year_ok(year, min_year, max_year) & _code_ok(code))
    return kept.withColumns({c: num.null_if_negative(F.col(c)) for c in metrics})


def validation_report(
    df: DataFrame,
    year: str = "ano",
    code: str = "produto_cod",
    metrics: Sequence[str] = fv.METRICS,
    min_year: int = fv.YEAR_MIN,
    max_year: int = fv.YEAR_MAX,
) -> DataFrame:
    """What `validate_rows` rejects or changes, counted in one pass: (regra, total)."""
    return counts_as_rows(df, validation_counts(year, code, metrics, min_year, max_year), "regra")


def validation_counts(
    year: str = "ano",
    code: str = "produto_cod",
    metrics: Sequence[str] = fv.METRICS,
    min_year: int = fv.YEAR_MIN,
    max_year: int = fv.YEAR_MAX,
) -> dict[str, Column]:
    """The counts of the report, by rule."""
    year_ok = _year_ok(year, min_year, max_year)
    approved = year_ok & _code_ok(code)
    return {
        "ano inválido": F.count_if(~year_ok),
        "código inválido": F.count_if(year_ok & ~_code_ok(code)),
        **{f"negativo em {c}": F.count_if(approved & (F.col(c) < 0)) for c in metrics},
        "aprovados": F.count_if(approved),
        "total": F.count(F.lit(1)),
    }


def null_profile(df: DataFrame, metrics: Sequence[str] = fv.METRICS) -> DataFrame:
    """NULL count per metric column: (coluna, nulos)."""
    return counts_as_rows(
        df, {c: F.count_if(F.col(c).isNull()) for c in metrics}, "coluna", "nulos"
    )


def counts_as_rows(
    df: DataFrame, counts: Mapping[str, Column], label: str, total: str = "total"
) -> DataFrame:
    """Several global counts from one pass, one output row per count."""
    entries = [F.struct(F.lit(name).alias(label), c.alias(total)) for name, c in counts.items()]
    return df.agg(F.array(*entries).alias("_entries")).select(F.inline("_entries"))


def clean_rows(
    df: DataFrame,
    processed_at: str | Column,
    min_year: int = fv.YEAR_MIN,
    max_year: int = fv.YEAR_MAX,
    names: Mapping[str, str] = fv.CANONICAL_NAMES,
    version: str = fv.ETL_VERSION,
) -> DataFrame:
    """Raw wide rows to processed rows: types, status, categories, rules, lineage.

    The status is set before negatives become NULL, so a row whose metric was
    negative keeps the status it had as delivered.
    """
    return (
        df.transform(coerce_types)
        .transform(completeness_status)
        .transform(standardize_categories, names=names)
        .transform(validate_rows, min_year=min_year, max_year=max_year)
        .transform(add_lineage, processed_at=processed_at, version=version)
        .transform(project_ordered, order=fv.PROCESSED_COLUMNS)
    )
