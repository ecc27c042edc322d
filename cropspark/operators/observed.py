"""Counts taken in flight: by the job that writes the rows, not by a pass of their own.

Spark collects an observed metric where the rows go past. The observation is put after the last
shuffle, in the stage that writes, in which each partition counts once, however often its tasks are
repeated.
"""

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark.operators import rows as clean
from cropspark.operators import star

Write = Callable[[DataFrame], None]


def observed(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """`df` with counts on the way, and a function that gives them when it has been written."""
    observation = Observation()
    names = {f"c{i}": name for i, name in enumerate(counts)}
    counted = df.observe(observation, *[c.alias(short) for short, c in zip(names, counts.values())])
    return counted, lambda: {name: observation.get[short] for short, name in names.items()}


def _report(df: DataFrame, counts: dict[str, int], label: str) -> DataFrame:
    return df.sparkSession.createDataFrame(list(counts.items()), f"{label} string, total bigint")


def write_validated(df: DataFrame, write: Write, **rules) -> DataFrame:
    """Write the rows that `validate_rows` keeps; returns what `validation_report` would say."""
    passing, counts = observed(df, clean.validation_counts(**rules))
    write(clean.validate_rows(passing, **rules))
    return _report(df, counts(), "regra")


def write_fact(rows: DataFrame, dim_commodity: DataFrame, dim_territory: DataFrame, write: Write) -> DataFrame:
    """Write the rows whose keys both dimensions know; returns (situacao, total) of all rows."""
    both = star.has_both_keys()
    resolved, counts = observed(
        star.resolve_fact_keys(rows, dim_commodity, dim_territory),
        {
            "carregadas": F.count_if(both),
            "ignoradas": F.count_if(~both),
            "sem produto": F.count_if(F.col("id_commodity").isNull()),
            "sem território": F.count_if(F.col("id_territorio").isNull()),
            "lidas": F.count(F.lit(1)),
        },
    )
    write(resolved.where(both))
    return _report(rows, counts(), "situacao")


def write_clean(df: DataFrame, write: Write, processed_at: str | Column, **options) -> DataFrame:
    """Write the processed rows of the whole clean-up; returns the report of its validation."""
    typed = clean.completeness_status(clean.coerce_types(df))
    named = clean.standardize_categories(typed)

    def finish(valid: DataFrame) -> None:
        done = clean.add_lineage(valid, processed_at=processed_at)
        write(clean.project_ordered(done, order=fv.PROCESSED_COLUMNS))

    return write_validated(named, finish, **options)
