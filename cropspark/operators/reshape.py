"""Long cells to wide rows, and the unit column that comes with them."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropspark import fixed_values as fv


def pivot_first_nonnull(
    cells: DataFrame,
    keys: Sequence[str] = fv.PIVOT_KEYS,
    variables: Sequence[str] = fv.METRICS,
    variable: str = "variavel_col",
    value: str = "valor",
    order: str = "posicao",
) -> DataFrame:
    """One row per key, one column per variable, first non-NULL value by `order`.

    A key whose values are all NULL, or with a NULL key column, gives no row. The
    variable list is explicit, so the result is one aggregation with map-side
    combine and no pass to discover values; a variable without cells is NULL.
    """
    usable = cells.where(F.col(value).isNotNull()).na.drop(subset=list(keys))
    return usable.groupBy(*keys).agg(
        *[
            F.min_by(value, F.when(F.col(variable) == name, F.col(order))).alias(name)
            for name in variables
        ]
    )


def attach_unit(
    wide: DataFrame,
    cells: DataFrame,
    keys: Sequence[str] = fv.UNIT_KEYS,
    variable: str = "variavel_col",
    of_variable: str = "qtd_produzida",
    unit: str = "unidade_api",
    out: str = "unidade_qtd",
) -> DataFrame:
    """Left join of the unit seen on the quantity cells; NULL keys match NULL keys.

    The keys leave out the territorial level, so two units for one key give two rows.
    """
    side = [f"_u_{k}" for k in keys]
    units = (
        cells.where(F.col(variable) == of_variable)
        .select(*[F.col(k).alias(s) for k, s in zip(keys, side)], F.col(unit).alias(out))
        .distinct()
    )
    match = [wide[k].eqNullSafe(units[s]) for k, s in zip(keys, side)]
    return wide.join(units, match, "left").drop(*side)
