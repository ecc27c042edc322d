"""Star-schema loads: keys, insert-if-absent dimensions, partial-column upserts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropspark import fixed_values as fv
from cropspark.session import written_once


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key by `order`; an aggregation, so a hot key combines early."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return first.select(*keys, "_row.*").select(*df.columns)


def number_rows(
    df: DataFrame, order: Sequence[str], out: str, start: Column | int = 0
) -> DataFrame:
    """Consecutive numbers start+1, start+2, ... by `order`, without one big task.

    Rows are range-partitioned and written to the shared folder, so the partition
    of a row is fixed. The running total of partition sizes has one row
    per partition, which bounds what is broadcast.
    """
    start = F.lit(start) if isinstance(start, int) else start
    parts = written_once(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn(out, start + F.col("_offset") + within)
        .drop("_part", "_offset")
    )


def new_keys(existing: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose key the table does not hold yet."""
    return candidates.na.drop(subset=list(keys)).join(
        existing.select(*keys), list(keys), "left_anti"
    )


def insert_if_absent(
    existing: DataFrame, candidates: DataFrame, keys: Sequence[str], id_column: str
) -> DataFrame:
    """`existing` plus the new candidates; old ids stay, new ids follow the highest."""
    fresh = new_keys(existing, candidates, keys).select(
        *[c for c in existing.columns if c != id_column]
    )
    highest = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("m")).scalar()
    kind = existing.schema[id_column].dataType
    numbered = number_rows(fresh, keys, id_column, highest)
    return existing.unionByName(
        numbered.withColumn(id_column, F.col(id_column).cast(kind)).select(*existing.columns)
    )


def load_dim_commodity(existing: DataFrame, rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Products by code: first name and unit win, missing unit gets the default."""
    candidates = keep_first(
        rows.select("produto_cod", "produto", "unidade_qtd", *order), ["produto_cod"], order
    ).select(
        F.col("produto_cod").alias("codigo_sidra"),
        F.col("produto").alias("nome_oficial"),
        F.coalesce("unidade_qtd", F.lit(fv.DEFAULT_UNIT)).alias("unidade_medida"),
    )
    return insert_if_absent(existing, candidates, ["codigo_sidra"], "id_commodity")


def load_dim_territory(existing: DataFrame, rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Places by (code, level): the same code may exist at several levels."""
    keys = ["codigo_ibge", "nivel_territorial"]
    places = rows.select(
        F.col("cod_territorial").alias("codigo_ibge"),
        F.col("nome_territorial").alias("nome"),
        "nivel_territorial",
        *order,
    )
    candidates = keep_first(places, keys, order)
    return insert_if_absent(existing, candidates, keys, "id_territorio")


def resolve_fact_keys(
    rows: DataFrame, dim_commodity: DataFrame, dim_territory: DataFrame
) -> DataFrame:
    """Rows with both surrogate keys; a key the dimension lacks is NULL."""
    products = dim_commodity.select(F.col("codigo_sidra").alias("produto_cod"), "id_commodity")
    places = dim_territory.select(
        F.col("codigo_ibge").alias("cod_territorial"), "nivel_territorial", "id_territorio"
    )
    return rows.join(products, "produto_cod", "left").join(
        places, ["cod_territorial", "nivel_territorial"], "left"
    )


def has_both_keys() -> Column:
    return F.col("id_commodity").isNotNull() & F.col("id_territorio").isNotNull()


def unique_batch(
    batch: DataFrame, keys: Sequence[str], on_duplicate: str = "fail", order: Sequence[str] = ()
) -> DataFrame:
    """One row per key. "fail" raises on a repeated key, "last" keeps the last by `order`.

    A NULL key part equals nothing, so such rows have no conflict key; the key columns don't
    take NULL, and `without_key` gives these rows for a report.
    """
    if on_duplicate not in ("fail", "last"):
        raise ValueError(f"unknown duplicate rule {on_duplicate!r}")
    if on_duplicate == "last" and not order:
        raise ValueError('"last" needs an order')
    batch = batch.na.drop(subset=list(keys))
    if on_duplicate == "fail":
        copies = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
        bad = F.raise_error(F.lit("the batch holds a conflict key twice")).cast("boolean")
        return batch.join(copies.where(bad).select(*keys), list(keys), "left_anti")
    rest = [c for c in batch.columns if c not in keys]
    position = F.struct(*order) if order else F.struct(*rest)
    grouped = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), position).alias("_row"))
    return grouped.select(*keys, "_row.*").select(*batch.columns)


def without_key(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that no upsert can store: a part of the conflict key is NULL."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return batch.where(missing)


def upsert(
    base: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    on_duplicate: str = "fail",
    order: Sequence[str] = (),
    checked: bool = False,
) -> DataFrame:
    """Insert new keys; on a known key overwrite only the `update` columns.

    One full outer join on the conflict key: both sides hold a key once, so no key
    is hot. Columns the batch lacks keep the base value and are NULL on new rows.
    `checked=True` is for a batch that has been through `unique_batch`.
    """
    incoming = batch if checked else unique_batch(batch, keys, on_duplicate, order)
    fresh = {c: f"_new_{c}" for c in incoming.columns}
    right = incoming.withColumnsRenamed(fresh).withColumn("_in_batch", F.lit(True))
    left = base.withColumn("_in_base", F.lit(True))
    joined = left.join(right, [left[k] == right[fresh[k]] for k in keys], "full_outer")

    def merged(name: str) -> Column:
        if name not in fresh:
            return F.col(name)
        old, new = F.col(name), F.col(fresh[name])
        if name in update:
            return F.when(F.col("_in_batch"), new).otherwise(old).alias(name)
        return F.when(F.col("_in_base"), old).otherwise(new).alias(name)

    return joined.select(*[merged(c) for c in base.columns])


def upsert_processed(base: DataFrame, batch: DataFrame, **options) -> DataFrame:
    return upsert(base, batch, fv.PROCESSED_KEYS, fv.PROCESSED_UPDATES, **options)


def upsert_fact(base: DataFrame, batch: DataFrame, **options) -> DataFrame:
    return upsert(base, batch, fv.FACT_KEYS, fv.FACT_UPDATES, **options)
