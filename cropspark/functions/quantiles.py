"""Exact percentiles without bringing a whole group into one task.

Spark's `percentile` keeps every distinct value of a group in one buffer. Here a
mergeable sketch first brackets each wanted rank, rows outside the brackets are
folded into per-gap counts on the map side, and only the few values inside the
brackets are put in order. A group that holds most of the table therefore still
costs one distributed aggregation, and the rows themselves are shuffled only if the
sketches are too many to broadcast.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cropspark.session import written_once


def _running_counts(cells, by):
    """`_start` and `_end` of each cell in the order of its group.

    Cells are range-partitioned in that order and written, so a large group lies in many
    partitions. What stands before a partition comes from one row per group and partition;
    the running count inside it is a window over that partition only.
    """
    order = [F.col("_at").asc_nulls_first(), F.col("_gap").asc_nulls_first()]
    spread = cells.repartitionByRange(*[F.col(c).asc_nulls_first() for c in by], *order)
    parts = written_once(spread.withColumn("_part", F.spark_partition_id()), "cells")
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy(*by, "_part").agg(F.sum("_c").alias("_s"))
    offsets = offsets.withColumn("_offset", F.coalesce(F.sum("_s").over(before), F.lit(0)))
    keys = {c: f"_o{i}" for i, c in enumerate(by)}
    side = offsets.select(*[F.col(c).alias(k) for c, k in keys.items()], F.col("_part").alias("_p"), "_offset")
    same = parts["_part"] == side["_p"]
    for c, k in keys.items():
        same = same & parts[c].eqNullSafe(side[k])
    within = Window.partitionBy("_part", *by).orderBy(*order)
    placed = parts.join(side, same).drop("_p", *keys.values())
    placed = placed.withColumn("_end", F.col("_offset") + F.sum("_c").over(within))
    return placed.withColumn("_start", F.col("_end") - F.col("_c"))


def exact_percentiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    few_groups: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Linear-interpolation percentiles of `value` per `by` group.

    `probs` maps output column names to probabilities; `n` is the count of
    non-missing values. Rows with a NULL group key are kept as their own group.
    `few_groups=True` states that the number of groups is a small constant of the
    caller (for example the metric columns), so the sketches may be broadcast.
    With `by` empty the result is a single row.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v"))
    rows = rows.where(F.col("_v").isNotNull() & ~F.isnan("_v"))

    margin = 2.0 / accuracy
    edges = [edge for p in probs.values() for edge in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", edges, accuracy).alias("_edges"),
    )

    if by:
        keys = [f"_k{i}" for i in range(len(by))]
        side = sketch.withColumnsRenamed(dict(zip(by, keys)))
        # Written, the sketches have a measured size, on which Catalyst decides.
        side = F.broadcast(side) if few_groups else written_once(side, "sketch")
        same_group = F.lit(True)
        for name, key in zip(by, keys):
            same_group = same_group & rows[name].eqNullSafe(side[key])
        rows = rows.join(side, same_group).drop(*keys)
    else:
        bounds = sketch.select(F.struct("_edges", "_n").alias("_s")).scalar()
        rows = rows.withColumn("_s", bounds).select("_v", "_s._edges", "_s._n")

    v = F.col("_v")
    brackets = [(F.col("_edges")[2 * i], F.col("_edges")[2 * i + 1]) for i in range(len(probs))]
    inside = F.lit(False)
    for low, high in brackets:
        inside = inside | v.between(low, high)
    gap_starts = [F.when(high < v, high) for _, high in brackets]
    gap_start = F.greatest(*gap_starts) if len(gap_starts) > 1 else gap_starts[0]

    # One cell per distinct value inside a bracket, one cell per gap between brackets.
    cells = (
        rows.select(
            *by, "_n", "_v",
            F.when(inside, v).otherwise(gap_start).alias("_at"),
            (~inside).alias("_gap"),
        )
        .groupBy(*by, "_at", "_gap")
        .agg(
            F.count(F.lit(1)).alias("_c"),
            F.min("_v").alias("_lo"),
            F.max("_v").alias("_hi"),
            F.max("_n").alias("_n"),
        )
    )
    ranked = _running_counts(cells, by)

    def at_rank(rank):
        found = (
            F.when(F.col("_lo") == F.col("_hi"), F.col("_lo"))
            .when(rank == F.col("_start"), F.col("_lo"))
            .when(rank == F.col("_end") - 1, F.col("_hi"))
            .otherwise(F.raise_error(F.lit("percentile rank fell outside its bracket")).cast("double"))
        )
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), found))

    aggs = [F.max("_n").alias("n")]
    for name, p in probs.items():
        position = (F.col("_n") - 1) * F.lit(float(p))
        lower = F.floor(position)
        upper = F.ceil(position)
        aggs += [
            at_rank(lower).alias(f"_lower_{name}"),
            at_rank(upper).alias(f"_upper_{name}"),
            F.max(position - lower).alias(f"_part_{name}"),
        ]
    found = ranked.groupBy(*by).agg(*aggs)
    return found.select(
        *by,
        "n",
        *[
            (
                F.col(f"_lower_{name}")
                + (F.col(f"_upper_{name}") - F.col(f"_lower_{name}")) * F.col(f"_part_{name}")
            ).alias(name)
            for name in probs
        ],
    )
