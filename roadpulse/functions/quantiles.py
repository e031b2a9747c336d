"""Exact grouped percentiles that never hold a whole group in one task.

The values are first counted per distinct value (combined map-side, spread by value),
then each wanted rank is located in coarse cells, in fine cells, and finally among the
distinct values of one fine cell. Every window runs over cell counts, whose number is
fixed by the cell scales, or over the distinct values of a single cell.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Cells per unit, coarse then fine. Values beyond the linear range share logarithmic cells.
DEFAULT_SCALES = (64.0, 64.0 * 65536.0)
_LINEAR_LIMIT = 512.0


def _cell(value: Column, scale: float) -> Column:
    """Monotone cell number; linear within the usual range, logarithmic beyond it."""
    edge = _LINEAR_LIMIT * scale
    tail = F.floor(F.log2(F.abs(value) / _LINEAR_LIMIT) * scale) + F.lit(edge)
    linear = F.floor(value * scale).cast("double")
    return (
        F.when(F.abs(value) < _LINEAR_LIMIT, linear)
        .when(value > 0, tail.cast("double"))
        .otherwise(-tail.cast("double") - 1)
    )


_TARGET = ["_name", "_side", "_weight", "_rank"]


def _hits(df: DataFrame, group: list[str], bucket: str) -> DataFrame:
    """Rows whose bucket holds the wanted rank, with the rank counted from the bucket's start."""
    running = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    ranged = df.withColumn("_end", F.sum("n").over(running)).withColumn("_start", F.col("_end") - F.col("n"))
    hit = (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end"))
    return ranged.where(hit).withColumn("_rank", F.col("_rank") - F.col("_start")).drop("n", "_start", "_end")


def _first_targets(counts: DataFrame, keys: list[str], cell: str, probabilities: dict[str, float]) -> DataFrame:
    """The coarse cell and rank of both neighbours of every wanted position."""
    per_cell = counts.groupBy(*keys, cell).agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys)
    running = group.orderBy(cell).rowsBetween(Window.unboundedPreceding, 0)
    ranged = per_cell.withColumn("_end", F.sum("n").over(running)).withColumn(
        "_total", F.sum("n").over(group.orderBy(cell).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    )
    sides = []
    for name, p in probabilities.items():
        position = F.lit(float(p)) * (F.col("_total") - 1)
        upper = position - F.floor(position)
        for side, rank, weight in (("lo", F.floor(position), 1 - upper), ("hi", F.ceil(position), upper)):
            sides.append(
                F.struct(
                    F.lit(name).alias("_name"), F.lit(side).alias("_side"), weight.alias("_weight"), rank.alias("_rank")
                )
            )
    start = F.col("_end") - F.col("n")
    wanted = F.filter(F.array(*sides), lambda t: (t["_rank"] >= F.col("_start")) & (t["_rank"] < F.col("_end")))
    return (
        ranged.withColumn("_start", start)
        .select(*keys, cell, "_start", F.explode(wanted).alias("_t"))
        .select(*keys, cell, "_t._name", "_t._side", "_t._weight", (F.col("_t._rank") - F.col("_start")).alias("_rank"))
    )


def exact_percentiles(
    counts: DataFrame,
    keys: list[str],
    value: str,
    probabilities: dict[str, float],
    scales: tuple[float, ...] = DEFAULT_SCALES,
) -> DataFrame:
    """Linearly interpolated percentiles, one column per entry of ``probabilities``.

    ``counts`` has one row per distinct ``(keys, value)`` with its multiplicity in ``n``;
    keys and value must not be null.
    """
    cells = [f"_cell_{i}" for i in range(len(scales))]
    for name, scale in zip(cells, scales):
        counts = counts.withColumn(name, _cell(F.col(value), scale))

    targets = _first_targets(counts, keys, cells[0], probabilities)
    path = [*keys, cells[0]]
    for cell in cells[1:]:
        inside = counts.join(targets, path).groupBy(*path, *_TARGET, cell).agg(F.sum("n").alias("n"))
        targets = _hits(inside, [*path, "_name", "_side"], cell)
        path = [*path, cell]
    inside = counts.join(targets, path).select(*path, *_TARGET, value, "n")
    found = _hits(inside, [*path, "_name", "_side"], value)
    # The weight of an absent neighbour is 0, so an infinite value cannot turn the sum into NaN here.
    share = F.when(F.col("_weight") > 0, F.col(value) * F.col("_weight"))
    picked = [F.sum(F.when(F.col("_name") == name, share)).alias(name) for name in probabilities]
    return found.groupBy(*keys).agg(*picked)


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct values with their multiplicity, the input of ``exact_percentiles``."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
