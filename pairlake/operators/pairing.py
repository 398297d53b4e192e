"""Pairs from positions: zip, neighbours, halves, first two; first wins; first strategy that finds something.

All take a DataFrame of elements with a container (page, section, listing) and
a position, and stay within one shuffle by the container. Containers are pages:
bounded groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def zip_pairs(items: DataFrame, by: list[str], role: Column, order: list[str], value: str) -> DataFrame:
    """(by, n, before, after): the n-th item of role 'before' with the n-th of role 'after'; the longer list is cut."""
    ranked = items.withColumn("role_", role).where("role_ in ('before', 'after')").withColumn("n", F.row_number().over(Window.partitionBy(*by, "role_").orderBy(*order)))
    side = lambda r: F.max(F.when(F.col("role_") == r, F.col(value)))
    both = ranked.groupBy(*by, "n").agg(side("before").alias("before"), side("after").alias("after"), F.count_distinct("role_").alias("c"))
    return both.where("c = 2").drop("c")


def adjacent_pairs(items: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """(by, n, before, after): items 1 and 2, 3 and 4, ... of a container; an odd last one is left."""
    w = Window.partitionBy(*by).orderBy(*order)
    k = items.withColumns({"k_": F.row_number().over(w), "after": F.lead(value).over(w), "has_": F.lead(F.lit(1)).over(w)})
    return k.where("k_ % 2 = 1 and has_ = 1").select(*by, ((F.col("k_") + 1) / 2).cast("int").alias("n"), F.col(value).alias("before"), "after")


def first_two(items: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """(by, before, after): the first two items of each container that has two."""
    return adjacent_pairs(items, by, order, value).where("n = 1").drop("n")


def half_split(items: DataFrame, by: list[str], order: list[str], value: str, most: int | None = None) -> DataFrame:
    """(by, n, before, after): the first half of a container's items with the second half, in order."""
    k = items.withColumns({"k_": F.row_number().over(Window.partitionBy(*by).orderBy(*order)), "half_": F.floor(F.count(F.lit(1)).over(Window.partitionBy(*by)) / 2)})
    k = k.withColumn("n", F.when(F.col("k_") <= F.col("half_"), F.col("k_")).otherwise(F.col("k_") - F.col("half_"))).where("n <= half_")
    out = k.groupBy(*by, "n").agg(F.max(F.when(F.col("k_") <= F.col("half_"), F.col(value))).alias("before"), F.max(F.when(F.col("k_") > F.col("half_"), F.col(value))).alias("after"))
    return out.where(F.col("n") <= most) if most else out


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in order: ``max_by`` with partial aggregation, no window and no sort."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*keys).agg(best.alias("x")).select(*keys, "x.*").select(*rows.columns)


def first_strategy(found: DataFrame, by: list[str], strategy: str) -> DataFrame:
    """Of results tagged with the number of their strategy, those of the first strategy that found anything for a container."""
    return found.withColumn("least_", F.min(strategy).over(Window.partitionBy(*by))).where(F.col(strategy) == F.col("least_")).drop("least_")


def distinct_pairs(pairs: DataFrame, order: list[str], before: str = "before", after: str = "after") -> DataFrame:
    """Pairs of several strategies, each pair once, as it came first."""
    return first_wins(pairs, [before, after], order)
