"""Percentiles of very large numeric columns, from cumulative frequencies.

Values are put on a fixed grid (the error of a percentile is at most half a
step; a step of 0 keeps values as they are and the percentiles are exact) and
reduced to counts per group and value with partial aggregation. These counts
are the result that combines: counts of other days, files or partitions are
added by ``merge`` and percentiles of the sum are those of all rows together.

From counts to percentiles, values are range-partitioned: a coarse range is
the leading part of the value's order, running sums over a group's ranges give
each range's offset, and only the ranges that hold a target rank have their
values summed up; the first value that reaches a target rank is taken. So no
task ever gets all values of a group, also if one group has a third of them.

The p-th percentile is the smallest value with at least p * n values at or
below it (p = 0: the smallest value).

Cases: null, NaN and infinite values don't count; rows delivered twice count
once where an id column is given; a group without values has no row; null
groups are groups of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values fall into this many ranges per power of two.
RANGES = 256


def finite(value: Column) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def on_grid(value: Column, step: float) -> Column:
    return (F.round(value / step) * step if step else value) + F.lit(0.0)


def value_counts(rows: DataFrame, groups: list[str], value: str) -> DataFrame:
    """(groups, value, n): the counts that combine."""
    return rows.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def merge(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The counts of all parts together."""
    out = first
    for o in others:
        out = out.unionByName(o)
    return out.groupBy(*[c for c in first.columns if c != "n"]).agg(F.sum("n").alias("n"))


def _range(value: Column) -> Column:
    """Order-preserving coarse key: sign, power of two and the leading part of the rest."""
    size = F.abs(value)
    power = F.floor(F.log2(F.greatest(size, F.lit(1e-300))))
    part = F.least(F.lit(RANGES - 1), F.floor((size / F.pow(F.lit(2.0), power) - 1) * RANGES))
    key = (power + 1100) * RANGES + F.greatest(part, F.lit(0))
    return F.when(value == 0, F.lit(0)).otherwise(F.when(value > 0, key).otherwise(-key)).cast("long")


def percentiles(counts: DataFrame, groups: list[str], points: list[float]) -> DataFrame:
    """(groups, p, value, n) of counts (groups, value, n), which are read twice: give them written.

    Values move with a 128-bit key of their group, or the group itself where it is one whole number; the groups'
    own columns go with the few ranges that hold a target rank.
    """
    own = [F.col(g).alias(f"own_{g}") for g in groups]
    flags = [c for g in groups for c in (F.col(g).isNull(), F.col(g))]
    number = len(groups) == 1 and dict(counts.dtypes)[groups[0]] == "bigint"
    keys = [F.coalesce(groups[0], F.lit(0).cast("long")).alias("k1"), F.col(groups[0]).isNull().alias("k2")] if number else [F.xxhash64(F.lit(s), *flags).alias(f"k{s}") for s in (1, 2)]
    keyed = counts.select(*own, *keys, _range(F.col("value")).alias("r"), "value", "n")
    ranges = keyed.groupBy("k1", "k2", "r", *([] if number else [f"own_{g}" for g in groups])).agg(F.sum("n").alias("c"))
    if number:
        ranges = ranges.withColumn(f"own_{groups[0]}", F.when(~F.col("k2"), F.col("k1")))
    group = Window.partitionBy("k1", "k2")
    offsets = ranges.withColumns({"upto": F.sum("c").over(group.orderBy("r")), "total": F.sum("c").over(group)})
    reached = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.greatest(F.lit(1.0), F.ceil(F.round(F.lit(float(p)) * F.col("total"), 6))).alias("rank")) for p in points])
    inside = F.filter(reached, lambda x: (F.col("upto") >= x["rank"]) & (F.col("upto") - F.col("c") < x["rank"]))
    wanted = offsets.withColumn("ps", inside).where(F.size("ps") > 0).withColumn("before", F.col("upto") - F.col("c")).drop("upto", "c")
    values = keyed.select("k1", "k2", "r", "value", "n").join(wanted, ["k1", "k2", "r"])
    run = F.col("before") + F.sum("n").over(Window.partitionBy("k1", "k2", "r").orderBy("value"))
    hit = values.withColumn("upto", run).withColumn("hits", F.filter("ps", lambda x: (F.col("upto") >= x["rank"]) & (F.col("upto") - F.col("n") < x["rank"])))
    return hit.where(F.size("hits") > 0).select(*[F.col(f"own_{g}").alias(g) for g in groups], F.explode(F.col("hits.p")).alias("p"), "value", F.col("total").alias("n"))
