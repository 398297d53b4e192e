"""The k-th smallest key of each group without ranking a group in one task.

A group's keys are counted in ``BINS`` equal bins between its least and its
largest key (partial aggregation: a group with a third of all rows is no task of
its own), running sums over the bins find the one that holds rank k, and the
same is repeated with the rows of that bin, until it holds one key only. A window
never gets more than ``BINS`` rows of a group, whatever the keys' distribution. Every
round separates the least from the largest key, so rounds end; each narrows the
range by a factor of ``BINS`` at least, so there are few.

Cases: null keys must be left out before; equal keys stay together; a rank
beyond a group's size gives no row; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairlake.runtime import bounded, cut

BINS = 4096


def joined(rows: DataFrame, few: DataFrame, group: list[str]) -> DataFrame:
    """Rows with the columns of one row per group; sent to all tasks only if its number is checked to be small."""
    return rows.join(F.broadcast(few) if bounded(few) else few, group)


def _bin(key: str, kind: str) -> Column:
    k, lo, hi = F.col(key), F.col("lo_"), F.col("hi_")
    if kind in ("double", "float"):
        return F.when(hi > lo, F.least(F.lit(BINS - 1), F.floor((k - lo) / (hi - lo) * BINS))).otherwise(F.lit(0)).cast("int")
    # the span of keys of both signs may not fit into a whole number: the sign parts them first
    span = F.try_subtract(hi, lo)
    equal = F.expr(f"({key} - lo_) div ((hi_ - lo_) div {BINS} + 1)")
    return F.when(span.isNull(), (k >= 0).cast("int")).otherwise(equal).cast("int")


def kth(rows: DataFrame, ranks: DataFrame, group: list[str], key: str) -> DataFrame:
    """(group, <key>_, left, equal): the key of rank ``left`` of each group; ``left`` of its ``equal`` rows are needed to reach it.

    ranks: one row per group with ``left`` (from 1), ``lo_`` and ``hi_``, its least and largest key.
    """
    kind = dict(rows.dtypes)[key]
    open_, done = cut(ranks.select(*group, "left", "lo_", "hi_")), None
    own = rows.select(*group, key)
    while True:
        # rows are always taken from the table itself, by the ends of the bin: plans don't grow with the rounds
        inside = joined(own, open_, group).where(F.col(key).between(F.col("lo_"), F.col("hi_")))
        counted = inside.groupBy(*group, "left", _bin(key, kind).alias("bin_")).agg(F.count(F.lit(1)).alias("n_"), F.min(key).alias("lo_"), F.max(key).alias("hi_"))
        upto = counted.withColumn("upto_", F.sum("n_").over(Window.partitionBy(*group).orderBy("bin_")))
        hit = upto.where("upto_ >= left and upto_ - n_ < left")
        hit = cut(hit.select(*group, (F.col("left") - F.col("upto_") + F.col("n_")).alias("left"), "lo_", "hi_", "n_"))
        found = hit.where("lo_ = hi_").select(*group, F.col("lo_").alias(f"{key}_"), "left", F.col("n_").alias("equal"))
        done = found if done is None else done.unionByName(found)
        open_ = hit.where("lo_ < hi_").select(*group, "left", "lo_", "hi_")
        if open_.isEmpty():
            return done
