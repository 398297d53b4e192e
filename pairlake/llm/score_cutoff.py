"""Score cutoffs that keep a target fraction per source, by sketch-bracketed exact selection.

A quantile sketch per source (rank error at most 1/``ACCURACY`` of the source's
records, guaranteed) gives two values between which the cutoff must lie. One
aggregation counts the records above the bracket, and only records inside it
are ordered, by counts in bins that are narrowed until one score is left
(``selection.kth``); the cutoff is exact. If a bracket should not
hold the cutoff, its source is selected from all its values instead.

Sketches and counts are partially aggregated, so a source with a third of all
records is no single task, however its scores are distributed.

Cases: null, NaN and out-of-range scores and records without a source don't
count; ties at the cutoff are all kept, so the kept share may exceed the
target; a target of 0 keeps the records with the largest score, one of 100 or
more keeps all; a source without usable records has no row; of several targets of
one source the largest holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairlake.llm.selection import kth
from pairlake.runtime import cut

ACCURACY = 2000


def cutoffs(records: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, keep_percent, n, need, cutoff, kept) of records (source, score) and targets (source, keep_percent).

    ``records`` is read several times; give it cut.
    """
    own = records.where("source is not null and score is not null").select("source", "score")
    targets = targets.where("source is not null and keep_percent is not null").groupBy("source").agg(F.max("keep_percent").alias("keep_percent"))
    p = F.col("keep_percent") / 100
    # a sketch can't take its percentages from a column, so it is asked for a fixed grid finer than its error allows
    grid = [k / 200 for k in range(201)]
    sketched = own.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("score", grid, ACCURACY).alias("q"))
    at = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - p))
    low, high = F.greatest(F.floor(at * 200) - 1, F.lit(0)), F.least(F.ceil(at * 200) + 1, F.lit(200))
    bracket = cut(
        sketched.join(targets, "source").select(
            "source", "keep_percent", "n", F.greatest(F.lit(1), F.least(F.col("n"), F.ceil(F.col("n") * F.col("keep_percent") / 100))).cast("long").alias("need"),
            F.when(low <= 0, F.lit(float("-inf"))).otherwise(F.element_at("q", (low + 1).cast("int"))).alias("low"),
            F.when(high >= 200, F.lit(float("inf"))).otherwise(F.element_at("q", (high + 1).cast("int"))).alias("high"),
        )
    )
    above = own.join(bracket, "source").groupBy("source").agg(F.count_if(F.col("score") > F.col("high")).alias("above"), F.count_if(F.col("score") >= F.col("low")).alias("reach"))
    checked = bracket.join(above, "source")
    holds = (F.col("above") < F.col("need")) & (F.col("need") <= F.col("reach"))
    checked = cut(
        checked.select(
            "source", "keep_percent", "n", "need", F.when(holds, F.col("above")).otherwise(F.lit(0)).alias("above"),
            F.when(holds, F.col("low")).otherwise(F.lit(float("-inf"))).alias("low"), F.when(holds, F.col("high")).otherwise(F.lit(float("inf"))).alias("high"),
        )
    )
    # the largest scores come first: the smallest of their negatives
    inside = own.join(checked.select("source", "low", "high"), "source").where((F.col("score") >= F.col("low")) & (F.col("score") <= F.col("high"))).select("source", (F.lit(0.0) - F.col("score")).alias("down"))
    ends = inside.groupBy("source").agg(F.min("down").alias("lo_"), F.max("down").alias("hi_"))
    ranks = ends.join(checked.select("source", (F.col("need") - F.col("above")).alias("left")), "source")
    found = kth(inside, ranks, ["source"], "down")
    kept = F.col("need") - F.col("left") + F.col("equal")
    return checked.join(found, "source").select("source", "keep_percent", "n", "need", (F.lit(0.0) - F.col("down_")).alias("cutoff"), kept.alias("kept"))


def tidy(name):
    """Letters and digits of a source name in lower case: spellings of one name agree in it."""
    return F.regexp_replace(F.lower(name), "[^\\p{L}\\p{N}]", "")
