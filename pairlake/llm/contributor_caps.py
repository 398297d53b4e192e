"""Caps on records per dominant contributor, nested (a laminar matroid).

Levels go from the innermost contributor (author) outwards (domain, parent
organisation). Each pass keeps the best records of every contributor of its
level, up to its cap, among what the inner passes kept; on nested groups that
greedy choice has the largest total score.

A pass never ranks all records of a contributor in one task. Order is
``score`` descending (records without a usable score last), then id. Caps up to
``SMALL`` are a ranked window whose limit is applied before the shuffle, so a
contributor sends at most its cap from each task. For larger caps the cutoff (score,
id) of every contributor above its cap is selected by counts in bins
(``selection.kth``, first among scores, then among the ids of the score at the
cutoff), and records are compared with it. All counts are partially aggregated, so a
contributor with a third of all records costs no more than others. Tables of one row
per capped contributor are sent to all tasks where their number is checked to be small.

Cases: null contributors are groups of their own kind and never capped; null,
NaN and out-of-range scores come last; ties go to the smaller id; a record
delivered twice under one id counts once; an empty table gives an empty result.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairlake.llm.pictures import usable
from pairlake.llm.selection import joined, kth
from pairlake.runtime import bounded, cut

SMALL = 100


def cutoffs(rows: DataFrame, group: list[str], cap: int) -> DataFrame:
    """(group, rank_, id_) of the last record that each group above ``cap`` keeps; rows: group, rank, id."""
    over = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("lo_"), F.max("rank").alias("hi_")).where(F.col("n") > cap)
    scores = cut(kth(rows, over.withColumn("left", F.lit(cap).cast("long")), group, "rank"))
    at = joined(rows, scores.select(*group, "rank_", "left"), group).where(F.col("rank") == F.col("rank_")).select(*group, "id", "left")
    ids = at.groupBy(*group, "left").agg(F.min("id").alias("lo_"), F.max("id").alias("hi_"))
    last = kth(at.drop("left"), ids, group, "id").select(*group, "id_")
    return cut(scores.select(*group, "rank_").join(last, group))


def cap_pass(rows: DataFrame, group: list[str], cap: int) -> DataFrame:
    """The rows (group columns, rank, id) within the cap of their group."""
    null = " or ".join(f"`{g}` is null" for g in group)
    if cap < 1:
        return rows.where(null)
    known = rows.where(f"not ({null})")
    if cap <= SMALL:
        best = known.withColumn("rn_", F.row_number().over(Window.partitionBy(*group).orderBy("rank", "id"))).where(F.col("rn_") <= cap)
        return best.select(*rows.columns).unionByName(rows.where(null))
    last = cutoffs(known, group, cap)
    out = rows.join(F.broadcast(last) if bounded(last) else last, group, "left")
    return out.where(F.col("rank_").isNull() | (F.col("rank") < F.col("rank_")) | ((F.col("rank") == F.col("rank_")) & (F.col("id") <= F.col("id_")))).select(*rows.columns)


def ranked_records(records: DataFrame, id_col: str, score: Column, levels: dict[str, Column]) -> DataFrame:
    """(id, level columns, rank): one row per id; rank is minus the score, 1 without a usable one."""
    rows = records.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), *[c.alias(f"level_{k}") for k, c in levels.items()], F.coalesce(F.lit(0.0) - usable(score), F.lit(1.0)).alias("rank")
    )
    firsts = [F.first(c, ignorenulls=True).alias(c) for c in rows.columns if c.startswith("level_")]
    return rows.groupBy("id").agg(*firsts, F.min("rank").alias("rank"))


def nested_caps(rows: DataFrame, caps: list[tuple[str, int | float]], total: int | None = None) -> DataFrame:
    """Rows of ``ranked_records`` that all levels keep; a cap is a number, or a share of all records below 1.

    Levels are given from the innermost outwards; a group is the level's value together with
    those of all outer levels, so that groups are nested.
    """
    names = [f"level_{k}" for k, _ in caps]
    share_of = lambda cap: isinstance(cap, float) and cap < 1
    if total is None and any(share_of(c) for _, c in caps):
        total = rows.count()
    for k, (_, cap) in enumerate(caps):
        share = share_of(cap)
        most = int(total * Fraction(cap).limit_denominator(1_000_000)) if share else int(cap)
        rows = cap_pass(rows, names[k:], most)
        if k + 1 < len(caps):
            rows = cut(rows)
    return rows
