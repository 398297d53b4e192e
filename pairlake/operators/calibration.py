"""Threshold sweeps and synthetic negatives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairlake.operators.evaluation import ranked


def sweep(samples: DataFrame, steps: int = 19, step: float = 0.05) -> DataFrame:
    """(layer, threshold, tp, fp, fn, precision, recall) over samples (layer, score, is_positive).

    A sample passes all thresholds up to its score, so it is counted once at the last one it passes;
    running sums over the grid (some twenty rows a layer) give the counts. Samples are read once and
    reduced by partial aggregation, they are not multiplied by the grid. A null score counts as 0.
    """
    from pyspark.sql import Window

    last = F.least(F.lit(steps), F.floor(F.round(F.coalesce("score", F.lit(0.0)) / step, 9))).cast("int")
    counts = samples.groupBy("layer", F.greatest(F.lit(0), last).alias("k")).agg(F.count_if("is_positive").alias("p"), F.count_if(~F.col("is_positive")).alias("n"))
    grid = counts.select("layer").distinct().select("layer", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("k"))
    full = grid.join(counts, ["layer", "k"], "left").withColumns({"p": F.coalesce("p", F.lit(0)), "n": F.coalesce("n", F.lit(0))})
    up = Window.partitionBy("layer").orderBy(F.desc("k"))
    run = full.withColumns({"tp": F.sum("p").over(up), "fp": F.sum("n").over(up), "all_p": F.sum("p").over(Window.partitionBy("layer"))}).where("k > 0")
    out = run.select("layer", F.round(F.col("k") * step, 4).alias("threshold"), "tp", "fp", (F.col("all_p") - F.col("tp")).alias("fn"))
    return out.withColumns({"precision": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(1.0)), "recall": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0))})


def best_threshold(swept: DataFrame, precision: float = 0.9, recall: float = 0.8) -> DataFrame:
    """(layer, threshold): the highest with enough precision and recall, else the lowest of the grid."""
    ok = (F.col("precision") >= precision) & (F.col("recall") >= recall)
    return swept.groupBy("layer").agg(F.coalesce(F.max(F.when(ok, F.col("threshold"))), F.min("threshold")).alias("threshold"))


def synthetic_negatives(positives: DataFrame, id_col: str, score: str, seed: str = "42", block: int = 100_000) -> DataFrame:
    """(id, other_id, score): the first half of the positives in a random order with the second half.

    The order is that of md5(id:seed), the same in every engine, ranked over the whole table without sorting
    it in one task: rank k goes with rank k + floor(n / 2), the last row of an odd number is left over.
    ``block`` has no effect on the rows and is only kept for callers that name it.
    """
    rows = positives.select(F.col(id_col).alias("id"), F.coalesce(F.col(score), F.lit(0.0)).alias("s"))
    half = F.floor(F.col("n") / 2)
    k = ranked(rows, "id", [], seed).where(F.col("rank") <= 2 * half).withColumn("first", F.col("rank") <= half)
    # both rows of a pair have one key, so they meet in one shuffle
    one = lambda first, c: F.max(F.when(F.col("first") == first, F.col(c)))
    pairs = k.groupBy(F.when(F.col("first"), F.col("rank")).otherwise(F.col("rank") - half).alias("k")).agg(one(True, "id").alias("id"), one(False, "id").alias("other_id"), F.sum("s").alias("s"))
    return pairs.select("id", "other_id", F.round(F.greatest(F.lit(0.0), F.col("s") / 2 - 0.3), 6).alias("score"))
