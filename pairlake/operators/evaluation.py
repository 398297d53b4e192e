"""Splits, weights and metric roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(rows: DataFrame, id_col: str, by: list[str], seed: str = "42") -> DataFrame:
    """Adds ``rank`` (from 1) and ``n`` in a random but fixed order within each group.

    The order is that of md5(id:seed). Its first four hexadecimal digits cut every group into 65,536
    ranges; ranks are given within a range and shifted by the ranges before, so no group, and not the
    whole table either, is sorted in one task.
    """
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    keyed = rows.withColumn("h_", h).withColumn("r_", F.substring("h_", 1, 4))
    sizes = keyed.groupBy(*by, "r_").agg(F.count(F.lit(1)).alias("c_"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    offsets = sizes.select(*by, "r_", (F.sum("c_").over(whole.orderBy("r_")) - F.col("c_")).alias("before_"), F.sum("c_").over(whole).alias("n"))
    inner = keyed.withColumn("k_", F.row_number().over(Window.partitionBy(*by, "r_").orderBy("h_", id_col)))
    # null groups are groups too
    on = F.lit(True)
    for c in [*by, "r_"]:
        on = on & inner[c].eqNullSafe(offsets[c])
    joined = inner.join(offsets, on)
    return joined.select(*[inner[c] for c in rows.columns], (F.col("before_") + F.col("k_")).alias("rank"), "n")


def split(rows: DataFrame, id_col: str, fractions: tuple[float, float] = (0.8, 0.1), by: list[str] | None = None, seed: str = "42") -> DataFrame:
    """Adds ``split``: exactly floor(n * fraction) rows to train and validation, the rest to test; per group with ``by``."""
    r = ranked(rows, id_col, by or [], seed)
    a, b = F.floor(F.col("n") * fractions[0]), F.floor(F.col("n") * fractions[1])
    return r.withColumn("split", F.when(F.col("rank") <= a, "train").when(F.col("rank") <= a + b, "validation").otherwise("test")).drop("rank", "n")


def sampler_weights(records: DataFrame, category: str) -> DataFrame:
    """Adds ``weight``: the inverse frequency of the record's category, null as a category of its own."""
    counts = records.groupBy(category).agg((F.lit(1.0) / F.count(F.lit(1))).alias("weight"))
    return records.join(counts, records[category].eqNullSafe(counts[category])).drop(counts[category])


def paired_factors(pairs: DataFrame, id_col: str, ranges: dict[str, tuple[float, float]], epoch: int = 0, seed: str = "42") -> DataFrame:
    """Adds one random factor per name, the same for both pictures of a pair; fixed by id, epoch and seed."""
    def factor(name: str, low: float, high: float):
        h = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(name), F.lit(str(epoch)), F.lit(seed))), 1, 8), 16, 10).cast("double")
        return F.lit(low) + h / float(1 << 32) * (high - low)

    return pairs.withColumns({n: factor(n, a, b) for n, (a, b) in ranges.items()})


def metric_means(long: DataFrame, by: list[str]) -> DataFrame:
    """(by, mean, n): nulls and NaN don't count."""
    v = F.when(~F.isnan("value"), F.col("value"))
    return long.groupBy(*by).agg(F.avg(v).alias("mean"), F.count(v).alias("n"))


def mean_of_batch_means(long: DataFrame, batch: str, by: list[str]) -> DataFrame:
    """(by, mean): batches count alike, whatever their size."""
    return metric_means(long, [*by, batch]).groupBy(*by).agg(F.avg("mean").alias("mean"))


def with_fallback(rows: DataFrame, prediction: str, source: str) -> DataFrame:
    """Rows whose prediction is missing take their input as it is."""
    return rows.withColumn(prediction, F.coalesce(prediction, source))
