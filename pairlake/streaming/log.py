"""Streams over landed files: first-wins dedup, micro-batches, late data, running means."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlake.sources.stores import write_once


def landed(spark: SparkSession, path: str, schema: str, files: int | None = None, kind: str = "parquet") -> DataFrame:
    """A stream of the files that land in a folder."""
    reader = spark.readStream.format(kind).schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).load(path)


def deduplicated(stream: DataFrame, keys: list[str], time: str | None = None, late: str = "1 day") -> DataFrame:
    """The first row of each key. With a time column state is kept only as long as repeats may come late."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys) if time else stream.dropDuplicates(keys)


def windowed_counts(stream: DataFrame, time: str, by: list[str], width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts per event-time window; a window is given out when no row for it may come any more."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def into_folder(stream: DataFrame, folder: str, name: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append"):
    """Every micro-batch through ``work`` into its own folder; stops when what has landed is done.

    Started again with the same checkpoint it goes on with what has landed since.
    """

    def batch(df: DataFrame, number: int) -> None:
        write_once(work(df) if work else df, folder, name, number)

    return stream.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_means(stream: DataFrame, by: str, value: str) -> DataFrame:
    """(by, n, mean) after each micro-batch, with own state: sums and counts; null and NaN values don't count."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for pdf in batches:
            v = pdf[value].dropna()
            n, total = n + len(v), total + float(v.sum())
        state.update((n, total))
        yield pd.DataFrame({by: [key[0]], "n": [n], "mean": [total / n if n else None]})

    from pyspark.sql.streaming.state import GroupStateTimeout

    kind = dict(stream.dtypes)[by]
    return stream.groupBy(by).applyInPandasWithState(update, f"{by} {kind}, n long, mean double", "n long, total double", "update", GroupStateTimeout.NoTimeout)
