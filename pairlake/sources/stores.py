"""Relational stores: parquet folders, and databases over JDBC where a driver is on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, url: str, name: str, column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8) -> DataFrame:
    """A table of a store: ``jdbc:...`` (in parallel ranges of ``column`` where bounds are given) or a folder."""
    if not url.startswith("jdbc:"):
        return spark.read.parquet(f"{url}/{name}.parquet")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
    if column and bounds:
        reader = reader.options(partitionColumn=column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
    return reader.load()


def write(df: DataFrame, url: str, name: str, mode: str = "append") -> None:
    """Adds rows to a table of a store."""
    if url.startswith("jdbc:"):
        df.write.format("jdbc").option("url", url).option("dbtable", name).mode(mode).save()
    else:
        df.write.mode(mode).parquet(f"{url}/{name}.parquet")


def write_once(df: DataFrame, folder: str, name: str, batch_id: int) -> None:
    """One batch's rows under the batch's own number: a batch that is written again replaces itself."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")
