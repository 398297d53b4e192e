"""Manifests: training records as JSON, written sorted and read with defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = "pair_id long, before_path string, after_path string, treatment_category string, treatment_brand string, zone_codes array<string>"


def as_json(*columns: str) -> Column:
    """Fixed fields of a record as JSON; null fields are kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write(records: DataFrame, path: str, columns: list[str] | None = None) -> int:
    """Writes one JSON object a line, range-sorted by pair_id over any number of files; gives the number of records.

    The same records give the same lines in the same order over the files.
    """
    columns = columns or [f.split()[0] for f in FIELDS.split(", ")]
    lines = records.orderBy("pair_id").select(as_json(*columns).alias("value"))
    lines.write.mode("overwrite").text(path)
    return lines.sparkSession.read.text(path).count()


def read(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Records of a manifest: JSON lines, or with ``whole`` one JSON array a file; a missing pair_id is 0, missing zones are none."""
    df = spark.read.schema(FIELDS).json(path, multiLine=whole)
    return df.withColumns({"pair_id": F.coalesce("pair_id", F.lit(0).cast("long")), "zone_codes": F.coalesce("zone_codes", F.array().cast("array<string>"))})


def report(metrics: DataFrame, per_treatment: DataFrame, tag: str) -> DataFrame:
    """One row ``report``: an evaluation as JSON, from metrics (metric, value, n) and per_treatment (treatment, metric, value).

    Metrics and treatments are short lists; they are in order of their names. A null treatment is called unknown.
    """
    as_map = lambda: F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value"))))
    by = per_treatment.withColumn("treatment", F.coalesce("treatment", F.lit("unknown"))).groupBy("treatment").agg(as_map().alias("m"))
    parts = by.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("treatment", F.to_json("m").alias("j"))))).alias("t"))
    whole = metrics.agg(F.max("n").alias("num_samples"), as_map().alias("metrics"))
    nested = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries("t"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])), ","), F.lit("}"))
    text = F.concat(F.lit(f'{{"model_tag":"{tag}","num_samples":'), F.col("num_samples").cast("string"), F.lit(',"metrics":'), F.to_json("metrics"), F.lit(',"per_treatment":'), nested, F.lit("}"))
    return whole.join(parts, F.lit(True)).select(text.alias("report"))


def write_report(text: DataFrame, path: str) -> None:
    text.select("report").coalesce(1).write.mode("overwrite").text(path)


def write_thresholds(found: DataFrame, path: str, version: int) -> None:
    """Adds calibrated thresholds (layer, threshold) as a new version; written again, a version replaces itself."""
    found.select("layer", "threshold").write.mode("overwrite").parquet(f"{path}/version={version}")


def thresholds(spark: SparkSession, path: str) -> DataFrame:
    """(layer, threshold, version) of the last version."""
    every = spark.read.parquet(path)
    last = every.agg(F.max("version").alias("version"))
    return every.join(F.broadcast(last), "version").select("layer", "threshold", "version")
