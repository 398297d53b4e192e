"""Relational operators of the pair store: training set, balance, queues as logs, merges, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairlake.functions.urls import url_label
from pairlake.operators.pairing import first_wins


def training_set(pairs: DataFrame, images: DataFrame, labels: DataFrame, quarantine: DataFrame, zones: DataFrame | None = None, low: bool = False) -> DataFrame:
    """Pairs of two known images of which none is quarantined, with their label and sorted zone codes.

    Pairs whose ordering is LOW are left out unless ``low``; an unknown (null) ordering is left out
    in the first case too. The quarantine is taken from the images once, so that pairs are joined twice only.
    """
    ok = pairs if low else pairs.where("ordering_confidence <> 'LOW'")
    clean = images.select("id", "file_path").join(quarantine.select(F.col("image_id").alias("id")), "id", "left_anti")
    for side in ("before", "after"):
        ok = ok.join(clean.select(F.col("id").alias(f"{side}_image_id"), F.col("file_path").alias(f"{side}_path")), f"{side}_image_id")
    out = ok.join(labels.select(F.col("pair_id").alias("id"), "treatment_category", "treatment_brand"), "id", "left")
    cols = [F.col("id").alias("pair_id"), "before_path", "after_path", "treatment_category", "treatment_brand"]
    if zones is None:
        return out.select(*cols)
    codes = zones.groupBy(F.col("pair_id").alias("id")).agg(F.sort_array(F.collect_set("zone_code")).alias("zone_codes"))
    return out.join(codes, "id", "left").select(*cols, F.coalesce("zone_codes", F.array().cast("array<string>")).alias("zone_codes"))


def balance(records: DataFrame, category: str = "treatment_category") -> DataFrame:
    """(category, n, weight): inverse-frequency weights over the labelled records; null and empty are unlabelled."""
    counts = records.where(F.coalesce(F.col(category), F.lit("")) != "").groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), F.lit(True)).select(category, "n", F.round(F.col("total") / F.col("n"), 4).alias("weight"))


def merge_logs(parts: list[DataFrame], keys: list[str], defaults: dict[str, Column]) -> DataFrame:
    """Rows of several logs, each key once, of the first log that has it (and there the smallest id)."""
    every = None
    for k, p in enumerate(parts):
        own = p.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()}).withColumn("part", F.lit(k))
        every = own if every is None else every.unionByName(own)
    return first_wins(every, keys, ["part", "id"])


def latest(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last in order."""
    rest = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("x")).select(*keys, "x.*").select(*events.columns)


def label_coverage(rows: DataFrame, labelled: Column, by: list[str]) -> DataFrame:
    """(by, n, n_labelled, percent): whole percent, rounded down."""
    own = rows.groupBy(*by) if by else rows
    return own.agg(F.count(F.lit(1)).alias("n"), F.count_if(labelled).alias("n_labelled")).withColumn("percent", F.floor(100 * F.col("n_labelled") / F.greatest(F.col("n"), F.lit(1))))


def json_field(column: str, field: str) -> Column:
    """A field of JSON text; null where the text is null or no JSON."""
    return F.nullif(F.try_variant_get(F.try_parse_json(F.col(column)), f"$.{field}", "string"), F.lit(""))


def backfill(rows: DataFrame, metadata: str = "metadata", url: str = "source_url", field: str = "treatment_category") -> DataFrame:
    """Adds ``label`` and ``outcome``: kept from the metadata, derived from the URL, or no_match."""
    own, derived = json_field(metadata, field), url_label(F.col(url))
    return rows.withColumns({"kept_": own, "derived_": derived}).withColumns({"label": F.coalesce("kept_", "derived_"), "outcome": F.when(F.col("kept_").isNotNull(), "kept").when(F.col("derived_").isNotNull(), "derived").otherwise("no_match")}).drop("kept_", "derived_")


def orphans(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose foreign key has no parent."""
    return rows.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)), key, "left_anti")


def upsert_new(existing: DataFrame, incoming: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Rows of ``incoming`` whose key is new, each key once, with ids that continue the existing ones.

    Ids are unique and rise, with gaps: they are given within partitions, so nothing is sorted in one task.
    """
    new = incoming.dropDuplicates([key]).join(existing.select(key), key, "left_anti")
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top"))
    return new.drop(id_col).crossJoin(F.broadcast(top)).withColumn(id_col, F.col("top") + 1 + F.monotonically_increasing_id()).drop("top")


def explode_sides(pairs: DataFrame, columns: list[str], to: str) -> DataFrame:
    """One row per distinct value of several columns."""
    return pairs.select(F.explode(F.array(*columns)).alias(to)).where(F.col(to).isNotNull()).distinct()


def resume(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is still to be done."""
    return todo.join(done.select(key), key, "left_anti")


def run_stats(results: DataFrame, reason: Column, skipped: Column) -> DataFrame:
    """One row: totals, passed, rejected by reason, pass rate without the skipped (0 if there are none)."""
    ran = ~skipped
    row = results.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(skipped).alias("n_skipped"), F.count_if(ran & reason.isNull()).alias("n_passed"), F.count_if(ran & reason.isNotNull()).alias("n_rejected"))
    return row.withColumn("pass_rate", F.coalesce(F.try_divide(F.col("n_passed"), F.col("n_total") - F.col("n_skipped")), F.lit(0.0)))


def first_failing(stages: list[tuple[str, Column]]) -> Column:
    """Name of the first stage whose check fails; a missing check fails; null where all pass."""
    out = F.lit(None).cast("string")
    for name, ok in reversed(stages):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def top_per_group(rows: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group in order."""
    from pyspark.sql import Window

    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)
