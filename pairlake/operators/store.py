"""The write path of the pair store: routes, images with consent records, pairs with metadata, quarantine.

Everything is decided for a whole batch at once and given as rows to append, so a batch that is written again gives the same rows.
Ids continue the existing ones: new rows are ranked in md5 order of their key by ranges with offsets, no table is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairlake.functions.urls import host
from pairlake.operators.evaluation import ranked
from pairlake.operators.pairing import first_wins
from pairlake.operators.relational import json_field

UNCERTAIN = 3


def route(before_tier: Column, after_tier: Column, downloaded: Column, known: Column) -> Column:
    """'quarantine', 'download_failed', 'duplicate' or 'write', tried in this order."""
    tier3 = (before_tier == UNCERTAIN) | (after_tier == UNCERTAIN)
    return F.when(tier3, "quarantine").when(~F.coalesce(downloaded, F.lit(False)), "download_failed").when(known, "duplicate").otherwise("write")


def sides(pairs: DataFrame) -> DataFrame:
    """(source_url, pair_id, side, tier, path, language, page): one row per picture of pairs (id, before_url, ...)."""
    one = lambda s, n: F.struct(F.col(f"{s}_url").alias("source_url"), F.lit(n).alias("side"), F.col(f"{s}_tier").alias("tier"), F.col(f"{s}_path").alias("path"))
    return pairs.select(F.explode(F.array(one("before", 0), one("after", 1))).alias("x"), F.col("id").alias("pair_id"), "language", F.col("source_url").alias("page")).select("x.*", "pair_id", "language", "page")


def _continued(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Adds ``id``: ids go on after the largest existing one, in md5 order of the key."""
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("top_"))
    return ranked(new, key, []).join(F.broadcast(top), F.lit(True)).withColumn("id", F.col("top_") + F.col("rank")).drop("top_", "rank", "n")


def image_rows(pictures: DataFrame, existing: DataFrame) -> DataFrame:
    """(id, source_url, file_path, domain, language, consent_tier) of pictures whose address is new, each once, as its first pair has it."""
    first = first_wins(pictures.where("source_url is not null"), ["source_url"], ["pair_id", "side"])
    new = first.join(existing.select("source_url"), "source_url", "left_anti")
    return _continued(new, existing, "source_url").select("id", "source_url", F.col("path").alias("file_path"), host(F.col("page")).alias("domain"), "language", F.col("tier").alias("consent_tier"))


def consent_rows(images: DataFrame) -> DataFrame:
    """(image_id, consent_tier): one record for each newly inserted image."""
    return images.select(F.col("id").alias("image_id"), "consent_tier")


def pair_rows(pairs: DataFrame, images: DataFrame) -> DataFrame:
    """Pairs with the ids of their images and what is known of their source; an ordering that isn't known is UNKNOWN."""
    b, a = (images.select(F.col("source_url").alias(f"{s}_url"), F.col("id").alias(f"{s}_image_id")) for s in ("before", "after"))
    said = [json_field("metadata", k).alias(to) for k, to in (("provider_name", "practitioner_name"), ("clinic_name", "clinic_name"), ("date_posted", "date_posted"))]
    ordering = F.coalesce(F.nullif(F.col("ordering_confidence"), F.lit("")), F.lit("UNKNOWN")).alias("ordering_confidence")
    return pairs.join(b, "before_url").join(a, "after_url").select(F.col("id").alias("queue_id"), "before_image_id", "after_image_id", ordering, *said, "language", "source_name")


def quarantine_rows(pictures: DataFrame, images: DataFrame, present: DataFrame, reason: str = "consent_tier3") -> DataFrame:
    """(image_id, reason, source_url): at most one row for an image, with the page of its first pair; images in ``present`` have one."""
    first = first_wins(pictures.select("source_url", "pair_id", "side", "page").where("source_url is not null"), ["source_url"], ["pair_id", "side"])
    known = images.select("source_url", F.col("id").alias("image_id"))
    return first.join(known, "source_url").join(present.select("image_id"), "image_id", "left_anti").select("image_id", F.lit(reason).alias("reason"), F.col("page").alias("source_url"))
