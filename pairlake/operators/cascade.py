"""The cascade of a pair of pictures from quality to zones, and the manifest of pairs with faces.

All measures are columns of one row per picture; the first stage that fails names the pair's outcome. Nothing is
computed in a loop over pairs, and a stage that failed only hides the later ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairlake.functions.geometry import pose_reason
from pairlake.functions.urls import exact_label
from pairlake.operators.relational import json_field


def grade(reason: Column) -> Column:
    """PASS without a reason to fail, else FAIL."""
    return F.when(reason.isNull(), "PASS").otherwise("FAIL")


def pair_outcome(before: Column, after: Column) -> Column:
    """Reject reason of a pair, null where it passes; each picture is a struct (readable, quality, detection, landmarks, alignment, pose).

    ``quality``, ``detection`` and ``alignment`` are reasons to fail or null, ``landmarks`` says whether there are any,
    ``pose`` is struct(yaw, pitch, roll). Stages: quality, detection, landmarks, alignment, pose; before comes first in each.
    """
    both = (("before", before), ("after", after))
    out = F.when(~(F.coalesce(before["readable"], F.lit(False)) & F.coalesce(after["readable"], F.lit(False))), "quality:unreadable_image")
    for stage in ("quality", "detection"):
        for side, x in both:
            out = out.when(x[stage].isNotNull(), F.concat(F.lit(f"{stage}:{side}:"), x[stage]))
    for side, x in both:
        out = out.when(~F.coalesce(x["landmarks"], F.lit(False)), f"landmark:{side}:no_face_mesh")
    for side, x in both:
        out = out.when(x["alignment"].isNotNull(), F.concat(F.lit(f"alignment:{side}:"), x["alignment"]))
    pose = pose_reason(before["pose"], after["pose"])
    return out.when(pose.isNotNull(), F.concat(F.lit("pose:"), pose))


def pair_cascade(pairs: DataFrame, pictures: DataFrame, zones: DataFrame) -> DataFrame:
    """(pair_id, passed, reject_reason, zone_codes) of pairs (pair_id, before_image_id, after_image_id); zones only of pairs that pass.

    pictures: image_id and the fields of ``pair_outcome``; zones (image_id, zone_code). A picture that isn't there is unreadable.
    """
    fields = F.struct(*[c for c in pictures.columns if c != "image_id"])
    b, a = (pictures.select(F.col("image_id").alias(f"{s}_image_id"), fields.alias(s)) for s in ("before", "after"))
    codes = zones.groupBy(F.col("image_id").alias("before_image_id")).agg(F.sort_array(F.collect_set("zone_code")).alias("codes"))
    out = pairs.join(b, "before_image_id", "left").join(a, "after_image_id", "left").withColumn("reject_reason", pair_outcome(F.col("before"), F.col("after"))).join(codes, "before_image_id", "left")
    none = F.array().cast("array<string>")
    return out.select("pair_id", F.col("reject_reason").isNull().alias("passed"), "reject_reason", F.when(F.col("reject_reason").isNull(), F.coalesce("codes", none)).otherwise(none).alias("zone_codes"))


def strict_label(metadata: str = "metadata", url: str = "source_url", field: str = "treatment_category") -> Column:
    """Label from the metadata, else from the community, else from a whole path part of the address."""
    return F.coalesce(json_field(metadata, field), exact_label(F.col(url)))


def checked_pairs(rows: DataFrame, files: DataFrame, faces: DataFrame) -> DataFrame:
    """Adds ``outcome`` to rows (id, ...): missing_image, no_face or kept; files (id, side), faces (id, side) of pictures that have one."""
    both = lambda df: df.where("side in ('before', 'after')").groupBy("id").agg((F.count_distinct("side") == 2).alias("ok"))
    out = rows.join(both(files).withColumnRenamed("ok", "there_"), "id", "left").join(both(faces).withColumnRenamed("ok", "faces_"), "id", "left")
    no = F.lit(False)
    outcome = F.when(~F.coalesce("there_", no), "missing_image").when(~F.coalesce("faces_", no), "no_face").otherwise("kept")
    return out.withColumn("outcome", outcome).drop("there_", "faces_")


def face_manifest(checked: DataFrame) -> DataFrame:
    """Manifest records of the kept rows of ``checked_pairs`` with their strict label."""
    path = lambda side: F.concat(F.col("id").cast("string"), F.lit(f"_{side}.jpg"))
    return checked.where("outcome = 'kept'").select(F.col("id").alias("pair_id"), path("before").alias("before_path"), path("after").alias("after_path"), strict_label().alias("treatment_category"), F.lit(None).cast("string").alias("treatment_brand"), F.array().cast("array<string>").alias("zone_codes"))


def manifest_counts(checked: DataFrame, least: int = 200) -> DataFrame:
    """One row: checked, missing_image, no_face, kept, labelled, percent labelled (rounded down), and whether there are enough to train."""
    kept = F.col("outcome") == "kept"
    n = lambda x: F.count_if(F.col("outcome") == x)
    row = checked.agg(F.count(F.lit(1)).alias("n_checked"), n("missing_image").alias("n_missing_image"), n("no_face").alias("n_no_face"), F.count_if(kept).alias("n_kept"), F.count_if(kept & strict_label().isNotNull()).alias("n_labelled"))
    return row.withColumns({"percent": F.floor(100 * F.col("n_labelled") / F.greatest(F.col("n_kept"), F.lit(1))), "enough": F.col("n_kept") >= least})


def enough(checked: DataFrame, least: int = 200) -> DataFrame:
    """The manifest; raises if it has fewer than ``least`` records."""
    n = checked.where("outcome = 'kept'").limit(least).count()
    if n < least:
        raise ValueError(f"only {n} pairs with faces; {least} are needed")
    return face_manifest(checked)
