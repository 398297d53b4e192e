"""Faces, landmarks and zones as relational operators over input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def detections(faces: DataFrame) -> DataFrame:
    """Faces of the best method that found any in an image; methods are numbered, the least comes first."""
    return faces.withColumn("least_", F.min("method").over(Window.partitionBy("image_id"))).where(F.col("method") == F.col("least_")).drop("least_")


def accepted(faces: DataFrame, images: DataFrame, least: float = 0.9, size: int = 80, most: int = 1) -> DataFrame:
    """(image_id, n_faces, reason): null reason where an image has between one and ``most`` sure faces of enough size."""
    sure = faces.where(F.col("confidence") >= least)
    n = sure.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.least(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("smallest"))
    out = images.select("image_id").join(n, "image_id", "left").withColumn("n_faces", F.coalesce("n", F.lit(0)))
    reason = F.when(F.col("n_faces") == 0, "no_face_detected").when(F.col("n_faces") > most, "multiple_faces").when(F.col("smallest") < size, "face_too_small")
    return out.select("image_id", "n_faces", reason.alias("reason"))


def largest(faces: DataFrame) -> DataFrame:
    """One face per image, the one with the largest area; the smaller left edge where areas are equal."""
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    rest = [c for c in faces.columns if c != "image_id"]
    return faces.groupBy("image_id").agg(F.max_by(F.struct(*rest), F.struct(area, -F.col("x1"), -F.col("y1"))).alias("f")).select("image_id", "f.*")


def zone_presence(landmarks: DataFrame, zones: DataFrame) -> DataFrame:
    """(image_id, zone_code, ordinal, confidence, n_landmarks, x, y) of zones of which a landmark is there.

    landmarks (image_id, index, x, y); zones (zone_code, ordinal, landmark_indices): a short table that is
    a parameter. Confidence is the share of a zone's distinct landmarks that are there, the place their mean.
    """
    flat = zones.withColumn("own", F.array_distinct("landmark_indices")).where(F.size("own") > 0)
    flat = flat.select("zone_code", "ordinal", F.size("own").alias("total"), F.explode("own").alias("index"))
    hits = landmarks.dropDuplicates(["image_id", "index"]).join(flat, "index")
    own = hits.groupBy("image_id", "zone_code", "ordinal", "total").agg(F.count(F.lit(1)).alias("n_landmarks"), F.avg("x").alias("x"), F.avg("y").alias("y"))
    return own.select("image_id", "zone_code", "ordinal", F.round(F.col("n_landmarks") / F.col("total"), 4).alias("confidence"), "n_landmarks", "x", "y")


def dominant_zones(presence: DataFrame, least: float = 0.6, most: int = 5) -> DataFrame:
    """The surest zones of each image, at most ``most``; equal ones in the zones' own order."""
    w = Window.partitionBy("image_id").orderBy(F.desc("confidence"), "ordinal")
    return presence.where(F.col("confidence") >= least).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def zone_labels(presence: DataFrame, least: float = 0.5) -> DataFrame:
    """Zone labels to store: sure enough, rounded, marked as automatic."""
    return presence.where(F.col("confidence") >= least).select("image_id", "zone_code", F.round("confidence", 4).alias("confidence"), F.lit("auto").alias("source"))


def same_person(faces: DataFrame, pairs: DataFrame, least: float = 0.4) -> DataFrame:
    """(pair_id, similarity, same): cosine of the largest faces' embeddings; no face gives 0 and false, no embedding null and true."""
    from pairlake.functions.vectors import cosine

    one = largest(faces).select("image_id", "embedding")
    b, a = one.select(F.col("image_id").alias("before_image_id"), F.col("embedding").alias("eb"), F.lit(True).alias("fb")), one.select(F.col("image_id").alias("after_image_id"), F.col("embedding").alias("ea"), F.lit(True).alias("fa"))
    both = pairs.join(b, "before_image_id", "left").join(a, "after_image_id", "left")
    found = F.col("fb").isNotNull() & F.col("fa").isNotNull()
    s = F.when(~found, 0.0).otherwise(cosine(F.col("eb"), F.col("ea")))
    return both.select("pair_id", s.alias("similarity")).withColumn("same", F.coalesce(F.col("similarity") >= least, F.lit(True)))
