"""Queries of pictures, faces, landmarks and measures of predictions, with the SQL they are checked against.

An embedding of 64 numbers is taken as a picture of 8 by 8; faces and landmarks are made of ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlake.functions import geometry, texts, urls, vectors
from pairlake.operators import cascade, evaluation, faces, kernels
from pairlake.plans.sql import COS, NEXT, SCORED
from pairlake.runtime import table

LIMITS = {"min_width": 200, "min_height": 200, "min_blur": 80.0, "min_uniformity": 0.35, "min_brightness": 15.0, "max_brightness": 245.0}
FACE = [[0.0, 0.0, 0.0], [0.0, 330.0, 65.0], [-225.0, -170.0, 135.0], [225.0, -170.0, 135.0], [-150.0, 150.0, 125.0], [150.0, 150.0, 125.0]]


def _pixels(c: str, scale: float, shift: float) -> Column:
    row = lambda r: F.transform(F.slice(c, r * 8 + 1, 8), lambda v: v.cast("double") * scale + shift)
    return F.array(*[row(r) for r in range(8)])


def _neighbours(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("after")), "vec_id")


def picture_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Sharpness and lighting of pictures given as pixels."""
    q = table(spark, sf, "embeddings").select("vec_id", kernels.quality_of_pixels(_pixels("embedding", 100.0, 100.0)).alias("q"))
    return q.select("vec_id", F.round("q.blur_score", 3).alias("blur"), F.round("q.lighting_uniformity", 5).alias("uniformity"), F.round("q.mean_brightness", 4).alias("brightness"), "q.width", "q.height")


def picture_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Measures of encoded pictures: grey ones of 4 by 3, of which some can't be read."""
    grey = F.lpad(F.hex(F.col("id") % 256), 2, "0")
    data = F.when(F.col("id") % 7 == 0, F.lit("junk").cast("binary")).when(F.col("id") % 11 != 0, F.unhex(F.concat(F.hex(F.lit("P5 4 3 255\n")), F.repeat(grey, F.lit(12)))))
    return table(spark, sf, "image").select("id", kernels.quality_of_bytes(data).alias("q")).select("id", "q.blur_score", "q.mean_brightness", "q.width", "q.height")


def ssim_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _neighbours(spark, sf).select("vec_id", F.round(kernels.ssim_of_pixels(_pixels("embedding", 2.0, 0.0), _pixels("after", 2.0, 0.0)), 5).alias("ssim"))


def quality_grades(spark: SparkSession, sf: str) -> DataFrame:
    """Grade and whether the resolution passes of every scored picture."""
    q = table(spark, sf, "quality_result").dropDuplicates(["id"])
    reason = texts.quality_reason(F.col("blur_score"), F.col("lighting_uniformity"), F.col("mean_brightness"), F.col("width"), F.col("height"), LIMITS)
    return q.select("id", cascade.grade(reason).alias("own_grade"), F.coalesce((F.col("width") >= 200) & (F.col("height") >= 200), F.lit(False)).alias("passes"))


def _faces(spark: SparkSession, sf: str) -> DataFrame:
    """Up to two faces by the first method and one by the second for every image."""
    i, k = F.col("image_id"), F.col("k")
    rows = table(spark, sf, "image").select(F.col("id").alias("image_id"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("k")).where("k <= image_id % 3 or k = 3 and image_id % 5 <> 0")
    return rows.select("image_id", F.when(k == 3, 2).otherwise(1).alias("method"), (k * 10).alias("x1"), F.lit(0).alias("y1"), (k * 10 + 60 + i * k % 60).cast("int").alias("x2"), (70 + i % 30).cast("int").alias("y2"), ((85 + i % 16 - k) / 100).alias("confidence"))


def face_acceptance(spark: SparkSession, sf: str) -> DataFrame:
    """Faces of the first method that found any, and whether they are acceptable."""
    return faces.accepted(faces.detections(_faces(spark, sf)), table(spark, sf, "image").select(F.col("id").alias("image_id")))


def largest_faces(spark: SparkSession, sf: str) -> DataFrame:
    return faces.largest(_faces(spark, sf))


def eye_points(spark: SparkSession, sf: str) -> DataFrame:
    """Centres of the eyes from irises, else contours, else the middle; in pixels of a picture of 640 by 480."""
    at = lambda k, n: F.struct(F.lit(n).alias("index"), F.element_at("embedding", k).cast("double").alias("x"), F.element_at("embedding", k + 1).cast("double").alias("y"))
    contour, iris = [at(1, 33), at(3, 7), at(5, 362)], [at(7, 468), at(9, 473)]
    own = F.when(F.col("vec_id") % 3 == 0, F.array(*contour)).when(F.col("vec_id") % 3 == 1, F.array(*contour, *iris)).otherwise(F.array(at(11, 5)))
    c = table(spark, sf, "embeddings").select("vec_id", geometry.eye_centres(own).alias("c"))
    return c.select("vec_id", *[F.round(F.col(f"c.{s}.{a}") * size, 4).alias(f"{s}_{a}") for s in ("left", "right") for a, size in (("x", 640), ("y", 480))])


def head_poses(spark: SparkSession, sf: str) -> DataFrame:
    """Angles found from six points that a head of known angles projects to."""
    yaw, pitch = F.radians(F.col("vec_id") % 41 - 20), F.radians(F.col("vec_id") % 21 - 10)
    cy, sy, cp, sp = F.cos(yaw), F.sin(yaw), F.cos(pitch), F.sin(pitch)
    pts = []
    for x, y, z in FACE:
        u, v = cp * y - sp * z, sp * y + cp * z
        px, py, pz = cy * x + sy * v + 10, u - 20, cy * v - sy * x + 1500
        pts.append(F.array(640 * px / pz + 320, 640 * py / pz + 240))
    q = table(spark, sf, "embeddings").select("vec_id", kernels.head_pose(FACE)(F.array(*pts), F.lit(640), F.lit(480)).alias("q"))
    return q.select("vec_id", *[(F.round(f"q.{a}", 1) + F.lit(0.0)).alias(a) for a in ("yaw", "pitch", "roll")])


def ordering_gates(spark: SparkSession, sf: str) -> DataFrame:
    """Both gates of the order and their combined confidence over all pairs, explicit where the first score is high."""
    p = table(spark, sf, "image_pair").select("id", "layer1_score", "layer2_score", "layer3_score").distinct()
    ok = lambda c: F.when((F.col(c) >= 0) & (F.col(c) <= 1), F.col(c))
    kind = F.element_at(F.array(F.lit("line_depth"), F.lit("volume"), F.lit(None).cast("string")), (F.col("id") % 3 + 1).cast("int"))
    p = p.select("id", F.coalesce(ok("layer1_score"), F.lit(0.0)).alias("first"), geometry.ordered(kind, ok("layer2_score"), ok("layer3_score")).alias("second"))
    explicit = F.col("first") >= 0.55
    verdict = F.when(~explicit, "gate1_fail").when(~F.col("second.passed"), "gate2_fail").otherwise("pass")
    sure = F.when(~explicit, 0.0).otherwise(geometry.combined_confidence(F.col("first"), F.col("second.confidence"), F.col("second.passed")))
    return p.select("id", verdict.alias("verdict"), F.round(sure, 3).alias("confidence"))


def paired_factors(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "image_pair").select("id").distinct()
    out = evaluation.paired_factors(pairs, "id", {"turn": (-5.0, 5.0), "light": (0.9, 1.1)}, epoch=3)
    return out.select("id", F.round("turn", 6).alias("turn"), F.round("light", 6).alias("light"))


def unit_range(spark: SparkSession, sf: str) -> DataFrame:
    v = vectors.to_unit_range(F.col("embedding"))
    return table(spark, sf, "embeddings").select("vec_id", F.round(F.array_min(v), 6).alias("low"), F.round(F.array_max(v), 6).alias("high"))


def identity_means(spark: SparkSession, sf: str) -> DataFrame:
    """Mean cosine of neighbours per batch of 16."""
    c = _neighbours(spark, sf).select(F.floor(F.col("vec_id") / 16).alias("batch"), vectors.cosine(F.col("embedding"), F.col("after")).alias("value"))
    return evaluation.metric_means(c, ["batch"]).select("batch", F.round("mean", 6).alias("identity"))


def fallback_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Mean difference from the target where some predictions are missing and take their input."""
    n = _neighbours(spark, sf).withColumn("prediction", F.when(F.col("vec_id") % 3 != 0, F.col("after")))
    return evaluation.with_fallback(n, "prediction", "embedding").select("vec_id", F.round(vectors.l1(F.col("prediction"), F.col("after")), 6).alias("l1"))


def shard_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Places of the aligned pictures of every pair."""
    return table(spark, sf, "image_pair").select("id").distinct().select("id", urls.shard_path(F.col("id"), "before").alias("before_path"), urls.shard_path(F.col("id"), "after").alias("after_path"))


def face_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the largest faces of a pair's pictures are of one person; faces take the embedding of their picture's and their own number."""
    e = table(spark, sf, "embeddings")
    n = e.agg(F.count(F.lit(1)).alias("n"))
    own = _faces(spark, sf).join(F.broadcast(n), F.lit(True)).withColumn("vec_id", (F.col("image_id") * 7 + F.col("x1")) % F.col("n")).join(e.select("vec_id", "embedding"), "vec_id", "left").drop("n", "vec_id")
    pairs = table(spark, sf, "image_pair").select(F.col("id").alias("pair_id"), "before_image_id", "after_image_id").distinct()
    return faces.same_person(own, pairs, 0.05).select("pair_id", F.round("similarity", 6).alias("similarity"), "same")


QUERIES = [
    shard_paths, face_pairs, picture_scores, picture_bytes, ssim_scores, quality_grades, face_acceptance, largest_faces, eye_points, head_poses, ordering_gates, paired_factors, unit_range, identity_means, fallback_errors,
]

FACES = """SELECT id AS image_id, k, CASE WHEN k = 3 THEN 2 ELSE 1 END AS method, k * 10 AS x1, 0 AS y1, (k * 10 + 60 + id * k % 60)::INT AS x2, (70 + id % 30)::INT AS y2, (85 + id % 16 - k) / 100.0::DOUBLE AS confidence
    FROM image, (VALUES (1), (2), (3)) f(k) WHERE k <= id % 3 OR k = 3 AND id % 5 <> 0"""
PIXELS = "SELECT vec_id, i // 8 AS r, i % 8 AS c, embedding e, embedding[i + 1]::DOUBLE AS v FROM embeddings, (SELECT unnest(range(64)) i)"
OK = "CASE WHEN NOT isnan({c}) AND {c} BETWEEN 0 AND 1 THEN {c} END"
FACTOR = "(('0x' || substr(md5(id || ':{n}:3:42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
E = [f"embedding[{k}]::DOUBLE" for k in range(13)]
GOOD = "coalesce(NOT (width < 200 OR height < 200), true) AND coalesce(NOT blur_score < 80, true) AND coalesce(NOT lighting_uniformity < 0.35::DOUBLE, true) AND coalesce(isnan(mean_brightness) OR mean_brightness BETWEEN 15 AND 245, true)"

SQL = {
    "shard_paths": "SELECT DISTINCT id, lpad((id % 100)::VARCHAR, 2, '0') || '/' || id || '_before.jpg' AS before_path, lpad((id % 100)::VARCHAR, 2, '0') || '/' || id || '_after.jpg' AS after_path FROM image_pair",
    "face_pairs": f"""WITH f AS ({FACES} QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY (x2 - x1) * (y2 - y1) DESC, x1, y1) = 1), v AS (SELECT image_id, e.embedding x FROM f LEFT JOIN embeddings e ON e.vec_id = (image_id * 7 + x1) % (SELECT count(*) FROM embeddings)),
        j AS (SELECT DISTINCT p.id AS pair_id, b.image_id IS NOT NULL AND a.image_id IS NOT NULL AS both_, {COS.format(a="b.x", b="a.x")} c FROM image_pair p LEFT JOIN v b ON b.image_id = before_image_id LEFT JOIN v a ON a.image_id = after_image_id)
        SELECT pair_id, CASE WHEN both_ THEN round(c, 6) ELSE 0.0 END AS similarity, CASE WHEN both_ THEN coalesce(c >= 0.05, true) ELSE false END AS same FROM j""",
    "picture_scores": f"""WITH p AS ({PIXELS}), l AS (SELECT vec_id, v * 100 + 100 AS v, 100 * (e[abs(r - 1) * 8 + c + 1]::DOUBLE + e[(7 - abs(6 - r)) * 8 + c + 1]::DOUBLE + e[r * 8 + abs(c - 1) + 1]::DOUBLE + e[r * 8 + 7 - abs(6 - c) + 1]::DOUBLE - 4 * v) AS d FROM p)
        SELECT vec_id, round(var_pop(d), 3) AS blur, round(greatest(0.0, 1 - stddev_pop(v) / avg(v)), 5) AS uniformity, round(avg(v), 4) AS brightness, 8 AS width, 8 AS height FROM l GROUP BY 1""",
    "picture_bytes": "WITH o AS (SELECT id, id % 7 <> 0 AND id % 11 <> 0 AS ok FROM image) SELECT id, CASE WHEN ok THEN 0.0::DOUBLE END AS blur_score, CASE WHEN ok THEN (id % 256)::DOUBLE END AS mean_brightness, CASE WHEN ok THEN 4 ELSE 0 END AS width, CASE WHEN ok THEN 3 ELSE 0 END AS height FROM o",
    "ssim_scores": f"""WITH p AS (SELECT a.vec_id, a.r, a.c, a.v * 2 AS x, b.v * 2 AS y FROM ({PIXELS}) a JOIN ({PIXELS}) b ON b.vec_id = a.vec_id + 1 AND b.r = a.r AND b.c = a.c),
        w AS (SELECT a.vec_id, a.r, a.c, avg(b.x) mx, avg(b.y) my, avg(b.x * b.x) xx, avg(b.y * b.y) yy, avg(b.x * b.y) xy FROM p a JOIN p b ON b.vec_id = a.vec_id AND abs(b.r - a.r) <= 5 AND abs(b.c - a.c) <= 5 GROUP BY 1, 2, 3)
        SELECT vec_id, round(avg((2 * mx * my + 0.0004::DOUBLE) * (2 * (xy - mx * my) + 0.0036::DOUBLE) / ((mx * mx + my * my + 0.0004::DOUBLE) * (xx - mx * mx + yy - my * my + 0.0036::DOUBLE) + 1e-8)), 5) AS ssim FROM w GROUP BY 1""",
    "quality_grades": f"SELECT id, CASE WHEN {GOOD} THEN 'PASS' ELSE 'FAIL' END AS own_grade, coalesce(width >= 200 AND height >= 200, false) AS passes FROM ({SCORED})",
    "face_acceptance": f"""WITH f AS ({FACES}), m AS (SELECT * FROM f QUALIFY method = min(method) OVER (PARTITION BY image_id)), s AS (SELECT image_id, count(*) n, min(least(x2 - x1, y2 - y1)) d FROM m WHERE confidence >= 0.9 GROUP BY 1)
        SELECT i.id AS image_id, coalesce(n, 0) AS n_faces, CASE WHEN coalesce(n, 0) = 0 THEN 'no_face_detected' WHEN n > 1 THEN 'multiple_faces' WHEN d < 80 THEN 'face_too_small' END AS reason FROM image i LEFT JOIN s ON s.image_id = i.id""",
    "largest_faces": f"SELECT image_id, method, x1, y1, x2, y2, confidence FROM ({FACES}) QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY (x2 - x1) * (y2 - y1) DESC, x1, y1) = 1",
    "eye_points": f"""WITH c AS (SELECT vec_id, vec_id % 3 AS k, embedding FROM embeddings)
        SELECT vec_id, round(640 * CASE k WHEN 0 THEN ({E[1]} + {E[3]}) / 2 WHEN 1 THEN {E[7]} ELSE 0.5 END, 4) AS left_x, round(480 * CASE k WHEN 0 THEN ({E[2]} + {E[4]}) / 2 WHEN 1 THEN {E[8]} ELSE 0.5 END, 4) AS left_y,
        round(640 * CASE k WHEN 0 THEN {E[5]} WHEN 1 THEN {E[9]} ELSE 0.5 END, 4) AS right_x, round(480 * CASE k WHEN 0 THEN {E[6]} WHEN 1 THEN {E[10]} ELSE 0.5 END, 4) AS right_y FROM c""",
    "head_poses": "SELECT vec_id, (vec_id % 41 - 20)::DOUBLE AS yaw, (vec_id % 21 - 10)::DOUBLE AS pitch, 0.0::DOUBLE AS roll FROM embeddings",
    "ordering_gates": f"""WITH p AS (SELECT DISTINCT id, layer1_score, layer2_score, layer3_score FROM image_pair), g AS (SELECT id, coalesce({OK.format(c="layer1_score")}, 0) f, {OK.format(c="layer2_score")} b, {OK.format(c="layer3_score")} a, id % 3 k FROM p),
        r AS (SELECT id, f, coalesce(CASE k WHEN 0 THEN b >= a WHEN 1 THEN b <= a END, true) ok, CASE WHEN k = 2 OR a IS NULL OR b IS NULL THEN 0.5 WHEN CASE k WHEN 0 THEN b >= a ELSE b <= a END THEN least(1.0, 0.5 + abs(b - a)) ELSE 0.3 END::DOUBLE s FROM g)
        SELECT id, CASE WHEN f < 0.55 THEN 'gate1_fail' WHEN NOT ok THEN 'gate2_fail' ELSE 'pass' END AS verdict, round(CASE WHEN f < 0.55 THEN 0 WHEN ok THEN round(least(1.0, (f + s) / 2), 3) ELSE f * s END, 3) AS confidence FROM r""",
    "paired_factors": f"SELECT DISTINCT id, round(-5.0 + {FACTOR.format(n='turn')} * 10.0, 6) AS turn, round(0.9::DOUBLE + {FACTOR.format(n='light')} * (1.1::DOUBLE - 0.9::DOUBLE), 6) AS light FROM image_pair",
    "unit_range": "SELECT vec_id, round(list_min(embedding)::DOUBLE * 2 - 1, 6) AS low, round(list_max(embedding)::DOUBLE * 2 - 1, 6) AS high FROM embeddings",
    "identity_means": f"SELECT vec_id // 16 AS batch, round(avg({COS.format(a='x', b='y')}), 6) AS identity FROM ({NEXT}) GROUP BY 1",
    "fallback_errors": f"SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN round(list_sum(list_transform(list_zip(x, y), lambda p: abs(p[1]::DOUBLE - p[2]::DOUBLE))) / len(x), 6) ELSE 0.0 END::DOUBLE AS l1 FROM ({NEXT})",
}
