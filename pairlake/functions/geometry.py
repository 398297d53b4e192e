"""Face geometry as columns: eye centres, alignment, pose agreement, ordering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairlake.functions.vocabulary import IRISES, LEFT_EYE, RIGHT_EYE


def _centre(landmarks: Column, numbers: list[int]) -> Column:
    own = F.filter(landmarks, lambda p: p["index"].isin(*numbers))
    mean = lambda c: F.when(F.size(own) == 0, 0.5).otherwise(F.aggregate(own, F.lit(0.0), lambda s, p: s + p[c]) / F.nullif(F.size(own), F.lit(0)))
    return F.struct(mean("x").alias("x"), mean("y").alias("y"))


def eye_centres(landmarks: Column) -> Column:
    """struct(left, right) from array<struct<index,x,y,..>>: irises, else means of the eyes' contours; null without landmarks."""
    iris = lambda k: F.try_element_at(F.filter(landmarks, lambda p: p["index"] == k), F.lit(-1))
    point = lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))
    both = iris(IRISES[0]).isNotNull() & iris(IRISES[1]).isNotNull()
    by_iris = F.struct(point(iris(IRISES[0])).alias("left"), point(iris(IRISES[1])).alias("right"))
    by_contour = F.struct(_centre(landmarks, LEFT_EYE).alias("left"), _centre(landmarks, RIGHT_EYE).alias("right"))
    return F.when(F.size(landmarks) > 0, F.when(both, by_iris).otherwise(by_contour))


def alignment(lx: Column, ly: Column, rx: Column, ry: Column, target: int = 512, ratio: float = 0.35) -> Column:
    """struct(angle, scale, matrix, reason): the affine map that levels the eyes and puts their middle in place."""
    dx, dy = rx - lx, ry - ly
    angle, gap = F.degrees(F.atan2(dy, dx)), F.sqrt(dx * dx + dy * dy)
    scale = F.lit(ratio * target) / F.nullif(gap, F.lit(0.0))
    a, b = scale * F.cos(F.atan2(dy, dx)), scale * F.sin(F.atan2(dy, dx))
    mx, my = (lx + rx) / 2, (ly + ry) / 2
    rows = [a, b, (1 - a) * mx - b * my + target / 2 - mx, -b, a, b * mx + (1 - a) * my + target * 0.35 - my]
    reason = F.when(lx.isNull() | rx.isNull(), "no_eye_landmarks").when(gap < 5, "eye_distance_too_small")
    ok = reason.isNull()
    return F.struct(F.when(ok, angle).alias("angle"), F.when(ok, scale).alias("scale"), F.when(ok, F.array(*rows)).alias("matrix"), reason.alias("reason"))


def pose_reason(before: Column, after: Column, most: tuple[float, float, float] = (15.0, 15.0, 10.0)) -> Column:
    """First of yaw, pitch and roll that differs by more than its limit; null where the poses agree."""
    out = F.when(before.isNull(), "before_pose_failed").when(after.isNull(), "after_pose_failed")
    for name, limit in zip(("yaw", "pitch", "roll"), most):
        gap = F.abs(before[name] - after[name])
        out = out.when(gap > limit, F.format_string(f"{name}_mismatch:%.1f>{limit}", gap))
    return out


def ordered(kind: Column, before_measure: Column, after_measure: Column) -> Column:
    """struct(passed, confidence): line depth must not rise, volume must not fall; unknown kinds pass with 0.5."""
    falls, rises = kind == "line_depth", kind == "volume"
    known = before_measure.isNotNull() & after_measure.isNotNull() & (falls | rises)
    right = F.when(falls, before_measure >= after_measure).otherwise(before_measure <= after_measure)
    sure = F.least(F.lit(1.0), 0.5 + F.abs(before_measure - after_measure))
    return F.struct(F.coalesce(~known | right, F.lit(True)).alias("passed"), F.when(~known | known.isNull(), 0.5).when(right, sure).otherwise(0.3).alias("confidence"))


def combined_confidence(first: Column, second: Column, passed: Column) -> Column:
    return F.when(passed, F.round(F.least(F.lit(1.0), (first + second) / 2), 3)).otherwise(first * second)
