import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairlake.functions import geometry, texts, urls, vectors
from pairlake.operators import kernels


def column(spark, values, expr, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    return [r.x for r in spark.createDataFrame(rows, f"i int, v {kind}").orderBy("i").select(expr(F.col("v")).alias("x")).collect()]


def test_url_labels(spark):
    cases = {
        "https://x.com/r/jawsurgery/comments": "jawline_filler", "https://x.com/r/unknown/botox": "botox", "https://x.com/Botox/reviews/1": "botox",
        "https://x.com/a/botox-forehead-lines-12": "botox", "https://x.com/a/lip-filler_kybella": "lip_filler", "https://x.com/myfaceliftstory": "facelift",
        "https://x.com/lip-augmentation---enhancement": "lip_filler", "https://botox.com/none": None, "": None, None: None,
    }
    assert column(spark, list(cases), urls.url_label) == list(cases.values())


def test_absolute(spark):
    base = "https://h.test/a/b.html?q=1#f"
    cases = {"": "", "c.jpg": "https://h.test/a/c.jpg", "/c": "https://h.test/c", "//k.test/c": "https://k.test/c", "http://z/": "http://z/", "?x": "https://h.test/a/b.html?x", "../c": "https://h.test/c", "./c": "https://h.test/a/c"}
    assert column(spark, list(cases), lambda v: urls.absolute_with_dots(v, F.lit(base))) == list(cases.values())


def test_paths_and_hosts(spark):
    u = "https://U@H.test:8080/a/P.JPG?x=1"
    assert column(spark, [u, "no", None], urls.host) == ["u@h.test:8080", "", None]
    (path,) = column(spark, [u], lambda v: urls.content_path(F.lit("s"), v))
    assert path.startswith("images/raw/s/") and path.endswith(".jpg") and path.split("/")[3] == path.split("/")[4][:2]
    assert column(spark, ["https://h/x"], lambda v: urls.content_path(F.lit("s"), v))[0].endswith(".jpg")
    assert column(spark, [7, 1234], lambda v: urls.shard_path(v, "after"), "long") == ["07/7_after.jpg", "34/1234_after.jpg"]
    assert column(spark, ["https://blog.h.test/p?q=1", "https://o.test/"], lambda v: urls.mobile(v, {"blog.h.test": "m.blog.h.test"})) == ["https://m.blog.h.test/p?q=1", "https://o.test/"]
    assert column(spark, ["a b&ç"], urls.quoted) == ["a%20b%26%C3%A7"]


def test_text_labels(spark):
    cases = {
        "Patient received Botox injections to forehead": ("botox", "Botox"), "Dysport treatment for glabellar lines": ("botox", "Dysport"),
        "Lip filler augmentation with Juvederm": ("lip_filler", "Juvederm"), "Cheek filler using Voluma for malar enhancement": ("cheek_filler", "Juvederm Voluma"),
        "Restylane injection for nasolabial folds": ("dermal_filler", "Restylane"), "보톡스 시술 전후 사진": ("botox", "Botox"),
        "preenchimento labial com ácido hialurônico": ("lip_filler", None), "Before and after photos of the patient": (None, None), "": (None, None), None: (None, None),
    }
    got = column(spark, list(cases), texts.text_label)
    assert [(x.category, x.brand) for x in got] == list(cases.values())
    assert [x.confidence for x in got[:2]] == [0.7, 0.7] and got[-1].confidence == 0.0
    assert column(spark, ["Botox injection"], lambda v: texts.text_label(v, 0.99))[0].category is None


def test_small_text_functions(spark):
    assert column(spark, ["안녕", "Olá", "hello", None], texts.detect_language) == ["ko", "pt", "en", "en"]
    got = column(spark, ["before", "x", ""], lambda v: texts.keyword_pair_score(v, F.when(v == "", "").otherwise("after the results")))
    assert [(x.score, x.method) for x in got] == [(0.9, "keyword"), (0.3, "partial"), (0.0, "none")]
    assert column(spark, [["a", None, "", "b"]], texts.pair_text, "array<string>") == ["a b"]
    assert column(spark, ["botox", "?", None], lambda v: texts.prompt(v, F.lit("Q")))[1:] == ["Apply aesthetic facial treatment using Q"] * 2
    assert column(spark, ["LIP_FILLER", "x", None], texts.zones_for) == [["lips", "perioral_lines"], [], []]
    assert column(spark, ["no_face:1", "quality_x", "landmarks_failed", "alignment:z", "pose_yaw", "zzz"], texts.reason_bucket) == ["detection", "quality", "landmarks", "alignment", "pose", "other"]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0])], "a array<float>, b array<float>")
    got = df.select(vectors.cosine(F.col("a"), F.col("b")).alias("c"), vectors.l1(F.col("a"), F.col("b")).alias("l")).collect()
    assert [x.c for x in got] == [1.0, -1.0, 0.0, None] and [x.l for x in got[:2]] == [0.0, 1.0]
    crossed = spark.range(1).select(*[F.array(*map(F.lit, v)).alias(n) for n, v in (("a", [0.0, 1.0]), ("b", [1.0, 0.0]))])
    assert crossed.select(vectors.template_score(F.col("a"), F.col("b"), F.col("b"), F.col("a")).alias("s")).first().s == 0.0


def test_geometry(spark):
    points = [(k, 0.1 * k, 0.2) for k in (33, 362)]
    schema = "array<struct<index:int,x:double,y:double>>"
    iris = [*points, (468, 0.3, 0.4), (473, 0.6, 0.4)]
    got = column(spark, [iris, points, []], geometry.eye_centres, schema)
    assert (got[0].left.x, got[0].right.x) == (0.3, 0.6) and got[1].left.x == pytest.approx(3.3) and got[2] is None
    a = spark.range(1).select(geometry.alignment(*[F.lit(float(x)) for x in (100, 100, 200, 100)]).alias("a")).first().a
    assert a.angle == 0 and a.scale == pytest.approx(0.35 * 512 / 100)
    m = np.array(a.matrix).reshape(2, 3)
    assert m @ [150, 100, 1] == pytest.approx([256, 179.2])
    near = spark.range(1).select(geometry.alignment(*[F.lit(float(x)) for x in (1, 1, 2, 1)]).alias("a")).first().a
    assert near.reason == "eye_distance_too_small" and near.matrix is None
    pose = lambda *v: F.struct(*[F.lit(float(x)).alias(n) for x, n in zip(v, ("yaw", "pitch", "roll"))])
    reasons = spark.range(1).select(geometry.pose_reason(pose(0, 0, 0), pose(15, 15, 10)).alias("a"), geometry.pose_reason(pose(0, 0, 0), pose(0, 20, 20)).alias("b")).first()
    assert reasons.a is None and reasons.b == "pitch_mismatch:20.0>15.0"
    o = spark.range(1).select(*[geometry.ordered(F.lit(k), F.lit(b), F.lit(a)).alias(f"o{i}") for i, (k, b, a) in enumerate((("line_depth", 0.6, 0.4), ("line_depth", 0.4, 0.6), ("volume", 0.1, 0.9), ("x", 1.0, 0.0)))]).first()
    assert [x.passed for x in o] == [True, False, True, True] and [round(x.confidence, 2) for x in o] == [0.7, 0.3, 1.0, 0.5]


def png(img):
    h, w = img.shape
    raw = b"".join(b"\x00" + img[y].astype(np.uint8).tobytes() for y in range(h))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_kernels(spark):
    img = np.full((40, 30), 100.0)
    img[10:20, 5:15] += 60
    assert kernels.decode(png(img)).tolist() == img.tolist()
    assert kernels.decode(b"P5 30 40 255\n" + img.astype(np.uint8).tobytes()).tolist() == img.tolist()
    assert kernels.decode(b"junk") is None and kernels.decode(None) is None and kernels.decode(png(img)[:60]) is None
    assert kernels.sharpness(np.full((9, 9), 7.0)) == 0 and kernels.sharpness(img) > 0
    assert kernels.lighting(np.zeros((4, 4))) == (0.0, 0.0) and kernels.lighting(np.full((4, 4), 9.0)) == (1.0, 9.0)
    unit = img / 127.5 - 1
    assert kernels.ssim(unit, unit) == pytest.approx(1, abs=1e-3) and kernels.ssim(unit, -unit) < 0.5
    slow = np.array([[np.mean(img[max(0, y - 5) : y + 6, max(0, x - 5) : x + 6]) for x in range(30)] for y in range(40)])
    assert np.allclose(kernels.box_mean(img, 11), slow)
    df = spark.createDataFrame([(1, bytearray(png(img))), (2, bytearray(b"x")), (3, None)], "i int, b binary")
    got = [r.q for r in df.orderBy("i").select(kernels.quality_of_bytes("b").alias("q")).collect()]
    assert (got[0].width, got[0].height) == (30, 40) and got[0].blur_score == pytest.approx(kernels.sharpness(img)) and got[1].blur_score is None and got[2].width == 0
    same = spark.createDataFrame([(unit.tolist(), unit.tolist()), (unit.tolist(), None)], "a array<array<double>>, b array<array<double>>").select(kernels.ssim_of_pixels("a", "b").alias("s")).collect()
    assert same[0].s == pytest.approx(1, abs=1e-3) and same[1].s is None


MODEL = [[0.0, 0.0, 0.0], [0.0, 330.0, 65.0], [-225.0, -170.0, 135.0], [225.0, -170.0, 135.0], [-150.0, 150.0, 125.0], [150.0, 150.0, 125.0]]


def test_head_pose_is_found_again(spark):
    rows = []
    for yaw in (-20, 0, 15):
        for pitch in (-10, 5):
            y, p = math.radians(yaw), math.radians(pitch)
            r = np.array([[math.cos(y), 0, math.sin(y)], [0, 1, 0], [-math.sin(y), 0, math.cos(y)]]) @ np.array([[1, 0, 0], [0, math.cos(p), -math.sin(p)], [0, math.sin(p), math.cos(p)]])
            q = np.array(MODEL) @ r.T + [10, -20, 1500]
            pts = np.stack([640 * q[:, 0] / q[:, 2] + 320, 640 * q[:, 1] / q[:, 2] + 240], axis=1)
            rows.append((pts.tolist(), 640, 480, *kernels.euler(r)))
    df = spark.createDataFrame([*rows, (None, 640, 480, 0.0, 0.0, 0.0)], "p array<array<double>>, w int, h int, pitch double, yaw double, roll double")
    got = df.select(kernels.head_pose(MODEL)("p", "w", "h").alias("q"), "pitch", "yaw", "roll").collect()
    for x in got[:-1]:
        assert (x.q.pitch, x.q.yaw, x.q.roll) == pytest.approx((x.pitch, x.yaw, x.roll), abs=0.05)
    assert got[-1].q.yaw is None
