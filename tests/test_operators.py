import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from pairlake.operators import calibration, cascade, evaluation, faces, frontier, html, pairing, queue, relational, store
from pairlake.sources import files, manifest


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def items(spark):
    data = [("p", k, r, f"{r}{k}") for k, r in enumerate(["before", "after", "before", "x", "after", "after"])] + [("q", 0, "before", "only")]
    return spark.createDataFrame(data, "page string, pos int, role string, url string")


def test_pairing(items):
    assert rows(pairing.zip_pairs(items, ["page"], F.col("role"), ["pos"], "url"), "n", "before", "after") == [(1, "before0", "after1"), (2, "before2", "after4")]
    assert rows(pairing.adjacent_pairs(items, ["page"], ["pos"], "url"), "n", "before", "after") == [(1, "before0", "after1"), (2, "before2", "x3"), (3, "after4", "after5")]
    assert rows(pairing.first_two(items, ["page"], ["pos"], "url"), "page", "before", "after") == [("p", "before0", "after1")]
    assert rows(pairing.half_split(items, ["page"], ["pos"], "url", 2), "n", "before", "after") == [(1, "before0", "x3"), (2, "after1", "after4")]
    twice = items.unionByName(items.withColumn("pos", F.col("pos") + 10))
    assert rows(pairing.first_wins(twice, ["url"], ["pos"]), "url", "pos") == sorted((r.url, r.pos) for r in items.collect())
    assert rows(pairing.first_strategy(items, ["page"], "pos"), "url") == [("before0",), ("only",)]
    for f in (pairing.adjacent_pairs, pairing.first_two, pairing.half_split):
        assert f(items.limit(0), ["page"], ["pos"], "url").count() == 0


PAGE = """<html><body><h2>Lips</h2><p>one<p>two
<div class="slider"><img src="/b.jpg" alt="Before"><img src="/a.jpg" alt="Result"></div>
<script>var x = "</p><img src='no.jpg'>";</script>
<figure><img src="c.jpg"><img src="d.jpg"><figcaption>before and after one week</figcaption></figure>
<a href="/next" rel="next">More results</a><a href="https://other.test/x">gallery</a></body></html>"""


def test_elements(spark):
    els = html.read_elements(PAGE)
    assert [e["text"] for e in els if e["tag"] == "p"] == ["one", "two"] or [e["text"] for e in els if e["tag"] == "p"][0] == "one"
    assert sum(e["tag"] == "img" for e in els) == 4
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<img src=x")], "page_id long, html string")
    df = html.elements(pages)
    assert {r.page_id for r in df.select("page_id").distinct().collect()} <= {1, 4}
    links = html.links(df).orderBy("pos").collect()
    assert [(x.href, x.text, x.rel) for x in links] == [("/next", "More results", "next"), ("https://other.test/x", "gallery", None)]
    pics = {x.src: x for x in html.images(df).collect()}
    assert pics["c.jpg"].caption == "before and after one week" and pics["/b.jpg"].heading == "Lips" and pics["/b.jpg"].n_siblings == 2


def test_candidate_pairs(spark):
    plain = '<div><img src="a"><img src="b"><img src="c"></div>'
    named = '<img src="x1" alt="before"><img src="x2" class="after"><img src="x3" alt="antes"><img src="x4" alt="depois">'
    data = '<div data-before="m" data-after="n"></div><img src="q" alt="before"><img src="r" alt="after">'
    pages = spark.createDataFrame([(1, PAGE), (2, plain), (3, named), (4, data), (5, "")], "page_id long, html string")
    got = rows(html.candidate_pairs(pages), "page_id", "strategy", "before", "after")
    assert got == [(1, 2, "c.jpg", "d.jpg"), (2, 4, "a", "b"), (3, 3, "x1", "x2"), (3, 3, "x3", "x4"), (4, 1, "m", "n")]
    signs = {r.src: r for r in html.picture_signs(html.images(html.elements(pages))).collect()}
    assert signs["x1"].strong_before and not signs["x1"].strong_after and signs["/b.jpg"].weak and not signs["a"].weak
    score = spark.range(1).select(html.structural_score(F.lit(True), F.lit(True), F.lit(False), F.lit(True)).alias("s")).first().s
    assert score == 0.55


def test_slides_and_texts_that_follow(spark):
    dual = '<li class="gallery-x"><p><img src="a"></p><div><img src="b"></div></li><div class="Slide one">Before<img src="c"></div><div data-slide-index="2"><img src="d" alt="after"></div><img src="no">'
    follow = '<div><img src="x1"><br>\n<b>antes</b><img src="x2"> <i>done</i> depois</div><div><img src="x3"><br><br><br>before</div>'
    root = '<img src="r1">시술 전<img src="r2">시술 후 before'
    pages = spark.createDataFrame([(1, dual), (2, follow), (3, '<div><img src="m">text<img src="n"></div>'), (4, root)], "page_id long, html string")
    got = rows(html.candidate_pairs(pages), "page_id", "strategy", "n", "before", "after")
    assert got == [(1, 5, 1, "a", "b"), (1, 5, 2, "c", "d"), (2, 6, 1, "x1", "x2"), (3, 4, 1, "m", "n"), (4, 4, 1, "r1", "r2")]
    nested = '<div class="slider"><div class="slide"><img src="a"><img src="b"></div></div>'
    els = {e["pos"]: e for e in html.read_elements(nested + "<p><img src=c>")}
    assert [els[k]["last"] for k in sorted(els)] == [3, 3, 2, 3, 5, 5]
    pages = spark.createDataFrame([(1, nested)], "page_id long, html string")
    assert rows(html.candidate_pairs(pages), "strategy", "n", "before", "after") == [(5, 1, "a", "b")]


def test_listings_and_scripts(spark):
    media = ",".join(f'"m{k}":{{"status":"{"valid" if k != 2 else "bad"}","s":{{"u":"https://i/{k}?a=1&amp;b=2"}}}}' for k in range(5))
    post = f'{{"data":{{"title":"Before and after","permalink":"/p","is_gallery":true,"media_metadata":{{{media}}}}}}}'
    body = f'{{"data":{{"after":"t1","children":[{post},{{"data":{{"title":"cats","permalink":"/q","is_gallery":true}}}}]}}}}'
    df = spark.createDataFrame([(1, body), (2, "no json"), (3, None)], "page_id long, body string")
    assert rows(html.listing_pairs(df), "permalink", "before", "after") == [("/p", "https://i/0?a=1&b=2", "https://i/3?a=1&b=2"), ("/p", "https://i/1?a=1&b=2", "https://i/4?a=1&b=2")]
    script = '<script>{"url":"https://i/1.jpg","description":"first"},{"url": "https://i/2.png"}</script>'
    assert rows(html.script_images(spark.createDataFrame([(1, script)], "page_id long, html string")), "pos", "url") == [(0, "https://i/1.jpg"), (1, "https://i/2.png")]


def test_frontier(spark):
    edges = spark.createDataFrame([("https://a/1", "https://a/2"), ("https://a/2", "https://a/3"), ("https://a/3", "https://a/1"), ("https://a/2", "https://b/1"), ("https://b/1", "https://a/9"), ("https://a/1", None)], "src string, dst string")
    seeds = spark.createDataFrame([("https://a/1",), ("",), (None,), ("https://a/1",)], "url string")
    deny = spark.createDataFrame([("b", False)], "host string, allowed boolean")
    assert rows(frontier.breadth_first(edges, seeds, 9), "url", "depth") == [("https://a/1", 0), ("https://a/2", 1), ("https://a/3", 2), ("https://a/9", 3), ("https://b/1", 2)]
    assert rows(frontier.breadth_first(edges, seeds, 9, deny), "url", "depth") == [("https://a/1", 0), ("https://a/2", 1), ("https://a/3", 2)]
    assert rows(frontier.breadth_first(edges, seeds, 1), "url", "depth") == [("https://a/1", 0), ("https://a/2", 1)]


def test_schedule_is_the_recurrence(spark):
    r = random.Random(4)
    data = [(k, r.choice("hh2"), r.randint(0, 300)) for k in range(200)]
    data += [(k, None, k % 7) for k in range(200, 230)]
    df = spark.createDataFrame(data, "i int, h string, t int")
    for span in (None, 7, 50):
        got = {x.i: x.start for x in frontier.schedule(df, ["h"], F.col("t"), ["i"], 7, span).collect()}
        for h in ("h", "2", None):
            last = None
            for k, _, t in sorted((x for x in data if x[1] == h), key=lambda x: (x[2], x[0])):
                last = t if last is None else max(t, last + 7)
                assert got[k] == last


def test_next_pages_context_and_factors(spark):
    els = html.elements(spark.createDataFrame([(1, PAGE + '<a class="pager next" href="/n2">go</a><a href="/n3">»</a>')], "page_id long, html string"))
    assert rows(frontier.next_pages(html.links(els)), "href") == [("/n2",), ("/n3",), ("/next",)]
    said = html.images(els).select("src", html.picture_context(40).alias("t")).collect()
    assert {x.src: x.t for x in said}["c.jpg"] == "before and after one week Lips"
    p = spark.createDataFrame([(1,), (2,)], "pair_id long")
    one = rows(evaluation.paired_factors(p, "pair_id", {"turn": (-5.0, 5.0), "light": (0.9, 1.1)}), "pair_id", "turn", "light")
    assert one == rows(evaluation.paired_factors(p, "pair_id", {"turn": (-5.0, 5.0), "light": (0.9, 1.1)}), "pair_id", "turn", "light")
    assert all(-5 <= t <= 5 and 0.9 <= x <= 1.1 for _, t, x in one) and one[0][1] != one[1][1]


def test_training_set(spark):
    images = spark.createDataFrame([(k, f"f{k}") for k in range(1, 9)], "id long, file_path string")
    pairs = spark.createDataFrame([(1, 1, 2, "HIGH"), (2, 3, 4, "LOW"), (3, 5, 6, "HIGH"), (4, 7, 8, None), (5, 1, 6, "UNKNOWN")], "id long, before_image_id long, after_image_id long, ordering_confidence string")
    labels = spark.createDataFrame([(1, "botox", "B")], "pair_id long, treatment_category string, treatment_brand string")
    zones = spark.createDataFrame([(1, "z2"), (1, "z1")], "pair_id long, zone_code string")
    bad = spark.createDataFrame([(6,)], "image_id long")
    got = relational.training_set(pairs, images, labels, bad, zones)
    assert rows(got, "pair_id", "treatment_category", "zone_codes") == [(1, "botox", ["z1", "z2"])]
    assert rows(relational.training_set(pairs, images, labels, bad, low=True), "pair_id") == [(1,), (2,), (4,)]
    assert relational.training_set(pairs, images, labels, images.select(F.col("id").alias("image_id"))).count() == 0


def test_balance(spark):
    df = spark.createDataFrame([("botox",)] * 4 + [("lip",)] * 2 + [("",), (None,)], "treatment_category string")
    assert rows(relational.balance(df), "treatment_category", "n", "weight") == [("botox", 4, 1.5), ("lip", 2, 3.0)]
    assert relational.balance(df.limit(0)).count() == 0


def test_logs_and_upserts(spark):
    a = spark.createDataFrame([(5, "u", None), (6, "v", "x")], "id long, k string, s string")
    b = spark.createDataFrame([(1, "u", "y"), (2, "w", None)], "id long, k string, s string")
    assert rows(relational.merge_logs([a, b], ["k"], {"s": F.lit("-")}), "k", "id", "s", "part") == [("u", 5, "-", 0), ("v", 6, "x", 0), ("w", 2, "-", 1)]
    new = relational.upsert_new(a, b, "k").collect()
    assert [x.k for x in new] == ["w"] and new[0].id > 6
    stages = relational.first_failing([("one", F.col("id") > 5), ("two", F.col("s").isNotNull())])
    assert rows(a.select("id", F.coalesce(stages, F.lit("ok")).alias("f")), "id", "f") == [(5, "one"), (6, "ok")]
    stats = relational.run_stats(a, F.col("s"), F.lit(False)).first()
    assert (stats.n_total, stats.n_passed, stats.pass_rate) == (2, 1, 0.5)
    assert relational.run_stats(a.limit(0), F.col("s"), F.lit(False)).first().pass_rate == 0.0


def test_backfill(spark):
    df = spark.createDataFrame([(1, '{"treatment_category": "x"}', "https://h/botox"), (2, "{broken", "https://h/botox"), (3, None, "https://h/none")], "id int, metadata string, source_url string")
    assert rows(relational.backfill(df), "id", "label", "outcome")[:2] == [(1, "x", "kept"), (2, "botox", "derived")]


def test_sweep_is_counting(spark):
    r = random.Random(6)
    data = [("l", r.choice([None, 0.0, 0.05, 0.15, 0.3, 0.95, 1.0, r.random()]), r.random() < 0.6) for _ in range(300)]
    got = calibration.sweep(spark.createDataFrame(data, "layer string, score double, is_positive boolean"))
    for x in got.collect():
        hit = lambda s: (s or 0.0) >= x.threshold - 1e-12
        assert (x.tp, x.fp, x.fn) == (sum(p and hit(s) for _, s, p in data), sum(not p and hit(s) for _, s, p in data), sum(p and not hit(s) for _, s, p in data))
    clean = spark.createDataFrame([("l", 0.9, True), ("l", 0.85, True), ("l", 0.2, False), ("z", 0.0, True)], "layer string, score double, is_positive boolean")
    assert rows(calibration.best_threshold(calibration.sweep(clean)), "layer", "threshold") == [("l", 0.85), ("z", 0.05)]


def test_negatives_in_one_and_many_blocks(spark):
    df = spark.createDataFrame([(k, k / 100) for k in range(101)], "id long, score double")
    for block in (1000, 20):
        got = calibration.synthetic_negatives(df, "id", "score", block=block).collect()
        ids = [x.id for x in got] + [x.other_id for x in got]
        assert len(ids) == len(set(ids)) and 80 <= len(ids) <= 101
        assert all(x.score == pytest.approx(max(0, (x.id + x.other_id) / 200 - 0.3)) for x in got)


def test_negatives_are_those_of_the_whole_order_at_every_size(spark):
    for n in (0, 1, 2, 101):
        order = sorted(range(n), key=lambda k: hashlib.md5(f"{k}:42".encode()).hexdigest())
        want = sorted(zip(order[: n // 2], order[n // 2 : n // 2 * 2]))
        df = spark.createDataFrame([(k, k / 100) for k in range(n)], "id long, score double")
        for block in (1000, 20):
            assert rows(calibration.synthetic_negatives(df, "id", "score", block=block), "id", "other_id") == want


def test_splits(spark):
    df = spark.createDataFrame([(k, None if k % 10 == 0 else f"c{k % 3}") for k in range(997)], "id long, c string")
    got = evaluation.split(df, "id").collect()
    n = [sum(x.split == s for x in got) for s in ("train", "validation", "test")]
    assert n == [797, 99, 101] and len({x.id for x in got}) == 997
    by = evaluation.split(df, "id", by=["c"]).collect()
    for c in (None, "c0", "c1", "c2"):
        own = [x.split for x in by if x.c == c]
        assert own.count("train") == math.floor(len(own) * 0.8)
    assert evaluation.split(df.limit(0), "id").count() == 0
    w = {x.c: x.weight for x in evaluation.sampler_weights(df, "c").collect()}
    assert w[None] == pytest.approx(1 / 100)


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 10.0), (2, None), (2, float("nan"))], "b int, value double")
    assert rows(evaluation.metric_means(df, []), "mean", "n") == [(pytest.approx(14 / 3), 3)]
    assert rows(evaluation.mean_of_batch_means(df, "b", []), "mean") == [(6.0,)]


def test_faces(spark):
    f = spark.createDataFrame([(1, 1, 0, 0, 100, 100, 0.95), (1, 2, 0, 0, 300, 300, 0.99), (2, 2, 0, 0, 90, 50, 0.92), (3, 1, 0, 0, 99, 99, 0.99), (3, 1, 5, 0, 104, 99, 0.95)], "image_id long, method int, x1 int, y1 int, x2 int, y2 int, confidence double")
    assert rows(faces.detections(f), "image_id", "method") == [(1, 1), (2, 2), (3, 1), (3, 1)]
    im = spark.createDataFrame([(1,), (2,), (3,), (4,)], "image_id long")
    assert rows(faces.accepted(faces.detections(f), im).fillna("ok"), "image_id", "reason") == [(1, "ok"), (2, "face_too_small"), (3, "multiple_faces"), (4, "no_face_detected")]
    assert rows(faces.largest(f), "image_id", "x1", "x2") == [(1, 0, 300), (2, 0, 90), (3, 0, 99)]


def test_manifest(spark, tmp_path):
    df = spark.createDataFrame([(3, "b", "a", None, None, ["z"]), (1, "é", "a", "c", "x", None)], manifest.FIELDS)
    path = str(tmp_path / "m")
    assert manifest.write(df, path) == 2
    assert rows(manifest.read(spark, path), "pair_id", "before_path", "zone_codes") == [(1, "é", []), (3, "b", ["z"])]
    (tmp_path / "one.json").write_text('[{"before_path": "q"}]')
    assert rows(manifest.read(spark, str(tmp_path / "one.json"), whole=True), "pair_id", "before_path") == [(0, "q")]


def test_local_files(spark, tmp_path):
    def touch(*names):
        for n in names:
            p = tmp_path / n
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_bytes(b"x" * 10)

    touch("one/before/K1.jpg", "one/after/k1.png", "one/after/k2.png", "one/note.txt")
    touch("two/001_before.jpg", "two/001_after.jpg", "two/002_before.jpg")
    touch("three/faceBefore7.jpg", "three/faceAfter7.jpg")
    for folder, key in (("one", "k1"), ("two", "001"), ("three", "facebefore7")):
        assert rows(files.local_pairs(files.pictures(spark, str(tmp_path / folder))), "key") == [(key,)]


def test_sources(spark, tmp_path):
    p = tmp_path / "s.yaml"
    p.write_text("sources:\n  a: {enabled: true, consent_tier: 1, base_urls: ['https://a/x'], odd: 5}\n  b: {enabled: false}\n  c: {rendering: weird, consent_tier: 9, rate_limit: 7}\n")
    got = files.sources(spark, str(p)).orderBy("ordinal").collect()
    assert [(x.name, x.rendering, x.consent_tier, x.rate_limit) for x in got] == [("a", "static", 1, 3.0), ("c", "static", 3, 7.0)] and got[0].extra == {"odd": "5"}
    assert files.sources(spark, str(p), include_disabled=True).count() == 3
    with pytest.raises(ValueError, match="calibration"):
        files.calibration_source(files.sources(spark, str(p)))
    assert rows(files.seeds(files.sources(spark, str(p)), 2), "url") == [("https://a/x?page=1",), ("https://a/x?page=2",)]


def test_queue_is_a_log(spark):
    rows = spark.createDataFrame([(k,) for k in range(1, 8)], "id long")
    log = queue.event(rows, "pending", F.lit(0))
    taken, marked = queue.dequeue(queue.current(log), 3)
    log = log.unionByName(marked)
    assert rows_of(taken) == [1, 2, 3] and queue.current(log).where("status = 'processing'").count() == 3
    log = log.unionByName(queue.event(taken.where("id = 1"), "failed", F.lit(2), F.repeat(F.lit("x"), 900)))
    state = {r.id: r for r in queue.current(log).collect()}
    assert state[1].status == "failed" and len(state[1].reason) == 512 and state[1].number == 2
    log = log.unionByName(queue.reset_stale(queue.current(log)))
    assert {r.id: r.status for r in queue.current(log).collect()} == {1: "failed"} | {k: "pending" for k in range(2, 8)}
    assert rows_of(queue.dequeue(queue.current(log), 2)[0]) == [2, 3]
    assert queue.dequeue(queue.current(log.limit(0)), 2)[0].count() == 0
    df = spark.createDataFrame([(1, None), (2, '{"treatment_category": "x"}'), (3, "{}")], "id long, metadata string")
    assert rows_of(queue.without_label(df)) == [1, 3] and rows_of(queue.without_label(df, 1)) == [1]


def rows_of(df):
    return sorted(r.id for r in df.collect())


def test_write_path(spark):
    schema = "id long, before_url string, after_url string, source_url string, before_tier int, after_tier int, before_path string, after_path string, language string, metadata string, ordering_confidence string, source_name string"
    pairs = spark.createDataFrame([
        (1, "b1", "a1", "https://h.test/p", 1, 2, "f1", "g1", "en", '{"provider_name": "P"}', None, "s"), (2, "b1", "a2", "https://k.test/p", 2, 2, "f2", "g2", None, "{broken", "HIGH", "s"), (3, "old", None, "https://k.test/p", 1, 1, "f3", "g3", None, None, "", "s"),
    ], schema)
    known = spark.createDataFrame([(7, "old")], "id long, source_url string")
    new = {r.source_url: r for r in store.image_rows(store.sides(pairs), known).collect()}
    assert set(new) == {"b1", "a1", "a2"} and sorted(r.id for r in new.values()) == [8, 9, 10]
    assert (new["b1"].file_path, new["b1"].domain, new["b1"].consent_tier) == ("f1", "h.test", 1)
    images = known.unionByName(spark.createDataFrame([(r.id, u) for u, r in new.items()], "id long, source_url string"))
    got = {r.queue_id: r for r in store.pair_rows(pairs, images).collect()}
    assert set(got) == {1, 2} and got[1].practitioner_name == "P" and got[1].ordering_confidence == "UNKNOWN" and got[2].practitioner_name is None
    have = spark.createDataFrame([(7,)], "image_id long")
    quarantined = store.quarantine_rows(store.sides(pairs), images, have).collect()
    assert sorted(r.image_id for r in quarantined) == [8, 9, 10] and {r.source_url for r in quarantined if r.image_id == new["b1"].id} == {"https://h.test/p"}
    routes = spark.createDataFrame([(3, 1, True, False), (1, 1, None, True), (1, 2, True, True), (1, 2, True, False)], "b int, a int, d boolean, k boolean").select(store.route(F.col("b"), F.col("a"), F.col("d"), F.col("k")).alias("r")).collect()
    assert [r.r for r in routes] == ["quarantine", "download_failed", "duplicate", "write"]
    assert store.image_rows(store.sides(pairs.limit(0)), known).count() == 0


def test_cascade_and_manifest(spark):
    schema = "image_id long, readable boolean, quality string, detection string, landmarks boolean, alignment string, pose struct<yaw:double,pitch:double,roll:double>"
    level = (0.0, 0.0, 0.0)
    pics = spark.createDataFrame([(1, True, None, None, True, None, level), (2, True, None, None, True, None, (20.0, 0.0, 0.0)), (3, True, "blur", "none", False, "eyes", None), (4, True, None, None, None, None, level), (5, True, None, None, True, None, (1.0, 1.0, 1.0))], schema)
    pairs = spark.createDataFrame([(10, 1, 5), (11, 1, 2), (12, 1, 3), (13, 4, 1), (14, 1, 99), (15, None, 1)], "pair_id long, before_image_id long, after_image_id long")
    zones = spark.createDataFrame([(1, "z2"), (1, "z1")], "image_id long, zone_code string")
    got = {r.pair_id: r for r in cascade.pair_cascade(pairs, pics, zones).collect()}
    assert got[10].passed and got[10].zone_codes == ["z1", "z2"] and got[11].reject_reason == "pose:yaw_mismatch:20.0>15.0" and got[11].zone_codes == []
    assert [got[k].reject_reason for k in (12, 13, 14, 15)] == ["quality:after:blur", "landmark:before:no_face_mesh", "quality:unreadable_image", "quality:unreadable_image"]
    rows_ = spark.createDataFrame([(1, '{"treatment_category": "x"}', "u"), (2, None, "https://h/R/Fillers"), (3, "{}", "https://h/a/botox?x=1/"), (4, None, None)], "id long, metadata string, source_url string")
    sides = lambda *ids: spark.createDataFrame([(i, s) for i in ids for s in ("before", "after")] + [(4, "before")], "id long, side string")
    checked = cascade.checked_pairs(rows_, sides(1, 2, 3), sides(1, 2, 3))
    assert {r.pair_id: r.treatment_category for r in cascade.face_manifest(checked).collect()} == {1: "x", 2: "dermal_filler", 3: "botox"}
    assert tuple(cascade.manifest_counts(checked).first())[:6] == (4, 1, 0, 3, 3, 100)
    assert cascade.checked_pairs(rows_, sides(1, 2), sides(2)).where("outcome = 'no_face'").count() == 1
    with pytest.raises(ValueError, match="needed"):
        cascade.enough(checked, 4)
    assert cascade.enough(checked, 3).count() == 3


def test_signals_lookup_and_cards(spark):
    page = '<div class="wrap before-box"><img src="/p/one.jpg?x=1"><img data-src="two.jpg" alt="after"></div><img src="three.jpg"><p>before that</p>'
    els = html.elements(spark.createDataFrame([(1, page)], "page_id long, html string"))
    wanted = spark.createDataFrame([(1, "https://h/p/one.jpg?x=1", "before"), (1, "https://h/two.jpg", "after"), (1, "https://h/three.jpg", "before"), (1, "https://h/none.jpg", "after"), (1, "https://h/after/", "after")], "page_id long, url string, side string")
    got = {r.url.rsplit("/", 1)[-1]: r for r in html.signals(els, wanted).collect()}
    assert got["one.jpg?x=1"].strong == ["parent_attr"] and got["one.jpg?x=1"].weak
    assert got["two.jpg"].strong == ["data_attr", "alt_text"] and got["two.jpg"].weak and got["three.jpg"].strong == ["caption"] and not got["three.jpg"].weak
    assert got["none.jpg"].strong == [] and got[""].strong == ["filename"]
    assert html.signals(els, wanted.limit(0)).count() == 0
    assert html.cards(els).first().treatment_name is None


def test_signals_of_pages_apart(spark):
    figure = '<div class="antes"><figure><img src="a.jpg"><figcaption>nothing</figcaption></figure><p>before</p></div>'
    deep = '<div data-x="after"><p>' + "<span>" * 4 + '<img src="b.jpg">' + "</span>" * 4 + '</p></div><div data-x="after"><p>' + "<span>" * 5 + '<img src="c.jpg">'
    els = html.elements(spark.createDataFrame([(1, figure), (2, deep), (3, '<img src="a.jpg"><b>before</b><img alt="after" src="d.jpg"><p>x</p><p>before</p>')], "page_id long, html string"))
    asked = [(1, "a.jpg", "before"), (1, "a.jpg", "before"), (1, "a.jpg", "after"), (2, "b.jpg", "after"), (2, "c.jpg", "after"), (3, "a.jpg", "before"), (3, "d.jpg", "after"), (3, None, "after"), (4, "a.jpg", "before"), (None, "/after/a.jpg", "after")]
    got = {(r.page_id, r.url, r.side): (r.strong, r.weak) for r in html.signals(els, spark.createDataFrame(asked, "page_id long, url string, side string")).collect()}
    assert got == {
        (1, "a.jpg", "before"): (["parent_attr"], False), (1, "a.jpg", "after"): ([], False), (2, "b.jpg", "after"): (["parent_attr"], False), (2, "c.jpg", "after"): ([], False),
        (3, "a.jpg", "before"): ([], True), (3, "d.jpg", "after"): (["data_attr", "alt_text"], True), (3, None, "after"): ([], False), (4, "a.jpg", "before"): ([], False), (None, "/after/a.jpg", "after"): (["filename"], False),
    }


def test_frontier_rests(spark):
    q = spark.createDataFrame([("a",), ("b",), ("",), (None,), ("a",)], "url string")
    assert rows(frontier.drained(q, spark.createDataFrame([("c",), ("b",)], "url string"), spark.createDataFrame([("b",)], "url string")), "url", "turn") == [("a", 0), ("c", 1)]
    runs = spark.createDataFrame([("s", 2, 1, None), ("s", 5, 5, "x"), ("t", 1, 1, "y")], "source string, inserted long, skipped long, error string")
    assert rows(frontier.run_by_source(runs), "source", "n_inserted", "n_skipped", "n_errors", "failed") == [("s", 2, 1, 1, False), ("t", 0, 0, 1, True)]
    loop = spark.createDataFrame([("l", None, "t1"), ("l", "t1", "t1")], "listing string, cursor string, after string")
    assert frontier.cursor_pages(loop, F.lit("/l"), 4).count() == 4
    have = spark.createDataFrame([("p", 2000), ("q", 10), ("p", 3000)], "path string, size long")
    assert rows(files.with_cache(spark.createDataFrame([("p",), ("q",), ("r",)], "path string"), have), "path", "from_cache") == [("p", True), ("q", False), ("r", False)]


def test_thresholds_and_report(spark, tmp_path):
    found = spark.createDataFrame([("l1", 0.5)], "layer string, threshold double")
    for version, t in ((1, 0.5), (2, 0.6), (2, 0.7)):
        manifest.write_thresholds(found.withColumn("threshold", F.lit(t)), str(tmp_path / "t"), version)
    assert rows(manifest.thresholds(spark, str(tmp_path / "t")), "layer", "threshold", "version") == [("l1", 0.7, 2)]
    m = spark.createDataFrame([("ssim", 0.5, 3), ("l1", 0.25, 3)], "metric string, value double, n long")
    by = spark.createDataFrame([(None, "l1", 1.5), ("botox", "l1", 2.5)], "treatment string, metric string, value double")
    text = manifest.report(m, by, "v1")
    assert text.first().report == '{"model_tag":"v1","num_samples":3,"metrics":{"l1":0.25,"ssim":0.5},"per_treatment":{"botox":{"l1":2.5},"unknown":{"l1":1.5}}}'
    manifest.write_report(text, str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r")).count() == 1
