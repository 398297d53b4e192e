"""All queries of the core library over the project's tables, and the SQL they are checked against.

Tables that the data don't have are stood in for: an image is quarantined if its consent tier is 3,
pages are the source_url of staged pairs, landmarks and poses come from the embeddings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlake.functions import geometry, texts, urls, vectors
from pairlake.operators import calibration, evaluation, faces, frontier, html, pairing, relational
from pairlake.plans import pages, pictures, stores
from pairlake.plans.sql import SQL
from pairlake.runtime import BROADCAST_ROWS, cut, fresh_path, table
from pairlake.sources import files, manifest
from pairlake.streaming import log

PAIR = ["before_url", "after_url"]
LIMITS = {"min_width": 200, "min_height": 200, "min_blur": 80.0, "min_uniformity": 0.35, "min_brightness": 15.0, "max_brightness": 245.0}
ZONES = [("left", 0, [0, 1, 2, 3, 4, 4]), ("middle", 1, [20, 21, 22, 23, 24, 25, 26]), ("right", 2, [60, 61, 62, 63]), ("mixed", 3, [0, 21, 42, 63]), ("none", 4, [])]


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "image_pair").dropDuplicates(["id"])


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "treatment_label").dropDuplicates(["id"])


def _quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "image").where("consent_tier = 3").select(F.col("id").alias("image_id"))


def training_set(spark: SparkSession, sf: str) -> DataFrame:
    return relational.training_set(_pairs(spark, sf), table(spark, sf, "image"), _labels(spark, sf), _quarantine(spark, sf))


def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return relational.balance(_labels(spark, sf))


def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf).groupBy("treatment_category").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "treatment_category")


def sampler_weights(spark: SparkSession, sf: str) -> DataFrame:
    w = evaluation.sampler_weights(_labels(spark, sf).select("id", "treatment_category"), "treatment_category")
    return w.select("id", F.round("weight", 9).alias("weight"))


def queue_stats(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "staging_queue").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["id", *PAIR, "source_url", "source_name", "language", "consent_tier", "metadata", "created_at"]
    old = table(spark, sf, "staging_queue").select(*cols, F.lit(0).alias("batch_no"))
    return old.unionByName(table(spark, sf, "staging_incoming").select(*cols, "batch_no"))


def queue_dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return pairing.first_wins(_staged(spark, sf).select("id", *PAIR, "source_name", "batch_no"), PAIR, ["id"])


def enqueue_counts(spark: SparkSession, sf: str) -> DataFrame:
    first = _staged(spark, sf).groupBy(*PAIR).agg(F.min("id").alias("id")).select("id", F.lit(1).alias("new"))
    own = table(spark, sf, "staging_incoming").select("id", "batch_no").join(first, "id", "left")
    return own.groupBy("batch_no").agg(F.count("new").alias("n_inserted"), (F.count(F.lit(1)) - F.count("new")).alias("n_skipped"))


def dequeue_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The oldest 20 pending rows: the batch size is the feature."""
    return table(spark, sf, "staging_queue").where("status = 'pending'").select("id", *PAIR).orderBy("id").limit(20)


def is_duplicate(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "staging_queue").select(*PAIR)
    return table(spark, sf, "staging_incoming").join(known, PAIR, "left_semi").select("id")


def latest_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "balance_report").select("report_id", "treatment_category", "pair_count", "weight", "reported_at")
    return relational.latest(rows, ["report_id", "treatment_category"], ["reported_at", "pair_count"]).drop("reported_at")


def merge_queues(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["id", *PAIR, "source_name", "language", "consent_tier"]
    parts = [table(spark, sf, "staging_queue").where("status = 'done'").select(*cols), table(spark, sf, "staging_incoming").select(*cols), table(spark, sf, "staging_queue").where("status = 'pending'").select(*cols)]
    defaults = {"source_name": F.lit("merged"), "language": F.lit("en"), "consent_tier": F.lit(2)}
    return relational.merge_logs(parts, PAIR, defaults).select("id", "source_name", "language", "consent_tier", "part")


def label_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return relational.label_coverage(table(spark, sf, "staging_queue"), F.coalesce(F.col("metadata").like("%treatment_category%"), F.lit(False)), ["status"])


def backfill(spark: SparkSession, sf: str) -> DataFrame:
    return relational.backfill(table(spark, sf, "staging_queue")).select("id", "label", "outcome")


def _items(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "staging_queue").select("id", F.col("source_url").alias("page"), F.explode(F.array(F.struct(F.lit("before").alias("role"), F.col("before_url").alias("url")), F.struct(F.lit("after").alias("role"), F.col("after_url").alias("url")))).alias("x"))
    return q.select("page", "id", "x.role", "x.url")


def zip_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairing.zip_pairs(_items(spark, sf), ["page"], F.col("role"), ["id"], "url")


def adjacent_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairing.adjacent_pairs(_items(spark, sf).where("role = 'before'"), ["page"], ["id"], "url")


def half_split_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairing.half_split(_items(spark, sf).where("role = 'after'"), ["page"], ["id"], "url")


def first_two(spark: SparkSession, sf: str) -> DataFrame:
    return pairing.first_two(_items(spark, sf).where("role = 'after'"), ["page"], ["id"], "url")


def first_strategy(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "staging_queue").select("id", F.col("source_url").alias("page"), F.when(F.col("consent_tier") == 1, 1).otherwise(2).alias("strategy"))
    return pairing.first_strategy(q, ["page"], "strategy")


def content_path(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "image").select("id", urls.content_path(F.lit("gallery"), F.col("source_url")).alias("path"))


def shard_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).groupBy(F.substring(urls.shard_path(F.col("id"), "before"), 1, 2).alias("shard")).agg(F.count(F.lit(1)).alias("n"))


def host_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "image").groupBy(urls.host(F.col("source_url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


def url_label(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of page addresses, to which the staged label is joined as a path part so that every rule has hits."""
    name = F.replace(F.coalesce(relational.json_field("metadata", "treatment_name"), F.lit("")), F.lit(" "), F.lit("-"))
    made = F.concat("source_url", F.element_at(F.array(*[F.lit(x) for x in ("", "/botox", "/lip-filler-results-3", "/r/fillers", "/myfaceliftstory")]), (F.col("id") % 5 + 1).cast("int")), F.lit("/"), name)
    return table(spark, sf, "staging_queue").select("id", made.alias("u")).select("id", urls.url_label(F.col("u")).alias("label"))


def text_label(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", texts.text_label(F.col("text")).alias("l"))
    return rows.select("doc_id", F.col("l.category").alias("category"), F.col("l.brand").alias("brand"), F.col("l.confidence").alias("confidence"), F.col("l.n").alias("n"))


def language_detect(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", texts.detect_language(F.col("text")).alias("language"))


def keyword_score(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", texts.keyword_pair_score(F.col("text"), F.col("text")).alias("s"))
    return rows.select("doc_id", "s.score", "s.method")


def consistency_score(spark: SparkSession, sf: str) -> DataFrame:
    """Template scores of neighbouring embeddings against two fixed ones."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("after"))
    top = e.agg(F.min_by("embedding", "vec_id").alias("tb"), F.max_by("embedding", "vec_id").alias("ta"))
    joined = e.join(nxt, "vec_id").join(F.broadcast(top), F.lit(True))
    return joined.select("vec_id", vectors.template_score(F.col("embedding"), F.col("after"), F.col("tb"), F.col("ta")).alias("score"))


def threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return calibration.sweep(_samples(spark, sf)).select("layer", "threshold", "tp", "fp", "fn", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


def best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return calibration.best_threshold(calibration.sweep(_samples(spark, sf)), 0.3, 0.5)


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    p = _pairs(spark, sf).where("ordering_confidence is not null")
    score = lambda k: F.struct(F.lit(k).alias("layer"), F.when(~F.isnan(f"{k}_score"), F.col(f"{k}_score")).alias("score"))
    return p.select(F.explode(F.array(score("layer1"), score("layer2"), score("layer3"))).alias("x"), (F.col("ordering_confidence") == "HIGH").alias("is_positive")).select("x.layer", "x.score", "is_positive")


def synthetic_negatives(spark: SparkSession, sf: str) -> DataFrame:
    p = _pairs(spark, sf).where("ordering_confidence = 'HIGH'").select("id", F.when(~F.isnan("layer2_score"), F.col("layer2_score")).alias("score"))
    return calibration.synthetic_negatives(p, "id", "score")


def validation_funnel(spark: SparkSession, sf: str) -> DataFrame:
    ok = lambda c, t: (F.col(c) >= t) & ~F.isnan(c)
    stage = relational.first_failing([("structure", ok("layer1_score", 0.55)), ("text", ok("layer2_score", 0.5)), ("person", ok("layer3_score", 0.4))])
    return _pairs(spark, sf).groupBy(F.coalesce(stage, F.lit("passed")).alias("stage")).agg(F.count(F.lit(1)).alias("n"))


def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest rows of every query row (ids divisible by 100), against all rows."""
    e = table(spark, sf, "embeddings")
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    scored = None
    # a block of query rows is sent to every task
    blocks = max(1, -(-q.count() // BROADCAST_ROWS))
    for b in range(blocks):
        block = F.broadcast(q.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b))
        own = e.crossJoin(block).where("vec_id <> query_id").select("query_id", "vec_id", vectors.cosine(F.col("q"), F.col("embedding")).alias("c"))
        scored = own if scored is None else scored.unionByName(own)
    return relational.top_per_group(scored, ["query_id"], [F.desc("c"), F.col("vec_id")], 5).select("query_id", "rank", "vec_id", F.round("c", 6).alias("similarity"))


def same_person(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    found = e.select(F.col("vec_id").alias("image_id"), "embedding", F.lit(0).alias("x1"), F.lit(0).alias("y1"), F.lit(10).alias("x2"), F.lit(10).alias("y2"))
    pairs = e.select(F.col("vec_id").alias("pair_id"), F.col("vec_id").alias("before_image_id"), (F.col("vec_id") + 1).alias("after_image_id"))
    return faces.same_person(found, pairs).select("pair_id", F.round("similarity", 6).alias("similarity"), "same")


def l1_distance(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("after"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(vectors.l1(F.col("embedding"), F.col("after")), 6).alias("l1"))


def largest_image(spark: SparkSession, sf: str) -> DataFrame:
    im = table(spark, sf, "image").where("width is not null and height is not null").select("domain", "id", F.col("width").cast("long").alias("w"), F.col("height").cast("long").alias("h"))
    return im.groupBy("domain").agg(F.max_by("id", F.struct(F.col("w") * F.col("h"), -F.col("id"))).alias("id"))


def _landmarks(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), F.posexplode("embedding").alias("index", "v"))
    return e.where("v > 0").select("image_id", "index", F.col("v").cast("double").alias("x"), (1 - F.col("v").cast("double")).alias("y"))


def _presence(spark: SparkSession, sf: str) -> DataFrame:
    zones = spark.createDataFrame(ZONES, "zone_code string, ordinal int, landmark_indices array<int>")
    return faces.zone_presence(_landmarks(spark, sf), zones)


def zone_presence(spark: SparkSession, sf: str) -> DataFrame:
    return _presence(spark, sf).select("image_id", "zone_code", "confidence", "n_landmarks", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def dominant_zones(spark: SparkSession, sf: str) -> DataFrame:
    return faces.dominant_zones(_presence(spark, sf), 0.5, 2).select("image_id", "zone_code", "rank")


def zone_labels(spark: SparkSession, sf: str) -> DataFrame:
    return faces.zone_labels(_presence(spark, sf))


def pose_match(spark: SparkSession, sf: str) -> DataFrame:
    pose = lambda c: F.struct(*[(F.element_at(c, k + 1).cast("double") * 60).alias(n) for k, n in enumerate(("yaw", "pitch", "roll"))])
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("after"))
    both = e.join(nxt, "vec_id").select("vec_id", pose(F.col("embedding")).alias("b"), pose(F.col("after")).alias("a"))
    return both.select("vec_id", F.coalesce(F.substring_index(geometry.pose_reason(F.col("b"), F.col("a")), ":", 1), F.lit("accepted")).alias("outcome"))


def eye_alignment(spark: SparkSession, sf: str) -> DataFrame:
    at = lambda k: F.element_at("embedding", k).cast("double") * 100 + 100
    a = table(spark, sf, "embeddings").select("vec_id", geometry.alignment(at(1), at(2), at(3), at(4)).alias("a"))
    return a.select("vec_id", F.round("a.angle", 4).alias("angle"), F.round("a.scale", 4).alias("scale"), F.round(F.element_at("a.matrix", 3), 3).alias("shift_x"), F.col("a.reason").alias("reason"))


def rate_limit_schedule(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    out = frontier.schedule(e, ["user_id"], F.col("at"), ["event_id"], 1_800_000_000)
    return out.select("event_id", F.col("start").cast("long").alias("start"))


def resume_anti(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "quality_result").select(F.col("image_id").alias("id"))
    return relational.resume(table(spark, sf, "image").select("id", "file_path"), done, "id")


def split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.split(_pairs(spark, sf).select("id"), "id")


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.split(_labels(spark, sf).select("id", "treatment_category"), "id", by=["treatment_category"]).select("id", "split")


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "quality_result").dropDuplicates(["id"])
    v = lambda c: F.when((F.abs(c) != float("inf")) & ~F.isnan(c), F.col(c))
    return q.select("id", "grade", F.explode(F.create_map(*[x for c in ("blur_score", "lighting_uniformity", "mean_brightness") for x in (F.lit(c), v(c))])).alias("metric", "value"))


def metric_means(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.metric_means(_metrics(spark, sf), ["grade", "metric"]).select("grade", "metric", F.round("mean", 3).alias("mean"), "n")


def batch_mean_of_means_all(spark: SparkSession, sf: str) -> DataFrame:
    """Over every finite value, however large; null, NaN and infinite ones are in no mean."""
    m = _metrics(spark, sf).withColumn("batch", F.floor(F.col("id") / 64))
    return evaluation.mean_of_batch_means(m, "batch", ["metric"]).select("metric", F.round("mean", 4).alias("mean"))


def batch_mean_of_means(spark: SparkSession, sf: str) -> DataFrame:
    m = _metrics(spark, sf).where("value between 0 and 10000").withColumn("batch", F.floor(F.col("id") / 64))
    return evaluation.mean_of_batch_means(m, "batch", ["metric"]).select("metric", F.round("mean", 4).alias("mean"))


def one_per_host(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("lang", "doc_id", F.col("url").alias("href"))
    return frontier.one_per_host(d, ["lang"], ["doc_id"], ["clinic-", "journal"])


def links_same_host(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "staging_queue").select("id", F.col("source_url").alias("page_url"), F.col("before_url").alias("href"), F.col("source_name").alias("text"))
    return frontier.discover(q, r"gallery|before").select("id")


def absolute_links(spark: SparkSession, sf: str) -> DataFrame:
    forms = F.array(F.lit(""), F.lit("/gallery?x=1"), F.lit("//cdn.example/a.jpg"), F.lit("next.html"), F.lit("?page=2"), F.lit("#top"), F.lit("https://other.test/z"))
    q = table(spark, sf, "documents").select("doc_id", "url", F.element_at(forms, (F.col("doc_id") % 7 + 1).cast("int")).alias("href"))
    return q.select("doc_id", urls.absolute(F.col("href"), F.col("url")).alias("link"))


def reject_buckets(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "quality_result").dropDuplicates(["id"]).where("fail_reason is not null")
    return r.groupBy(F.substring_index("fail_reason", ":", 1).alias("reason"), texts.reason_bucket(F.concat(F.lit("quality_"), "fail_reason")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def quality_reasons(spark: SparkSession, sf: str) -> DataFrame:
    fine = " and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < 1e6" for c in ("blur_score", "lighting_uniformity", "mean_brightness"))
    return _reason_counts(table(spark, sf, "quality_result").dropDuplicates(["id"]).where(fine))


def quality_reasons_all(spark: SparkSession, sf: str) -> DataFrame:
    """Over every row; ``texts.quality_reason`` says how null, NaN and infinite measures are judged."""
    return _reason_counts(table(spark, sf, "quality_result").dropDuplicates(["id"]))


def _reason_counts(q: DataFrame) -> DataFrame:
    reason = texts.quality_reason(F.col("blur_score"), F.col("lighting_uniformity"), F.col("mean_brightness"), F.col("width"), F.col("height"), LIMITS)
    return q.groupBy(F.coalesce(F.substring_index(reason, ":", 1), F.lit("PASS")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def run_stats(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "quality_result").dropDuplicates(["id"])
    return relational.run_stats(q, F.col("fail_reason"), F.col("width") == 0).withColumn("pass_rate", F.round("pass_rate", 6))


def orphan_labels(spark: SparkSession, sf: str) -> DataFrame:
    quarantined = _quarantine(spark, sf)
    clean = _pairs(spark, sf).join(quarantined.withColumnRenamed("image_id", "before_image_id"), "before_image_id", "left_anti")
    return relational.orphans(_labels(spark, sf), "pair_id", clean, "id").select("id")


def quarantine_urls(spark: SparkSession, sf: str) -> DataFrame:
    return relational.explode_sides(table(spark, sf, "staging_queue").where("consent_tier >= 2"), PAIR, "url")


def new_images(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses of incoming rows that no image has; the ids given to them rise from the largest known one."""
    urls_ = relational.explode_sides(table(spark, sf, "staging_incoming"), PAIR, "source_url").withColumn("id", F.lit(0))
    return relational.upsert_new(table(spark, sf, "image").select("id", "source_url"), urls_, "source_url").select("source_url", (F.col("id") > 0).alias("has_id"))


def frontier_bfs(spark: SparkSession, sf: str) -> DataFrame:
    p = cut(_pairs(spark, sf).select(F.col("before_image_id").cast("string").alias("src"), F.col("after_image_id").cast("string").alias("dst"), "in_training_set"))
    edges = p.select("src", "dst").unionByName(p.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    return frontier.breadth_first(edges, p.where("in_training_set").select(F.col("src").alias("url")), 2)


def seed_urls(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "source_target").select(F.col("source_name").alias("name"), F.array(F.concat(F.lit("https://"), F.replace("source_name", F.lit("_"), F.lit("-")), F.lit(".example/reviews"))).alias("base_urls"))
    return files.seeds(s, 50)


def query_seeds(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "source_target").select(F.col("source_name").alias("name"), F.concat(F.lit("https://"), "source_name", F.lit(".example/s?q={query}")).alias("template"))
    return files.query_seeds(t, table(spark, sf, "canonical_term").where("kind = 'category'").select(F.col("name_pt").alias("term")))


def download_admission(spark: SparkSession, sf: str) -> DataFrame:
    im = table(spark, sf, "image").select(F.when(F.col("id") % 7 == 0, 503).when(F.col("id") % 11 == 0, 404).otherwise(200).alias("status"), F.when(F.col("id") % 13 == 0, "text/html").otherwise("image/jpeg; q=1").alias("kind"), F.coalesce("file_size_bytes", F.lit(0)).alias("size"))
    return im.groupBy(files.admitted(F.col("status"), F.col("kind"), F.col("size"), 20_000).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def pair_downloads(spark: SparkSession, sf: str) -> DataFrame:
    im = table(spark, sf, "image").select(F.col("id").alias("image_id"), F.col("file_path").alias("path"), F.coalesce(F.col("file_size_bytes") >= 20_000, F.lit(False)).alias("success"), (F.col("consent_tier") == 1).alias("from_cache"))
    sides = _pairs(spark, sf).select(F.col("id").alias("pair_id"), F.explode(F.array("before_image_id", "after_image_id")).alias("image_id"))
    return files.pair_downloads(sides.join(im, "image_id")).select("pair_id", "ok", F.size("drop").alias("n_drop"))


def manifest_json(spark: SparkSession, sf: str) -> DataFrame:
    t = training_set(spark, sf)
    return t.select("pair_id", manifest.as_json("pair_id", "before_path", "after_path", "treatment_category", "treatment_brand").alias("line"))


def instruction_prompts(spark: SparkSession, sf: str) -> DataFrame:
    names = F.element_at(F.array(*[F.lit(x) for x in ("botox", "lip_filler", "prp", "other", "kybella")]), (F.col("pair_id") % 5 + 1).cast("int"))
    return _labels(spark, sf).select("id", texts.prompt(names, F.col("treatment_brand")).alias("prompt"))


def treatment_zones(spark: SparkSession, sf: str) -> DataFrame:
    names = F.element_at(F.array(*[F.lit(x) for x in ("Botox", "lip_filler", "skin_booster", "other")]), (F.col("pair_id") % 4 + 1).cast("int"))
    return _labels(spark, sf).select(F.explode(texts.zones_for(names)).alias("zone_code")).groupBy("zone_code").agg(F.count(F.lit(1)).alias("n"))


def page_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Start tags of all documents by tag."""
    els = html.elements(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")
    return els.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_docs"))


def page_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs found on pages that are made of the staged rows of one page address."""
    one = F.concat(F.lit('<img src="'), "before_url", F.lit('" alt="before"><img src="'), "after_url", F.lit('" alt="result">'))
    q = table(spark, sf, "staging_queue").select(F.col("source_url").alias("page_id"), "id", one.alias("h"))
    pages = q.groupBy("page_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "h"))), lambda x: x["h"]), "").alias("html"))
    return html.candidate_pairs(pages).groupBy("strategy").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("n_pages"))


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (user, kind) of the event stream, first wins, by a stateful stream into the shared folder."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    out, mark = fresh_path(spark, "stream"), fresh_path(spark, "mark")
    s = log.deduplicated(log.landed(spark, f"{sf}/events.parquet*", schema), ["user_id", "event_type"]).select("user_id", "event_type")
    log.into_folder(s, out, "events", mark).awaitTermination()
    return spark.read.parquet(f"{out}/events").select("user_id", "event_type")


def stream_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Landed events through micro-batches that filter and project, into the shared folder."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    out, mark = fresh_path(spark, "stream"), fresh_path(spark, "mark")
    s = log.landed(spark, f"{sf}/events.parquet*", schema, files=4)
    work = lambda df: df.select("event_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    log.into_folder(s, out, "events", mark, work).awaitTermination()
    return spark.read.parquet(f"{out}/events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("sum_k"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        training_set, class_balance, category_counts, sampler_weights, queue_stats, queue_dedup_first, enqueue_counts, dequeue_batch, is_duplicate, latest_report, merge_queues,
        label_coverage, backfill, zip_pairs, adjacent_pairs, half_split_pairs, first_two, first_strategy, content_path, shard_counts, host_counts, url_label, text_label,
        language_detect, keyword_score, consistency_score, threshold_sweep, best_threshold, synthetic_negatives, validation_funnel, cosine_topk, same_person, l1_distance,
        largest_image, zone_presence, dominant_zones, zone_labels, pose_match, eye_alignment, rate_limit_schedule, resume_anti, split_sizes, stratified_split, metric_means,
        batch_mean_of_means, batch_mean_of_means_all, one_per_host, links_same_host, absolute_links, reject_buckets, quality_reasons, quality_reasons_all, run_stats, orphan_labels, quarantine_urls, new_images,
        frontier_bfs, seed_urls, query_seeds, download_admission, pair_downloads, manifest_json, instruction_prompts, treatment_zones, page_elements, page_pairs,
        stream_dedup, stream_batches,
    ]
    return {f.__name__: f for f in [*own, *stores.QUERIES, *pages.QUERIES, *pictures.QUERIES]}


def oracle_sql() -> dict[str, str]:
    return SQL | stores.SQL | pages.SQL | pictures.SQL
