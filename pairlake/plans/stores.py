"""Queries of the queue log, the write path, manifests, sinks and sources, with the SQL they are checked against.

Where the data have no such tables they are made of their ids, in the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlake.functions.urls import exact_label
from pairlake.operators import calibration, cascade, evaluation, frontier, pairing, queue, relational, store
from pairlake.plans.sql import BAD, COMMUNITY, HOST, JSON_CATEGORY, JSON_NAME, METRICS, PAIRS, RATES, SLUG_ROWS, TRAINING
from pairlake.runtime import cut, fresh_path, table
from pairlake.sources import files, manifest, stores

TAKEN = 20


# --- the queue as a log


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """The log that led to the queue's states: pending, then processing, then done or failed."""
    q = table(spark, sf, "staging_queue").select("id", "status", "failure_reason")
    began = queue.event(q, "pending", F.lit(0)).unionByName(queue.event(q.where("status <> 'pending'"), "processing", F.lit(1)))
    ended = q.where("status in ('done', 'failed')")
    said = F.when(F.col("status") == "failed", F.repeat(F.coalesce("failure_reason", F.lit("none")), 40))
    return began.unionByName(queue.event(ended, F.col("status"), F.lit(2), said))


def queue_states(spark: SparkSession, sf: str) -> DataFrame:
    return queue.current(_events(spark, sf)).select("id", "number", "status", "reason")


def _dequeued(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    _, marked = queue.dequeue(queue.current(events), TAKEN)
    return queue.current(events.unionByName(marked))


def dequeue_marks(spark: SparkSession, sf: str) -> DataFrame:
    """States after the oldest 20 pending rows were taken: the batch size is the feature."""
    return _dequeued(spark, sf).select("id", "status")


def reset_stale(spark: SparkSession, sf: str) -> DataFrame:
    """Rows given back after a worker stopped."""
    return queue.reset_stale(_dequeued(spark, sf)).select("id", "number", "status")


def unlabelled_rows(spark: SparkSession, sf: str) -> DataFrame:
    return queue.without_label(table(spark, sf, "staging_queue")).select("id")


def unlabelled_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The first ten unlabelled rows: a sample to look at is the feature."""
    return queue.without_label(table(spark, sf, "staging_queue"), 10).select("id", "source_name", "source_url")


def positive_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The first 200 done rows, from which thresholds are calibrated: the sample's size is the feature."""
    return table(spark, sf, "staging_queue").where("status = 'done'").orderBy("id").limit(200).select("id", "before_url", "after_url")


def run_by_source(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "staging_queue").select(F.col("source_name").alias("source"), (F.col("status") != "failed").cast("long").alias("inserted"), (F.col("id") % 3).alias("skipped"), F.col("failure_reason").alias("error"))
    return frontier.run_by_source(q)


def drained_queue(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses of staged rows, then those pushed meanwhile, without the pages of documents."""
    first = table(spark, sf, "staging_queue").select(F.col("source_url").alias("url"))
    pushed = table(spark, sf, "staging_incoming").select(F.col("source_url").alias("url"))
    return frontier.drained(first, pushed, table(spark, sf, "image").select(F.col("source_url").alias("url")))


# --- the write path


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    inc = table(spark, sf, "staging_incoming").distinct()
    known = table(spark, sf, "staging_queue").select("before_url", "after_url", F.lit(True).alias("known")).distinct()
    i = F.col("id")
    own = inc.join(known, ["before_url", "after_url"], "left").withColumns({
        "before_tier": F.col("consent_tier"), "after_tier": (i % 3 + 1).cast("int"), "downloaded": i % 10 != 0, "known": F.coalesce("known", F.lit(False)),
        "before_path": F.concat(F.lit("p/"), i.cast("string"), F.lit("_b.jpg")), "after_path": F.concat(F.lit("p/"), i.cast("string"), F.lit("_a.jpg")), "ordering_confidence": F.when(i % 3 == 0, "HIGH").when(i % 3 == 1, ""),
    })
    return own.withColumn("route", store.route(F.col("before_tier"), F.col("after_tier"), F.col("downloaded"), F.col("known")))


def write_routes(spark: SparkSession, sf: str) -> DataFrame:
    return _batch(spark, sf).select("id", "route")


def _known_images(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "image").select("id", "source_url")


def image_upserts(spark: SparkSession, sf: str) -> DataFrame:
    return store.image_rows(store.sides(_batch(spark, sf).where("route = 'write'")), _known_images(spark, sf))


def consent_records(spark: SparkSession, sf: str) -> DataFrame:
    return store.consent_rows(image_upserts(spark, sf))


def pair_rows(spark: SparkSession, sf: str) -> DataFrame:
    written = _batch(spark, sf).where("route = 'write'")
    images = _known_images(spark, sf).unionByName(store.image_rows(store.sides(written), _known_images(spark, sf)).select("id", "source_url"))
    return store.pair_rows(written, images)


def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    pics = store.sides(_batch(spark, sf).where("route = 'quarantine'")).withColumns({"tier": F.lit(3), "path": F.lit("")})
    known = _known_images(spark, sf)
    images = known.unionByName(store.image_rows(pics, known).select("id", "source_url"))
    return store.quarantine_rows(pics, images, table(spark, sf, "image").where("consent_tier = 3").select(F.col("id").alias("image_id")))


def cache_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Pictures to fetch and whether the inventory has them in full."""
    im = table(spark, sf, "image")
    have = im.where("id % 4 <> 0").select(F.col("file_path").alias("path"), F.when(F.col("id") % 9 == 0, 1000).otherwise(F.col("file_size_bytes")).alias("size"))
    return files.with_cache(im.select("id", F.col("file_path").alias("path")), have).select("id", "from_cache")


def download_totals(spark: SparkSession, sf: str) -> DataFrame:
    im = table(spark, sf, "image").select((F.col("id") % 7 != 0).alias("success"), (F.col("id") % 4 == 1).alias("from_cache"), F.col("file_size_bytes").alias("size"))
    return files.download_stats(im)


# --- manifests


def _zones(spark: SparkSession, sf: str) -> DataFrame:
    """Two zones for most pairs."""
    p = table(spark, sf, "image_pair").select(F.col("id").alias("pair_id")).distinct().where("pair_id % 4 <> 0")
    zone = lambda k: F.concat(F.lit("z"), (F.col("pair_id") % k).cast("string"))
    return p.select("pair_id", F.explode(F.array(zone(7), zone(3))).alias("zone_code"))


def training_zones(spark: SparkSession, sf: str) -> DataFrame:
    from pairlake.plans.catalogue import _labels, _pairs, _quarantine

    return relational.training_set(_pairs(spark, sf), table(spark, sf, "image"), _labels(spark, sf), _quarantine(spark, sf), _zones(spark, sf))


def manifest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest's six fields as JSON."""
    return training_zones(spark, sf).select("pair_id", manifest.as_json("pair_id", "before_path", "after_path", "treatment_category", "treatment_brand", "zone_codes").alias("line"))


def manifest_read(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest written to the shared folder and read again."""
    path = fresh_path(spark, "manifest")
    manifest.write(training_zones(spark, sf), path)
    return manifest.read(spark, path)


def strict_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels by metadata, community and whole path parts of addresses that have the staged treatment as a part."""
    name = F.replace(F.coalesce(relational.json_field("metadata", "treatment_name"), F.lit("")), F.lit(" "), F.lit("-"))
    forms = F.array(*[F.lit(x) for x in ("/", "/botox/", "/lip-filler?p=1", "/r/fillers", "/myfaceliftstory/", "/r/none/lip-filler")])
    made = F.concat("source_url", F.element_at(forms, (F.col("id") % 6 + 1).cast("int")), F.lit("/"), name)
    return table(spark, sf, "staging_queue").select("id", "metadata", made.alias("source_url")).select("id", cascade.strict_label().alias("label"), exact_label(F.col("source_url")).alias("from_address"))


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "staging_queue").select("id", "metadata", "source_url")
    side = lambda b, a: F.explode(F.filter(F.array(F.when(F.col("id") % b != 0, "before"), F.when(F.col("id") % a != 0, "after")), lambda x: x.isNotNull())).alias("side")
    return cascade.checked_pairs(q, q.select("id", side(7, 11)), q.select("id", side(5, 13)))


def face_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return cascade.enough(cut(_checked(spark, sf)))


def face_manifest_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cascade.manifest_counts(_checked(spark, sf))


def pair_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Six stages over all pairs; the measures of pictures are made of their ids."""
    i = F.col("id")
    fails = lambda k, reason: F.when(i % k == 0, reason)
    pose = F.struct(*[(i % k).cast("double").alias(n) for n, k in (("yaw", 40), ("pitch", 23), ("roll", 17))])
    pics = table(spark, sf, "image").where("id % 19 <> 0").select(i.alias("image_id"), (i % 29 != 0).alias("readable"), fails(6, "blur_too_low:1.0<80.0").alias("quality"), fails(7, "no_face_detected").alias("detection"), (i % 11 != 0).alias("landmarks"), fails(13, "eye_distance_too_small").alias("alignment"), pose.alias("pose"))
    zones = table(spark, sf, "image").where("id % 2 = 0").select(i.alias("image_id"), F.explode(F.array(F.lit("a"), F.concat(F.lit("z"), (i % 3).cast("string")))).alias("zone_code"))
    pairs = table(spark, sf, "image_pair").select(i.alias("pair_id"), "before_image_id", "after_image_id").distinct()
    return cascade.pair_cascade(pairs, pics, zones)


# --- sinks, stores and sources


def evaluation_report(spark: SparkSession, sf: str) -> DataFrame:
    """An evaluation report as JSON: numbers of values per measure, and per grade."""
    q = table(spark, sf, "quality_result").dropDuplicates(["id"])
    v = lambda c: F.when((F.abs(c) != float("inf")) & ~F.isnan(c), F.col(c))
    long = q.select("grade", F.explode(F.create_map(*[x for c in ("blur_score", "lighting_uniformity", "mean_brightness") for x in (F.lit(c), v(c))])).alias("metric", "value"))
    n = evaluation.metric_means(long, ["metric"]).select("metric", F.col("n").alias("value"), "n")
    by = evaluation.metric_means(long.withColumnRenamed("grade", "treatment"), ["treatment", "metric"]).select("treatment", "metric", F.col("n").alias("value"))
    return manifest.report(n, by, "all")


def threshold_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Calibrated thresholds written as a second version; the last version is read."""
    from pairlake.plans.catalogue import _samples

    path = fresh_path(spark, "thresholds")
    swept = cut(calibration.sweep(_samples(spark, sf)))
    manifest.write_thresholds(calibration.best_threshold(swept, 0.9, 0.8), path, 1)
    for _ in range(2):
        manifest.write_thresholds(calibration.best_threshold(swept, 0.3, 0.5), path, 2)
    return manifest.thresholds(spark, path)


def store_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written to a store batch by batch, one batch twice, and read again."""
    folder, orders = fresh_path(spark, "store"), table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    for b in (0, 1, 1, 2):
        stores.write_once(orders.where(F.col("o_orderkey") % 3 == b), folder, "orders.parquet", b)
    stores.write(table(spark, sf, "nation").select("n_nationkey"), folder, "keys")
    out = stores.read(spark, folder, "orders").drop("batch")
    return out.join(stores.read(spark, folder, "keys"), F.col("o_custkey") % 25 == F.col("n_nationkey")).drop("n_nationkey")


def configured_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Sources of a configuration made of source_target, in the order of a registry that lacks one and has one too many."""
    names = sorted(r["source_name"] for r in table(spark, sf, "source_target").select("source_name").collect())
    raw = {n: {"enabled": k % 4 != 3, "rendering": ("static", "dynamic", "odd")[k % 3], "consent_tier": k % 5, "rate_limit": float(k) or None, "base_urls": [f"https://{n}.example"], "calibration_source": k == 5, "note": k} for k, n in enumerate(names)}
    df = spark.createDataFrame(files.source_rows({"sources": raw}), files.SOURCE)
    chosen = files.registered(df, [*reversed(names[1:]), "unknown"])
    return chosen.select("place", "name", "rendering", "consent_tier", "rate_limit", F.element_at("base_urls", 1).alias("first_url"), F.element_at("extra", F.lit("note")).alias("note"), (F.col("name") == files.calibration_source(df)).alias("calibrates"))


def local_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of the three layouts of local folders; the files' names are made of image ids."""
    i = F.col("id").cast("string")
    def made(layout: str, *names: tuple) -> DataFrame:
        f = table(spark, sf, "image").select(F.explode(F.filter(F.array(*[F.when(ok, F.struct(F.lit(folder).alias("folder"), stem.alias("stem"))) for folder, stem, ok in names]), lambda x: x.isNotNull())).alias("x")).select("x.*")
        return f.withColumn("path", F.concat_ws("/", F.lit(layout), "folder", F.concat("stem", F.lit(".jpg"))))

    yes, third, fifth = F.lit(True), F.col("id") % 3 != 0, F.col("id") % 5 != 0
    split = made("split", ("Before", F.concat(F.lit("K"), i), yes), ("after", F.concat(F.lit("k"), i), third))
    numbered = made("numbered", ("set", F.concat(i, F.lit("_before")), yes), ("set", F.concat(i, F.lit("-After")), fifth))
    renamed = made("renamed", ("set", F.concat(F.lit("FaceBefore"), i), third), ("set", F.concat(F.lit("faceafter"), i), fifth))
    out = None
    for f in (split, numbered, renamed):
        own = files.local_pairs(f).select("strategy", "key", "before", "after")
        out = own if out is None else out.unionByName(own)
    return out


def union_of_strategies(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of two strategies, each once, as it came first."""
    old = table(spark, sf, "staging_queue").select(F.col("before_url").alias("before"), F.col("after_url").alias("after"), F.lit(1).alias("strategy"), "id")
    new = table(spark, sf, "staging_incoming").select(F.col("before_url").alias("before"), F.col("after_url").alias("after"), F.lit(0).alias("strategy"), "id")
    return pairing.distinct_pairs(old.unionByName(new), ["strategy", "id"]).select("id", "strategy")


QUERIES = [
    queue_states, dequeue_marks, reset_stale, unlabelled_rows, unlabelled_sample, positive_sample, run_by_source, drained_queue, write_routes, image_upserts, consent_records, pair_rows,
    quarantine_rows, cache_hits, download_totals, training_zones, manifest_lines, manifest_read, strict_labels, face_manifest, face_manifest_counts, pair_cascade, evaluation_report,
    threshold_versions, store_batches, configured_sources, local_layouts, union_of_strategies,
]

STATUS = f"CASE WHEN id IN (SELECT id FROM staging_queue WHERE status = 'pending' ORDER BY id LIMIT {TAKEN}) THEN 'processing' ELSE status END"
BATCH = f"""b AS (SELECT i.*, i.id % 3 + 1 AS after_tier, k.before_url IS NOT NULL AS known, CASE WHEN i.id % 3 = 0 THEN 'HIGH' ELSE 'UNKNOWN' END AS oc
      FROM (SELECT DISTINCT * FROM staging_incoming) i LEFT JOIN (SELECT DISTINCT before_url, after_url FROM staging_queue) k USING (before_url, after_url)),
    r AS (SELECT *, CASE WHEN consent_tier = 3 OR after_tier = 3 THEN 'quarantine' WHEN id % 10 = 0 THEN 'download_failed' WHEN known THEN 'duplicate' ELSE 'write' END AS route FROM b)"""


def _images(route: str) -> str:
    """New images of a route: (id, source_url, file_path, domain, language, consent_tier), and the first pair of every picture."""
    return f"""{BATCH}, s AS (SELECT before_url AS source_url, id, 0 AS side, consent_tier AS tier, 'p/' || id || '_b.jpg' AS path, language, source_url AS page FROM r WHERE route = '{route}'
        UNION ALL SELECT after_url, id, 1, after_tier, 'p/' || id || '_a.jpg', language, source_url FROM r WHERE route = '{route}'),
    f AS (SELECT * FROM s WHERE source_url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY id, side) = 1),
    n AS (SELECT (SELECT max(id) FROM image) + row_number() OVER (ORDER BY md5(source_url || ':42'), source_url) AS id, source_url, path AS file_path, {HOST.format("page")} AS domain, language, tier AS consent_tier
          FROM f WHERE NOT EXISTS (SELECT 1 FROM image i WHERE i.source_url = f.source_url)),
    every AS (SELECT id, source_url FROM image UNION ALL SELECT id, source_url FROM n)"""


ZONED = f"SELECT t.*, CASE WHEN pair_id % 4 <> 0 THEN list_sort(list_distinct(['z' || pair_id % 7, 'z' || pair_id % 3])) ELSE CAST([] AS VARCHAR[]) END AS zone_codes FROM ({TRAINING}) t"
EXACT = f"""u AS (SELECT id, metadata, lower(source_url || CASE id % 6 WHEN 0 THEN '/' WHEN 1 THEN '/botox/' WHEN 2 THEN '/lip-filler?p=1' WHEN 3 THEN '/r/fillers' WHEN 4 THEN '/myfaceliftstory/' ELSE '/r/none/lip-filler' END || '/' || replace({JSON_NAME}, ' ', '-')) u FROM staging_queue),
    s(slug, cat, o) AS (VALUES {SLUG_ROWS}), t AS (SELECT id, unnest(string_split(rtrim(u, '/'), '/')) x, generate_subscripts(string_split(rtrim(u, '/'), '/'), 1) i FROM u),
    e AS (SELECT id, min_by(cat, i) c FROM t JOIN s ON s.slug = split_part(t.x, '?', 1) GROUP BY id), a AS (SELECT u.id, metadata, coalesce({COMMUNITY}, e.c) x FROM u LEFT JOIN e USING (id))"""
OUTCOME = "CASE WHEN id % 7 = 0 OR id % 11 = 0 THEN 'missing_image' WHEN id % 5 = 0 OR id % 13 = 0 THEN 'no_face' ELSE 'kept' END"
FOUND = f"""u AS (SELECT id, metadata, lower(source_url) u FROM staging_queue), s(slug, cat, o) AS (VALUES {SLUG_ROWS}),
    t AS (SELECT id, unnest(string_split(rtrim(u, '/'), '/')) x, generate_subscripts(string_split(rtrim(u, '/'), '/'), 1) i FROM u),
    e AS (SELECT id, min_by(cat, i) c FROM t JOIN s ON s.slug = split_part(t.x, '?', 1) GROUP BY id), k AS (SELECT u.id, coalesce({JSON_CATEGORY}, {COMMUNITY}, e.c) label, {OUTCOME.replace("id", "u.id")} outcome FROM u LEFT JOIN e USING (id))"""
GAP = "abs(b.id % {k} - a.id % {k})"
STAGES = [f"WHEN b.id IS NULL OR a.id IS NULL OR b.id % 29 = 0 OR a.id % 29 = 0 THEN 'quality:unreadable_image'"]
STAGES += [f"WHEN {s}.id % {k} = 0 THEN '{text.format(n)}'" for k, text in ((6, "quality:{}:blur_too_low:1.0<80.0"), (7, "detection:{}:no_face_detected"), (11, "landmark:{}:no_face_mesh"), (13, "alignment:{}:eye_distance_too_small")) for s, n in (("b", "before"), ("a", "after"))]
STAGES += [f"WHEN {GAP.format(k=k)} > {m} THEN 'pose:{n}_mismatch:' || printf('%.1f', {GAP.format(k=k)}::DOUBLE) || '>{m}.0'" for n, k, m in (("yaw", 40, 15), ("pitch", 23, 15), ("roll", 17, 10))]

SQL = {
    "queue_states": "SELECT id, CASE status WHEN 'pending' THEN 0 WHEN 'processing' THEN 1 ELSE 2 END AS number, status, CASE WHEN status = 'failed' THEN substr(repeat(coalesce(failure_reason, 'none'), 40), 1, 512) END AS reason FROM staging_queue",
    "dequeue_marks": f"SELECT id, {STATUS} AS status FROM staging_queue",
    "reset_stale": f"SELECT id, 2 AS number, 'pending' AS status FROM staging_queue WHERE ({STATUS}) = 'processing' AND status = 'processing' UNION ALL SELECT id, 2, 'pending' FROM staging_queue WHERE ({STATUS}) = 'processing' AND status = 'pending'",
    "unlabelled_rows": "SELECT id FROM staging_queue WHERE metadata IS NULL OR NOT contains(metadata, 'treatment_category')",
    "unlabelled_sample": "SELECT id, source_name, source_url FROM staging_queue WHERE metadata IS NULL OR NOT contains(metadata, 'treatment_category') ORDER BY id LIMIT 10",
    "positive_sample": "SELECT id, before_url, after_url FROM staging_queue WHERE status = 'done' ORDER BY id LIMIT 200",
    "run_by_source": """SELECT source_name AS source, sum(CASE WHEN failure_reason IS NULL THEN (status <> 'failed')::BIGINT ELSE 0 END)::BIGINT AS n_inserted, sum(CASE WHEN failure_reason IS NULL THEN id % 3 ELSE 0 END)::BIGINT AS n_skipped,
        count(failure_reason) AS n_errors, bool_and(failure_reason IS NOT NULL) AS failed FROM staging_queue GROUP BY 1""",
    "drained_queue": """SELECT url, min(turn) AS turn FROM (SELECT source_url AS url, 0 AS turn FROM staging_queue UNION ALL SELECT source_url, 1 FROM staging_incoming) WHERE coalesce(url, '') <> ''
        AND url NOT IN (SELECT source_url FROM image WHERE source_url IS NOT NULL) GROUP BY 1""",
    "write_routes": f"WITH {BATCH} SELECT id, route FROM r",
    "image_upserts": f"WITH {_images('write')} SELECT * FROM n",
    "consent_records": f"WITH {_images('write')} SELECT id AS image_id, consent_tier FROM n",
    "pair_rows": f"""WITH {_images('write')}, j AS (SELECT *, CASE WHEN json_valid(metadata) THEN metadata END m FROM r WHERE route = 'write')
        SELECT j.id AS queue_id, b.id AS before_image_id, a.id AS after_image_id, oc AS ordering_confidence, nullif(json_extract_string(m, '$.provider_name'), '') AS practitioner_name,
        nullif(json_extract_string(m, '$.clinic_name'), '') AS clinic_name, nullif(json_extract_string(m, '$.date_posted'), '') AS date_posted, language, source_name
        FROM j JOIN every b ON b.source_url = j.before_url JOIN every a ON a.source_url = j.after_url""",
    "quarantine_rows": f"WITH {_images('quarantine')} SELECT e.id AS image_id, 'consent_tier3' AS reason, f.page AS source_url FROM f JOIN every e ON e.source_url = f.source_url WHERE e.id NOT IN ({BAD})",
    "cache_hits": "SELECT id, coalesce(id % 4 <> 0 AND CASE WHEN id % 9 = 0 THEN 1000 ELSE file_size_bytes END >= 1024, false) AS from_cache FROM image",
    "download_totals": """SELECT count(*) AS n_total, count(*) FILTER (id % 7 <> 0) AS n_ok, count(*) FILTER (id % 7 <> 0 AND id % 4 = 1) AS n_cached, count(*) FILTER (id % 7 = 0) AS n_failed,
        coalesce(sum(file_size_bytes) FILTER (id % 7 <> 0), 0)::BIGINT AS n_bytes FROM image""",
    "training_zones": ZONED,
    "manifest_read": ZONED,
    "manifest_lines": f"SELECT pair_id, to_json({{'pair_id': pair_id, 'before_path': before_path, 'after_path': after_path, 'treatment_category': treatment_category, 'treatment_brand': treatment_brand, 'zone_codes': zone_codes}})::VARCHAR AS line FROM ({ZONED})",
    "strict_labels": f"WITH {EXACT} SELECT id, coalesce({JSON_CATEGORY}, x) AS label, x AS from_address FROM a",
    "face_manifest": f"WITH {FOUND} SELECT id AS pair_id, id || '_before.jpg' AS before_path, id || '_after.jpg' AS after_path, label AS treatment_category, CAST(NULL AS VARCHAR) AS treatment_brand, CAST([] AS VARCHAR[]) AS zone_codes FROM k WHERE outcome = 'kept'",
    "face_manifest_counts": f"""WITH {FOUND} SELECT count(*) AS n_checked, count(*) FILTER (outcome = 'missing_image') AS n_missing_image, count(*) FILTER (outcome = 'no_face') AS n_no_face, count(*) FILTER (outcome = 'kept') AS n_kept,
        count(*) FILTER (outcome = 'kept' AND label IS NOT NULL) AS n_labelled, 100 * count(*) FILTER (outcome = 'kept' AND label IS NOT NULL) // greatest(count(*) FILTER (outcome = 'kept'), 1) AS percent, count(*) FILTER (outcome = 'kept') >= 200 AS enough FROM k""",
    "pair_cascade": f"""WITH i AS (SELECT id FROM image WHERE id % 19 <> 0), o AS (SELECT p.id AS pair_id, before_image_id x, CASE {" ".join(STAGES)} END AS reject_reason
        FROM (SELECT DISTINCT id, before_image_id, after_image_id FROM image_pair) p LEFT JOIN i b ON b.id = before_image_id LEFT JOIN i a ON a.id = after_image_id)
        SELECT pair_id, reject_reason IS NULL AS passed, reject_reason, CASE WHEN reject_reason IS NULL AND x % 2 = 0 THEN ['a', 'z' || x % 3] ELSE CAST([] AS VARCHAR[]) END AS zone_codes FROM o""",
    "evaluation_report": f"""WITH m AS (SELECT metric, count(v) n FROM ({METRICS}) GROUP BY 1), t AS (SELECT coalesce(grade, 'unknown') g, metric, count(v) n FROM ({METRICS}) GROUP BY 1, 2),
        j AS (SELECT g, string_agg('"' || metric || '":' || n, ',' ORDER BY metric) x FROM t GROUP BY 1)
        SELECT '{{"model_tag":"all","num_samples":' || (SELECT max(n) FROM m) || ',"metrics":{{' || (SELECT string_agg('"' || metric || '":' || n, ',' ORDER BY metric) FROM m) || '}},"per_treatment":{{' || (SELECT string_agg('"' || g || '":{{' || x || '}}', ',' ORDER BY g) FROM j) || '}}}}' AS report""",
    "threshold_versions": f"SELECT layer, coalesce(max(threshold) FILTER (prec >= 0.3 AND rec >= 0.5), min(threshold)) AS threshold, 2 AS version FROM ({RATES}) GROUP BY 1",
    "store_batches": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey % 25 IN (SELECT n_nationkey FROM nation)",
    "configured_sources": """WITH n AS (SELECT source_name AS name, row_number() OVER (ORDER BY source_name) - 1 AS k, count(*) OVER () c FROM source_target)
        SELECT (c - 1 - k)::INT AS place, name, CASE k % 3 WHEN 1 THEN 'dynamic' ELSE 'static' END AS rendering, CASE WHEN k % 5 IN (1, 2, 3) THEN k % 5 ELSE 3 END::INT AS consent_tier, CASE WHEN k = 0 THEN 3.0 ELSE k END::DOUBLE AS rate_limit,
        'https://' || name || '.example' AS first_url, k::VARCHAR AS note, k = 5 AS calibrates FROM n WHERE k % 4 <> 3 AND k > 0""",
    "local_layouts": """SELECT 0 AS strategy, 'k' || id AS key, 'split/Before/K' || id || '.jpg' AS "before", 'split/after/k' || id || '.jpg' AS "after" FROM image WHERE id % 3 <> 0
        UNION ALL SELECT 1, id::VARCHAR, 'numbered/set/' || id || '_before.jpg', 'numbered/set/' || id || '-After.jpg' FROM image WHERE id % 5 <> 0
        UNION ALL SELECT 2, 'facebefore' || id, 'renamed/set/FaceBefore' || id || '.jpg', 'renamed/set/faceafter' || id || '.jpg' FROM image WHERE id % 3 <> 0 AND id % 5 <> 0""",
    "union_of_strategies": """SELECT id, strategy FROM (SELECT before_url b, after_url a, 1 AS strategy, id FROM staging_queue UNION ALL SELECT before_url, after_url, 0, id FROM staging_incoming)
        QUALIFY row_number() OVER (PARTITION BY b, a ORDER BY strategy, id) = 1""",
}
