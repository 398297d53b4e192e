"""SQL that the core queries are checked against (DuckDB), written apart from the operators."""

from __future__ import annotations

from pairlake.functions.vocabulary import AFTER_TEXT, BEFORE_TEXT, COMMUNITIES, DEFAULT_PROMPT, PRIORITY, PROMPTS, SLUGS, TEXT_RULES, ZONES_OF


def q(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


PAIRS = "SELECT DISTINCT ON (id) * FROM image_pair"
LABELS = "SELECT DISTINCT ON (id) * FROM treatment_label"
SCORED = "SELECT DISTINCT ON (id) * FROM quality_result"
BAD = "SELECT id FROM image WHERE consent_tier = 3"
STAGED = """SELECT id, before_url, after_url, source_url, source_name, language, consent_tier, 0 AS batch_no FROM staging_queue
            UNION ALL SELECT id, before_url, after_url, source_url, source_name, language, consent_tier, batch_no FROM staging_incoming"""
TRAINING = f"""SELECT p.id AS pair_id, b.file_path AS before_path, a.file_path AS after_path, l.treatment_category, l.treatment_brand
    FROM ({PAIRS}) p JOIN image b ON b.id = p.before_image_id JOIN image a ON a.id = p.after_image_id LEFT JOIN ({LABELS}) l ON l.pair_id = p.id
    WHERE p.ordering_confidence <> 'LOW' AND p.before_image_id NOT IN ({BAD}) AND p.after_image_id NOT IN ({BAD})"""
ITEMS = "SELECT source_url page, id, 'before' AS role, before_url url FROM staging_queue UNION ALL SELECT source_url, id, 'after', after_url FROM staging_queue"
JSON_CATEGORY = "nullif(CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.treatment_category') END, '')"
JSON_NAME = "coalesce(nullif(CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.treatment_name') END, ''), '')"
HOST = "lower(regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
PATH = "lower(regexp_extract({}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1))"
SLUG_ROWS = ", ".join(f"({q(s)}, {q(c)}, {k})" for k, (s, c) in enumerate(SLUGS.items()))
COMMUNITY = "CASE regexp_extract(lower(u), '/r/([^/?#]+)', 1) " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in COMMUNITIES.items()) + " END"


def labelled(rows: str) -> str:
    """(id, label) of rows (id, u) by the four rules for page addresses."""
    return f"""
    u AS ({rows}), s(slug, cat, o) AS (VALUES {SLUG_ROWS}), p AS (SELECT id, u, {PATH.format("u")} path FROM u),
    seg AS (SELECT id, min_by(cat, i) c FROM (SELECT id, unnest(string_split(trim(path, '/'), '/')) x, generate_subscripts(string_split(trim(path, '/'), '/'), 1) i FROM p) t JOIN s ON s.slug = t.x GROUP BY id),
    inn AS (SELECT id, cat, o, slug, regexp_matches(path, '(?:^|[/_-])' || slug || '(?:[/_-]|$)') bounded FROM p, s WHERE contains(path, slug)),
    best AS (SELECT id, min_by(cat, (-length(slug), o)) FILTER (bounded) b, min_by(cat, (-length(slug), o)) c FROM inn GROUP BY id),
    lab AS (SELECT p.id, coalesce({COMMUNITY}, seg.c, best.b, best.c) label FROM p LEFT JOIN seg USING (id) LEFT JOIN best USING (id))"""


RULES = ", ".join(f"({k}, {q(p)}, {q(c)}, {q(b)}, {PRIORITY.get(c, 0)})" for k, (p, c, b) in enumerate(TEXT_RULES))


def any_word(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({text}, '')), {q(w)})" for w in words) + ")"


GRID = "(SELECT round(unnest(range(1, 20)) * 0.05::DOUBLE, 4) threshold)"
SAMPLES = " UNION ALL ".join(f"SELECT '{k}' AS layer, CASE WHEN NOT isnan({k}_score) THEN {k}_score END score, ordering_confidence = 'HIGH' pos FROM ({PAIRS}) WHERE ordering_confidence IS NOT NULL" for k in ("layer1", "layer2", "layer3"))
SWEEP = f"""SELECT layer, threshold, count(*) FILTER (pos AND coalesce(score, 0) >= threshold) tp, count(*) FILTER (NOT pos AND coalesce(score, 0) >= threshold) fp,
    count(*) FILTER (pos AND coalesce(score, 0) < threshold) fn FROM ({SAMPLES}), {GRID} GROUP BY ALL"""
RATES = f"SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1.0 END prec, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END rec FROM ({SWEEP})"
COS = "list_sum(list_transform(list_zip({a}, {b}), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)) / (sqrt(list_sum(list_transform({a}, lambda x: x::DOUBLE * x::DOUBLE))) * sqrt(list_sum(list_transform({b}, lambda x: x::DOUBLE * x::DOUBLE))))"
NEXT = "SELECT e.vec_id, e.embedding x, n.embedding y FROM embeddings e JOIN embeddings n ON n.vec_id = e.vec_id + 1"
ZONE_ROWS = "SELECT * FROM (VALUES ('left', 0, [0,1,2,3,4]), ('middle', 1, [20,21,22,23,24,25,26]), ('right', 2, [60,61,62,63]), ('mixed', 3, [0,21,42,63])) z(zone_code, o, own)"
PRESENCE = f"""SELECT l.image_id, z.zone_code, z.o, round(count(*) / z.total, 4) confidence, count(*) n_landmarks, avg(v) x, avg(1 - v) y
    FROM (SELECT vec_id image_id, unnest(range(0, len(embedding))) i, unnest(embedding)::DOUBLE v FROM embeddings) l
    JOIN (SELECT zone_code, o, len(own) total, unnest(own) i FROM ({ZONE_ROWS})) z ON z.i = l.i WHERE v > 0 GROUP BY l.image_id, z.zone_code, z.o, z.total"""
METRICS = " UNION ALL ".join(f"SELECT id, grade, '{c}' AS metric, CASE WHEN isfinite({c}) THEN {c} END v FROM ({SCORED})" for c in ("blur_score", "lighting_uniformity", "mean_brightness"))
MD5 = "md5(id::VARCHAR || ':42')"
RANKED = "SELECT *, row_number() OVER ({by} ORDER BY " + MD5 + ", id) r, count(*) OVER ({by}) n FROM ({rows})"
SPLIT = "CASE WHEN r <= floor(n * 0.8::DOUBLE) THEN 'train' WHEN r <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'validation' ELSE 'test' END"
FINE = " AND ".join(f"isfinite({c}) AND abs({c}) < 1e6" for c in ("blur_score", "lighting_uniformity", "mean_brightness"))
PROMPT_CASE = "CASE k " + " ".join(f"WHEN {q(c)} THEN {q(PROMPTS[c])}" for c in ("botox", "lip_filler", "prp", "kybella")) + f" ELSE {q(DEFAULT_PROMPT)} END"
FIRST_LOG = """SELECT *, row_number() OVER (PARTITION BY before_url, after_url ORDER BY part, id) rn FROM (
    SELECT id, before_url, after_url, source_name, language, consent_tier, 0 AS part FROM staging_queue WHERE status = 'done'
    UNION ALL SELECT id, before_url, after_url, source_name, language, consent_tier, 1 FROM staging_incoming
    UNION ALL SELECT id, before_url, after_url, source_name, language, consent_tier, 2 FROM staging_queue WHERE status = 'pending')"""

SQL = {
    "training_set": TRAINING,
    "class_balance": f"SELECT treatment_category, count(*) n, round(sum(count(*)) OVER () / count(*), 4) weight FROM ({LABELS}) WHERE coalesce(treatment_category, '') <> '' GROUP BY 1",
    "category_counts": f"SELECT treatment_category, count(*) n FROM ({LABELS}) GROUP BY 1",
    "sampler_weights": f"SELECT id, round(1.0 / count(*) OVER (PARTITION BY treatment_category), 9) weight FROM ({LABELS})",
    "queue_stats": "SELECT status, count(*) n FROM staging_queue GROUP BY 1",
    "queue_dedup_first": f"SELECT id, before_url, after_url, source_name, batch_no FROM ({STAGED}) QUALIFY row_number() OVER (PARTITION BY before_url, after_url ORDER BY id) = 1",
    "enqueue_counts": f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY before_url, after_url ORDER BY id) rn FROM ({STAGED}))
        SELECT batch_no, count(*) FILTER (rn = 1) n_inserted, count(*) FILTER (rn > 1) n_skipped FROM r WHERE batch_no > 0 GROUP BY 1""",
    "dequeue_batch": "SELECT id, before_url, after_url FROM staging_queue WHERE status = 'pending' ORDER BY id LIMIT 20",
    "is_duplicate": "SELECT id FROM staging_incoming i WHERE EXISTS (SELECT 1 FROM staging_queue s WHERE s.before_url = i.before_url AND s.after_url = i.after_url)",
    "latest_report": "SELECT report_id, treatment_category, pair_count, weight FROM balance_report QUALIFY row_number() OVER (PARTITION BY report_id, treatment_category ORDER BY reported_at DESC, pair_count DESC) = 1",
    "merge_queues": f"SELECT id, coalesce(source_name, 'merged') AS source_name, coalesce(language, 'en') AS language, coalesce(consent_tier, 2) AS consent_tier, part FROM ({FIRST_LOG}) WHERE rn = 1",
    "label_coverage": """SELECT status, count(*) n, count(*) FILTER (metadata LIKE '%treatment\\_category%' ESCAPE '\\') n_labelled,
        floor(100 * count(*) FILTER (metadata LIKE '%treatment\\_category%' ESCAPE '\\') / count(*))::BIGINT AS percent FROM staging_queue GROUP BY 1""",
    "backfill": f"""WITH {labelled("SELECT id, source_url u FROM staging_queue")}
        SELECT id, coalesce({JSON_CATEGORY}, label) AS label, CASE WHEN {JSON_CATEGORY} IS NOT NULL THEN 'kept' WHEN label IS NOT NULL THEN 'derived' ELSE 'no_match' END outcome FROM staging_queue JOIN lab USING (id)""",
    "zip_pairs": f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY page, role ORDER BY id) n FROM ({ITEMS}))
        SELECT b.page, b.n, b.url AS "before", a.url AS "after" FROM r b JOIN r a ON a.page = b.page AND a.n = b.n WHERE b.role = 'before' AND a.role = 'after'""",
    "adjacent_pairs": f"""WITH r AS (SELECT page, url, row_number() OVER (PARTITION BY page ORDER BY id) k FROM ({ITEMS}) WHERE role = 'before')
        SELECT x.page, ((x.k + 1) // 2)::INT n, x.url AS "before", y.url AS "after" FROM r x JOIN r y ON y.page = x.page AND y.k = x.k + 1 WHERE x.k % 2 = 1""",
    "half_split_pairs": f"""WITH r AS (SELECT page, url, row_number() OVER (PARTITION BY page ORDER BY id) k, count(*) OVER (PARTITION BY page) // 2 h FROM ({ITEMS}) WHERE role = 'after')
        SELECT x.page, x.k AS n, x.url AS "before", y.url AS "after" FROM r x JOIN r y ON y.page = x.page AND y.k = x.k + x.h WHERE x.k <= x.h""",
    "first_two": f"""WITH r AS (SELECT page, url, row_number() OVER (PARTITION BY page ORDER BY id) k FROM ({ITEMS}) WHERE role = 'after')
        SELECT x.page, x.url AS "before", y.url AS "after" FROM r x JOIN r y ON y.page = x.page WHERE x.k = 1 AND y.k = 2""",
    "first_strategy": """WITH s AS (SELECT id, source_url page, CASE WHEN consent_tier = 1 THEN 1 ELSE 2 END strategy FROM staging_queue)
        SELECT id, page, strategy FROM s QUALIFY strategy = min(strategy) OVER (PARTITION BY page)""",
    "content_path": f"""WITH e AS (SELECT id, md5(source_url) h, regexp_extract({PATH.format("source_url")}, '(\\.[^./]+)$', 1) x FROM image)
        SELECT id, 'images/raw/gallery/' || h[1:2] || '/' || h || CASE WHEN x IN ('.jpg', '.jpeg', '.png', '.webp', '.gif') THEN x ELSE '.jpg' END AS path FROM e""",
    "shard_counts": f"SELECT lpad((id % 100)::VARCHAR, 2, '0') shard, count(*) n FROM ({PAIRS}) GROUP BY 1",
    "host_counts": f"SELECT {HOST.format('source_url')} host, count(*) n FROM image GROUP BY 1",
    "url_label": f"""WITH {labelled("SELECT id, source_url || CASE id % 5 WHEN 0 THEN '' WHEN 1 THEN '/botox' WHEN 2 THEN '/lip-filler-results-3' WHEN 3 THEN '/r/fillers' ELSE '/myfaceliftstory' END || '/' || replace(" + JSON_NAME + ", ' ', '-') u FROM staging_queue")}
        SELECT id, label FROM lab""",
    "text_label": f"""WITH r(k, p, c, b, w) AS (VALUES {RULES}), m AS (SELECT doc_id, k, c, b, w FROM documents, r WHERE regexp_matches(text, p, 'i')),
        n AS (SELECT doc_id, count(*) n, arg_max({{'c': c, 'b': b, 'w': w}}, (w, b IS NOT NULL, -k)) best FROM m GROUP BY 1),
        carry AS (SELECT m.doc_id, arg_min(m.b, m.k) b FROM m JOIN n USING (doc_id) WHERE m.b IS NOT NULL AND m.w <= n.best.w GROUP BY 1)
        SELECT d.doc_id, n.best.c AS category, coalesce(n.best.b, carry.b) AS brand, CASE WHEN n.n IS NULL THEN 0 ELSE round(least(1.0, 0.4 + n.n * 0.3), 3) END::DOUBLE AS confidence, coalesce(n.n, 0) AS n
        FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN carry USING (doc_id)""",
    "language_detect": "SELECT doc_id, CASE WHEN regexp_matches(text, '[가-힣ᄀ-ᇿ]') THEN 'ko' WHEN regexp_matches(text, '[ãõáéíóúâêîôûçÃÕÁÉÍÓÚÂÊÎÔÛÇ]') THEN 'pt' ELSE 'en' END AS language FROM documents",
    "keyword_score": f"""WITH m AS (SELECT doc_id, trim(coalesce(text, '')) = '' e, {any_word("text", BEFORE_TEXT)} b, {any_word("text", AFTER_TEXT)} a FROM documents)
        SELECT doc_id, CASE WHEN e THEN 0.0 WHEN a AND b THEN 0.9 ELSE round(0.3 * (b::INT + a::INT), 4) END::DOUBLE AS score, CASE WHEN e THEN 'none' WHEN a AND b THEN 'keyword' ELSE 'partial' END AS method FROM m""",
    "consistency_score": f"""WITH t AS (SELECT arg_min(embedding, vec_id) tb, arg_max(embedding, vec_id) ta FROM embeddings),
        c AS (SELECT vec_id, {COS.format(a="x", b="tb")} bb, {COS.format(a="y", b="ta")} aa, {COS.format(a="x", b="ta")} ba, {COS.format(a="y", b="tb")} ab FROM ({NEXT}), t)
        SELECT vec_id, round(greatest(0.0, (bb + aa) / 2 - 0.2 * ((ba > bb)::INT + (ab > aa)::INT)), 4) AS score FROM c""",
    "threshold_sweep": f"SELECT layer, threshold, tp, fp, fn, round(prec, 6) AS precision, round(rec, 6) AS recall FROM ({RATES})",
    "best_threshold": f"SELECT layer, coalesce(max(threshold) FILTER (prec >= 0.3 AND rec >= 0.5), min(threshold)) AS threshold FROM ({RATES}) GROUP BY 1",
    "synthetic_negatives": f"""WITH r AS (SELECT id, coalesce(CASE WHEN NOT isnan(layer2_score) THEN layer2_score END, 0) s, row_number() OVER (ORDER BY {MD5}) k, count(*) OVER () // 2 h FROM ({PAIRS}) WHERE ordering_confidence = 'HIGH')
        SELECT a.id, b.id AS other_id, round(greatest(0.0, (a.s + b.s) / 2 - 0.3), 6) AS score FROM r a JOIN r b ON b.k = a.k + a.h WHERE a.k <= a.h""",
    "validation_funnel": f"""SELECT CASE WHEN NOT coalesce(layer1_score >= 0.55 AND NOT isnan(layer1_score), false) THEN 'structure' WHEN NOT coalesce(layer2_score >= 0.5 AND NOT isnan(layer2_score), false) THEN 'text'
        WHEN NOT coalesce(layer3_score >= 0.4 AND NOT isnan(layer3_score), false) THEN 'person' ELSE 'passed' END stage, count(*) n FROM ({PAIRS}) GROUP BY 1""",
    "cosine_topk": f"""WITH s AS (SELECT q.vec_id query_id, e.vec_id, {COS.format(a="q.embedding", b="e.embedding")} c FROM embeddings q JOIN embeddings e ON e.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) AS rank, vec_id, round(c, 6) similarity FROM s QUALIFY rank <= 5""",
    "same_person": f"""SELECT e.vec_id AS pair_id, CASE WHEN n.vec_id IS NULL THEN 0.0 ELSE round({COS.format(a="e.embedding", b="n.embedding")}, 6) END AS similarity,
        CASE WHEN n.vec_id IS NULL THEN false ELSE {COS.format(a="e.embedding", b="n.embedding")} >= 0.4 END AS same FROM embeddings e LEFT JOIN embeddings n ON n.vec_id = e.vec_id + 1""",
    "l1_distance": f"SELECT vec_id, round(list_sum(list_transform(list_zip(x, y), lambda p: abs(p[1]::DOUBLE - p[2]::DOUBLE))) / len(x), 6) AS l1 FROM ({NEXT})",
    "largest_image": "SELECT domain, arg_max(id, (width::BIGINT * height::BIGINT, -id)) AS id FROM image WHERE width IS NOT NULL AND height IS NOT NULL GROUP BY 1",
    "zone_presence": f"SELECT image_id, zone_code, confidence, n_landmarks, round(x, 6) x, round(y, 6) y FROM ({PRESENCE})",
    "dominant_zones": f"SELECT image_id, zone_code, row_number() OVER (PARTITION BY image_id ORDER BY confidence DESC, o) AS rank FROM ({PRESENCE}) WHERE confidence >= 0.5 QUALIFY rank <= 2",
    "zone_labels": f"SELECT image_id, zone_code, confidence, 'auto' AS source FROM ({PRESENCE}) WHERE confidence >= 0.5",
    "pose_match": f"""SELECT vec_id, CASE WHEN abs(x[1]::DOUBLE * 60 - y[1]::DOUBLE * 60) > 15 THEN 'yaw_mismatch' WHEN abs(x[2]::DOUBLE * 60 - y[2]::DOUBLE * 60) > 15 THEN 'pitch_mismatch'
        WHEN abs(x[3]::DOUBLE * 60 - y[3]::DOUBLE * 60) > 10 THEN 'roll_mismatch' ELSE 'accepted' END AS outcome FROM ({NEXT})""",
    "eye_alignment": """WITH p AS (SELECT vec_id, embedding[1]::DOUBLE * 100 + 100 lx, embedding[2]::DOUBLE * 100 + 100 ly, embedding[3]::DOUBLE * 100 + 100 rx, embedding[4]::DOUBLE * 100 + 100 ry FROM embeddings),
        g AS (SELECT *, sqrt((rx - lx) ** 2 + (ry - ly) ** 2) d, atan2(ry - ly, rx - lx) t FROM p), s AS (SELECT *, 0.35 * 512 / d::DOUBLE k FROM g)
        SELECT vec_id, CASE WHEN d >= 5 THEN round(degrees(t), 4) END AS angle, CASE WHEN d >= 5 THEN round(k, 4) END AS scale,
        CASE WHEN d >= 5 THEN round((1 - k * cos(t)) * (lx + rx) / 2 - k * sin(t) * (ly + ry) / 2 + 256 - (lx + rx) / 2, 3) END AS shift_x, CASE WHEN d < 5 THEN 'eye_distance_too_small' END AS reason FROM s""",
    "rate_limit_schedule": """WITH i AS (SELECT event_id, user_id, epoch_us(ts) AS t0, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) k FROM events)
        SELECT event_id, (max(t0 - k * 1800000000) OVER (PARTITION BY user_id ORDER BY k) + k * 1800000000)::BIGINT AS start FROM i""",
    "resume_anti": "SELECT id, file_path FROM image i WHERE NOT EXISTS (SELECT 1 FROM quality_result r WHERE r.image_id = i.id)",
    "split_sizes": f"SELECT id, {SPLIT} AS split FROM ({RANKED.format(by='', rows=PAIRS)})",
    "stratified_split": f"SELECT id, {SPLIT} AS split FROM ({RANKED.format(by='PARTITION BY treatment_category', rows=LABELS)})",
    "metric_means": f"SELECT grade, metric, round(avg(v), 3) mean, count(v) n FROM ({METRICS}) GROUP BY 1, 2",
    "batch_mean_of_means": f"SELECT metric, round(avg(m), 4) mean FROM (SELECT metric, id // 64 AS b, avg(v) m FROM ({METRICS}) WHERE v BETWEEN 0 AND 10000 GROUP BY 1, 2) GROUP BY 1",
    "batch_mean_of_means_all": f"SELECT metric, round(avg(m), 4) mean FROM (SELECT metric, id // 64 AS b, avg(v) m FROM ({METRICS}) GROUP BY 1, 2) GROUP BY 1",
    "one_per_host": f"SELECT lang, {HOST.format('url')} host, arg_min(url, doc_id) href FROM documents WHERE url IS NOT NULL AND {HOST.format('url')} <> '' AND NOT contains({HOST.format('url')}, 'clinic-') AND NOT contains({HOST.format('url')}, 'journal') GROUP BY 1, 2",
    "links_same_host": f"SELECT id FROM staging_queue WHERE {HOST.format('before_url')} = {HOST.format('source_url')} AND (regexp_matches(before_url, 'gallery|before') OR regexp_matches(lower(source_name), 'gallery|before'))",
    "absolute_links": """WITH p AS (SELECT doc_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) root FROM documents)
        SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN root || '/gallery?x=1' WHEN 2 THEN regexp_extract(url, '^([a-z]+:)', 1) || '//cdn.example/a.jpg' WHEN 3 THEN regexp_extract(url, '^(.*/)', 1) || 'next.html'
        WHEN 4 THEN url || '?page=2' WHEN 5 THEN url || '#top' ELSE 'https://other.test/z' END AS link FROM p""",
    "reject_buckets": f"SELECT split_part(fail_reason, ':', 1) AS reason, 'quality' AS bucket, count(*) n FROM ({SCORED}) WHERE fail_reason IS NOT NULL GROUP BY 1",
    "quality_reasons": f"""SELECT CASE WHEN width < 200 OR height < 200 THEN 'resolution_too_small' WHEN blur_score < 80 THEN 'blur_too_low' WHEN lighting_uniformity < 0.35::DOUBLE THEN 'lighting_uneven'
        WHEN mean_brightness > 245 THEN 'overexposed' WHEN mean_brightness < 15 THEN 'underexposed' ELSE 'PASS' END AS reason, count(*) n FROM ({SCORED}) WHERE {FINE} GROUP BY 1""",
    "quality_reasons_all": f"""SELECT CASE WHEN width < 200 OR height < 200 THEN 'resolution_too_small' WHEN blur_score < 80 THEN 'blur_too_low' WHEN lighting_uniformity < 0.35::DOUBLE THEN 'lighting_uneven'
        WHEN NOT isnan(mean_brightness) AND mean_brightness > 245 THEN 'overexposed' WHEN mean_brightness < 15 THEN 'underexposed' ELSE 'PASS' END AS reason, count(*) n FROM ({SCORED}) GROUP BY 1""",
    "run_stats": f"""WITH s AS (SELECT coalesce(width = 0, false) skip, fail_reason FROM ({SCORED}))
        SELECT count(*) n_total, count(*) FILTER (skip) n_skipped, count(*) FILTER (NOT skip AND fail_reason IS NULL) n_passed, count(*) FILTER (NOT skip AND fail_reason IS NOT NULL) n_rejected,
        round(count(*) FILTER (NOT skip AND fail_reason IS NULL) / count(*) FILTER (NOT skip), 6) pass_rate FROM s""",
    "orphan_labels": f"SELECT id FROM ({LABELS}) WHERE pair_id IS NOT NULL AND pair_id NOT IN (SELECT id FROM ({PAIRS}) WHERE before_image_id NOT IN ({BAD}))",
    "quarantine_urls": "SELECT DISTINCT url FROM (SELECT before_url url FROM staging_queue WHERE consent_tier >= 2 UNION ALL SELECT after_url FROM staging_queue WHERE consent_tier >= 2)",
    "new_images": "SELECT DISTINCT source_url, true AS has_id FROM (SELECT before_url source_url FROM staging_incoming UNION ALL SELECT after_url FROM staging_incoming) u WHERE NOT EXISTS (SELECT 1 FROM image i WHERE i.source_url = u.source_url)",
    "frontier_bfs": f"""WITH RECURSIVE p AS ({PAIRS}), e AS (SELECT before_image_id s, after_image_id d FROM p UNION SELECT after_image_id, before_image_id FROM p),
        r AS (SELECT DISTINCT before_image_id u, 0 AS k FROM p WHERE in_training_set UNION SELECT e.d, r.k + 1 FROM r JOIN e ON e.s = r.u WHERE r.k < 2)
        SELECT u::VARCHAR AS url, min(k) AS depth FROM r GROUP BY 1""",
    "seed_urls": "SELECT source_name AS name, 'https://' || replace(source_name, '_', '-') || '.example/reviews?page=' || k AS url FROM source_target, (SELECT unnest(range(1, 51)) k)",
    "query_seeds": "SELECT source_name AS name, 'https://' || source_name || '.example/s?q=' || url_encode(name_pt) AS url FROM source_target, canonical_term WHERE kind = 'category'",
    "download_admission": """SELECT CASE WHEN id % 7 = 0 THEN 'retry' WHEN id % 11 = 0 THEN 'http_404' WHEN id % 13 = 0 THEN 'bad_content_type' WHEN coalesce(file_size_bytes, 0) < 20000 THEN 'too_small' ELSE 'ok' END AS outcome, count(*) n
        FROM image GROUP BY 1""",
    "pair_downloads": f"""WITH s AS (SELECT p.id pair_id, coalesce(i.file_size_bytes >= 20000, false) ok, i.consent_tier = 1 cached FROM (SELECT id, unnest([before_image_id, after_image_id]) image_id FROM ({PAIRS})) p JOIN image i ON i.id = p.image_id)
        SELECT pair_id, bool_and(ok) AS ok, CASE WHEN bool_and(ok) THEN 0 ELSE count(*) FILTER (ok AND NOT cached) END::INT AS n_drop FROM s GROUP BY 1""",
    "manifest_json": f"SELECT pair_id, to_json({{'pair_id': pair_id, 'before_path': before_path, 'after_path': after_path, 'treatment_category': treatment_category, 'treatment_brand': treatment_brand}})::VARCHAR AS line FROM ({TRAINING})",
    "instruction_prompts": f"""WITH k AS (SELECT id, treatment_brand, CASE pair_id % 5 WHEN 0 THEN 'botox' WHEN 1 THEN 'lip_filler' WHEN 2 THEN 'prp' WHEN 3 THEN 'other' ELSE 'kybella' END k FROM ({LABELS}))
        SELECT id, {PROMPT_CASE} || CASE WHEN coalesce(treatment_brand, '') <> '' THEN ' using ' || treatment_brand ELSE '' END AS prompt FROM k""",
    "treatment_zones": f"""WITH z AS (SELECT unnest(CASE pair_id % 4 WHEN 0 THEN {ZONES_OF["botox"]} WHEN 1 THEN {ZONES_OF["lip_filler"]} WHEN 2 THEN {ZONES_OF["skin_booster"]} ELSE [] END) zone_code FROM ({LABELS}))
        SELECT zone_code, count(*) n FROM z GROUP BY 1""",
    "stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_batches": "SELECT event_type, count(*) n, sum(json_extract_string(props, '$.k')::BIGINT)::BIGINT sum_k FROM events GROUP BY 1",
}
