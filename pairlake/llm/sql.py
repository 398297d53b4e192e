"""SQL that the training-data queries are checked against, where SQL can say them."""

from __future__ import annotations

from pairlake.llm.pictures import AFTER, BEFORE, CASE, FILE, FORMAT, ROLE_END, ROLE_END_QUERY

ENDING = r"(?:co\.example|com\.test|example|test)"
HOST = rf"([^./:@\s]+\.{ENDING})\.?(?::\d*)?(?:[/?#]|$)"


def site(domain: str, url: str) -> str:
    d = f"regexp_replace(lower(trim({domain}, ' ' || chr(9) || chr(10) || chr(13))), '^https?:/+', '')"
    u = f"regexp_replace(lower(trim({url}, ' ' || chr(9) || chr(10) || chr(13))), '^https?:/+', '')"
    return f"regexp_extract(CASE WHEN coalesce({d}, '') <> '' THEN split_part({d}, '/', 1) ELSE split_part({u}, '/', 1) END, '{HOST}', 1)"


PAIRS = "SELECT DISTINCT id, before_image_id, after_image_id, pair_confidence FROM image_pair"
USABLE = "CASE WHEN NOT isnan(pair_confidence) AND pair_confidence BETWEEN 0 AND 1 THEN pair_confidence END"
SCORES = f"""
p AS (SELECT id, before_image_id b, after_image_id a, {USABLE} score FROM ({PAIRS})),
t AS (SELECT source_name, keep_percent, regexp_replace(lower(source_name), '[^a-z0-9]', '', 'g') k FROM source_target),
s AS (SELECT p.id, p.score, t.source_name, t.keep_percent FROM p
      JOIN image ib ON ib.id = p.b JOIN image ia ON ia.id = p.a
      JOIN staging_queue q ON q.before_url = ib.source_url AND q.after_url = ia.source_url
      JOIN t ON t.k = regexp_replace(lower(q.source_name), '[^a-z0-9]', '', 'g') WHERE p.score IS NOT NULL),
v AS (SELECT source_name, keep_percent, score, count(*) c FROM s GROUP BY ALL),
w AS (SELECT *, sum(c) OVER (PARTITION BY source_name ORDER BY score DESC) kept, sum(c) OVER (PARTITION BY source_name) n FROM v),
cut AS (SELECT source_name, keep_percent, n, max(score) cutoff, min(kept) kept FROM w WHERE kept * 100 >= keep_percent * n GROUP BY ALL)
"""
MEASURES = f"""
q AS (SELECT DISTINCT ON (id) * FROM quality_result WHERE NOT (coalesce(width, 1) = 0 OR coalesce(height, 1) = 0)),
j AS (SELECT q.*, nullif({site('i.domain', 'i.source_url')}, '') site, CAST(CAST(scored_at AS DATE) AS VARCHAR) d FROM q LEFT JOIN image i ON i.id = q.image_id),
m AS (SELECT site, grade, d, 'blur_score' measure, round(blur_score / 0.01::DOUBLE) * 0.01::DOUBLE v FROM j WHERE isfinite(blur_score) AND blur_score >= 0
      UNION ALL SELECT site, grade, d, 'lighting_uniformity', round(lighting_uniformity / 0.0001::DOUBLE) * 0.0001::DOUBLE FROM j WHERE isfinite(lighting_uniformity) AND lighting_uniformity >= 0
      UNION ALL SELECT site, grade, d, 'mean_brightness', round(mean_brightness / 0.01::DOUBLE) * 0.01::DOUBLE FROM j WHERE isfinite(mean_brightness) AND mean_brightness >= 0),
k AS (SELECT 'site' kind, site group_key, measure, v FROM m UNION ALL SELECT 'grade', grade, measure, v FROM m UNION ALL SELECT 'day', d, measure, v FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY kind, group_key, measure ORDER BY v) rn, count(*) OVER (PARTITION BY kind, group_key, measure) n FROM k)
"""



def address(url: str) -> str:
    """An address without scheme and relay, decoded twice, in lower case."""
    d = f"CASE WHEN contains({url}, '%') THEN url_decode({url}) ELSE {url} END"
    d = f"CASE WHEN contains({d}, '%') THEN url_decode({d}) ELSE {d} END"
    return f"regexp_replace(regexp_replace(replace(lower(trim({d}, ' ' || chr(9) || chr(10) || chr(13))), 'amp;', ''), '^.*https?:/+', ''), '/{{2,}}', '/', 'g')"


SITE_OF = "regexp_extract(split_part(adr, '/', 1), '" + HOST + "', 1)"
PICTURES = f"""
u AS (SELECT id, 0 AS batch_no, before_url b, after_url a FROM staging_queue UNION ALL SELECT DISTINCT id, batch_no, before_url, after_url FROM staging_incoming),
x AS (SELECT id, batch_no, 'b' AS side, {address("b")} adr FROM u UNION ALL SELECT id, batch_no, 'a', {address("a")} FROM u),
f AS (SELECT *, regexp_extract(adr, '{FILE}', 0) found, regexp_replace(regexp_extract(adr, '{FILE}', 1), '{FORMAT}', '') raw FROM x),
s AS (SELECT id, batch_no, side, CASE WHEN raw <> '' THEN concat_ws('|', nullif({SITE_OF}, ''), nullif(CASE WHEN contains(found, 'img=') THEN regexp_extract(adr, '{CASE}', 1) ELSE regexp_extract(found, '{CASE}', 1) END, ''),
      CASE WHEN regexp_matches(found, '{BEFORE}') THEN 'b' WHEN regexp_matches(found, '{AFTER}') THEN 'a' ELSE '' END,
      CASE WHEN contains(found, 'img=') THEN regexp_replace(raw, '{ROLE_END_QUERY}', '') ELSE regexp_replace(raw, '{ROLE_END}', '') END) ELSE nullif(regexp_replace(adr, '[?#].*$', ''), '') END pic FROM f),
p AS (SELECT id, any_value(batch_no) batch_no, max(CASE WHEN side = 'b' THEN pic END) b, max(CASE WHEN side = 'a' THEN pic END) a FROM s GROUP BY id HAVING b IS NOT NULL AND a IS NOT NULL),
w AS (SELECT *, min(id) OVER (PARTITION BY b, a) first_id FROM p),
c AS (SELECT id, first_id, batch_no, min(id) OVER (PARTITION BY batch_no, b, a) own_id, regexp_replace(b, '[0-9]{{1,6}}$', '') bs, regexp_replace(a, '[0-9]{{1,6}}$', '') "as",
      coalesce(try_cast(regexp_extract(b, '[0-9]{{1,6}}$', 0) AS INT), 0) bn, coalesce(try_cast(regexp_extract(a, '[0-9]{{1,6}}$', 0) AS INT), 0) an FROM w)
"""
SITED = f"SELECT id, {site('domain', 'source_url')} site, nullif(regexp_extract({address('source_url')}, '{CASE}', 1), '') case_no FROM image"
GROUPS = f"""
i AS ({SITED}), e AS (SELECT id, concat_ws('|', nullif(site, ''), coalesce(case_no, 'image ' || id)) entity FROM i),
r AS (SELECT id, max(before_image_id) x, max(after_image_id) y, bool_or(in_training_set) flag FROM image_pair WHERE id IS NOT NULL GROUP BY id),
n AS (SELECT r.id, flag, b.entity a, coalesce(a.entity, b.entity) b FROM r LEFT JOIN e b ON b.id = r.x LEFT JOIN e a ON a.id = r.y),
l AS (SELECT a, b FROM n WHERE a <> b UNION SELECT b, a FROM n WHERE a <> b),
t(v, z) AS (SELECT a, b FROM l UNION SELECT t.v, l.b FROM t JOIN l ON l.a = t.z),
g AS (SELECT id, flag, least(coalesce(a, b), coalesce((SELECT min(z) FROM t WHERE t.v = coalesce(n.a, n.b)), coalesce(a, b))) root FROM n)
"""

SQL = {
    "p1_found": f"""
        WITH s AS (SELECT p.id, {USABLE} score, {site('i.domain', 'i.source_url')} site FROM ({PAIRS}) p JOIN image i ON i.id = p.before_image_id),
        r AS (SELECT id, row_number() OVER (PARTITION BY site ORDER BY score DESC NULLS LAST, id) rn, (SELECT count(DISTINCT id) // 50 FROM image_pair) cap FROM s)
        SELECT id AS pair_id FROM r WHERE rn > cap""",
    "p1_nested_caps": f"""
        WITH i AS ({SITED}), s AS (SELECT p.id, {USABLE} score, nullif(site, '') site, case_no, regexp_extract(site, '^[^.]+[.](.*)$', 1) ending FROM ({PAIRS}) p LEFT JOIN i ON i.id = p.before_image_id),
        one AS (SELECT * FROM s QUALIFY case_no IS NULL OR site IS NULL OR row_number() OVER (PARTITION BY case_no, site, ending ORDER BY score DESC NULLS LAST, id) <= 2),
        two AS (SELECT * FROM one QUALIFY site IS NULL OR row_number() OVER (PARTITION BY site, ending ORDER BY score DESC NULLS LAST, id) <= (SELECT count(*) // 50 FROM s)),
        three AS (SELECT * FROM two QUALIFY ending IS NULL OR row_number() OVER (PARTITION BY ending ORDER BY score DESC NULLS LAST, id) <= (SELECT count(*) // 3 FROM s))
        SELECT id AS pair_id, site, case_no FROM three""",
    "p2_found": f"""
        WITH RECURSIVE {GROUPS} SELECT least(a.id, b.id) AS pair_id_a, greatest(a.id, b.id) AS pair_id_b FROM g a JOIN g b ON b.root = a.root WHERE a.flag AND NOT b.flag""",
    "p2_groups": f"""
        WITH RECURSIVE {GROUPS} SELECT min(id) AS class_id, count(*) AS n_pairs, count(*) FILTER (flag) AS n_true, count(*) FILTER (NOT flag) AS n_false,
        count(*) FILTER (flag) > 0 AND count(*) FILTER (NOT flag) > 0 AS divided FROM g GROUP BY root""",
    "p3_found": f"WITH {PICTURES} SELECT DISTINCT first_id, id AS dup_id FROM w WHERE batch_no > 0 AND first_id < id",
    "p3_near": f"""
        WITH {PICTURES} SELECT n.id, k.id AS near_id, 2 AS distance FROM c n JOIN c k ON k.bs = n.bs AND k."as" = n."as" AND abs(k.bn - n.bn) + abs(k.an - n.an) = 1
        WHERE n.batch_no > 0 AND n.id = n.own_id AND k.id < n.id AND (k.id = k.first_id OR k.batch_no = n.batch_no AND k.id = k.own_id)""",
    "p3_batches": f"""
        WITH {PICTURES} SELECT i.batch_no, count(*) AS n_rows, count(*) FILTER (w.first_id < i.id) AS n_repeats
        FROM (SELECT DISTINCT id, batch_no FROM staging_incoming) i LEFT JOIN w ON w.id = i.id GROUP BY 1""",
    "p5_found": f"WITH {SCORES} SELECT s.id AS pair_id FROM s JOIN cut USING (source_name) WHERE s.score >= cut.cutoff",
    "p5_cutoffs": f"WITH {SCORES} SELECT source_name, keep_percent, n AS n_usable, cutoff, kept AS n_kept FROM cut",
    "p6_found": """
        WITH l AS (SELECT report_id, treatment_category, arg_max(pair_count, reported_at) n FROM balance_report GROUP BY ALL)
        SELECT r.report_id, t.treatment_category FROM (SELECT DISTINCT report_id FROM balance_report) r CROSS JOIN sample_target t
        LEFT JOIN l ON l.report_id = r.report_id AND l.treatment_category = t.treatment_category
        WHERE coalesce(l.n, 0) < greatest(t.min_count, t.target_permille * 120 / 1000.0)""",
    "p7_counts": f"""
        WITH {MEASURES} SELECT site, grade, CAST(d AS DATE) AS "day", measure, v AS "value", count(*) AS n FROM m GROUP BY ALL""",
    "p8_checked": "SELECT doc_id, true AS whole, true AS fits FROM documents WHERE text <> ''",
    "p7_percentiles": f"""
        WITH {MEASURES}
        SELECT kind, group_key, measure, CAST(p AS DOUBLE) p, round(min(v), 4) AS "value", n FROM r, (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]) p)
        WHERE rn = greatest(1, ceil(round(CAST(p AS DOUBLE) * n, 6))) GROUP BY kind, group_key, measure, p, n""",
}
