"""Queries of pages: elements, pairs by every strategy, signals, cards, labels, links; with the SQL they are checked against.

The data have no pages of pictures, so a page is made for every staged row, of one of several kinds by its id.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlake.functions import texts, urls
from pairlake.functions.vocabulary import AFTER_WORDS, BEFORE_WORDS
from pairlake.operators import frontier, html
from pairlake.plans.sql import SLUG_ROWS, any_word
from pairlake.runtime import cut, table

#: Places in a page's text: the row's id and its three pictures.
ID, B, A, C = "<id>", "<b>", "<a>", "<c>"


def _made(spark: SparkSession, sf: str, kinds: list[str]) -> DataFrame:
    """(page_id, html): one page per staged row, of the kind id modulo their number."""
    own = {ID: F.col("id").cast("string")} | {p: F.concat(F.lit("u"), F.col("id").cast("string"), F.lit(f"-{k}.jpg")) for k, p in enumerate((B, A, C), 1)}
    pages = [F.concat(*[own[x] if x in own else F.lit(x) for x in re.split(f"({'|'.join(own)})", kind) if x]) for kind in kinds]
    return table(spark, sf, "staging_queue").select(F.col("id").alias("page_id"), F.element_at(F.array(*pages), (F.col("id") % len(pages) + 1).cast("int")).alias("html"))


def _text(*parts: str) -> str:
    return "".join(parts)


def page_strategies(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs by the first strategy that finds any, on pages of eight kinds."""
    kinds = [
        _text('<div data-before="', B, '" data-after="', A, '"></div>'),
        _text('<figure><img src="', B, '"><img src="', A, '"><figcaption>before and after</figcaption></figure>'),
        _text('<div><img src="', B, '" alt="before"><img src="', A, '" class="result"><img src="', C, '" alt="antes"></div>'),
        _text('<div><img src="', B, '"><img src="', A, '"><img src="', C, '"></div>'),
        _text('<div class="slide"><img src="', B, '"><img src="', A, '"></div>'),
        _text('<div class="slide">Before<img src="', B, '"></div><div class="slide">After<img src="', A, '"></div>'),
        _text('<div><img src="', B, '"> antes</div><div><img src="', A, '"> depois</div>'),
        _text("<p>no pictures</p>"),
    ]
    return html.candidate_pairs(_made(spark, sf, kinds))


def attribute_pairs(spark: SparkSession, sf: str) -> DataFrame:
    kinds = [_text('<p>x</p><div data-before="', B, '" data-after="', A, '"></div>'), _text('<div data-before="', B, '"></div>')]
    return html.attribute_pairs(html.elements(_made(spark, sf, kinds)))


def figure_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Figures whose caption speaks of one of both sides."""
    kinds = [_text('<figure><img src="', B, '"><img src="', A, f'"><figcaption>{t}</figcaption></figure>') for t in ("baseline", "the outcome", "before and results", "nothing said")]
    return html.figure_pairs(html.images(html.elements(_made(spark, sf, kinds))).where("src is not null"), either=True)


def _signals(spark: SparkSession, sf: str) -> DataFrame:
    kinds = [
        _text('<figure><img src="', B, '"><figcaption>Before</figcaption></figure><figure><img src="', A, '"><figcaption>After</figcaption></figure>'),
        _text('<div><img src="', B, '"><img src="', A, '"></div>'),
        _text('<div><img src="', B, '" alt="Before"><img src="/x/', A, '" alt="the result"></div>'),
        _text('<div><img src="', B, '" class="pre-op big"><img data-src="', A, '" class="post-op"></div>'),
        _text('<div data-role="antes"><p><img src="', B, '"></p></div><div data-role="resultado"><img src="', A, '"></div>'),
        _text("<div>none</div>"),
        _text('<div><img src="before/', B, '"><img src="after/', A, '"></div>'),
    ]
    pages = _made(spark, sf, kinds)
    own = F.when(F.col("page_id") % 7 == 6, F.lit(True)).otherwise(F.lit(False))
    name = lambda k, folder: F.concat(F.when(own, folder).otherwise(""), F.lit("u"), F.col("page_id").cast("string"), F.lit(f"-{k}.jpg"))
    wanted = pages.select("page_id", F.explode(F.array(F.struct(name(1, "before/").alias("url"), F.lit("before").alias("side")), F.struct(name(2, "after/").alias("url"), F.lit("after").alias("side")))).alias("x")).select("page_id", "x.*")
    return html.signals(html.elements(pages), wanted)


def structural_signals(spark: SparkSession, sf: str) -> DataFrame:
    return _signals(spark, sf).select("page_id", "side", F.array_join("strong", ",").alias("strong"), "weak")


def structural_scores(spark: SparkSession, sf: str) -> DataFrame:
    return html.scored_pairs(_signals(spark, sf), ["page_id"])


def picture_contexts(spark: SparkSession, sf: str) -> DataFrame:
    """What is said around each picture."""
    kinds = [_text("<h2>Head ", ID, '</h2><figure><img src="', B, '" alt="alt" aria-label="lab"><figcaption>cap ', ID, "</figcaption></figure>"), _text('<div><img src="', B, '"><p>next</p></div>')]
    pics = html.images(html.elements(_made(spark, sf, kinds)))
    return pics.select("page_id", "src", html.picture_context().alias("said"))


def cards(spark: SparkSession, sf: str) -> DataFrame:
    end = '</span><time datetime="2021-02">x</time><time datetime="1999">y</time></div>'
    kinds = [_text('<div data-treatment-name="t', ID, '"><span data-provider-name="p">', end), _text('<div data-treatment-name="t', ID, '"><span>', end), _text("<div>nothing</div>")]
    return html.cards(html.elements(_made(spark, sf, kinds)))


def script_pictures(spark: SparkSession, sf: str) -> DataFrame:
    kinds = [_text('<script>{"url":"https:\\/\\/i\\/', ID, '.jpg","description":"before ', ID, '"},{"url": "https://i/', ID, '-2.png"}</script>'), _text("<script>none</script>")]
    return html.script_images(_made(spark, sf, kinds))


def listing_galleries(spark: SparkSession, sf: str) -> DataFrame:
    """Gallery pictures of posts whose titles speak of pairs."""
    media = [_text(f'"m{k}":{{"status":"{"bad" if k == 2 else "valid"}","s":{{"u":"https://i/', ID, f'/{k}?a=1&amp;b=2"}}}}') for k in range(5)]
    post = lambda title: _text('{"data":{"after":"t","children":[{"data":{"title":"', title, '","permalink":"/p', ID, '","is_gallery":true,"media_metadata":{', ",".join(media), "}}}]}}")
    return html.listing_pairs(_made(spark, sf, [post("Before and after"), post("my cat"), post("B/A photos"), _text("no json")]), body="html")


def platforms(spark: SparkSession, sf: str) -> DataFrame:
    keys = {"gallery": "gallery", "stories": "stories", "uploads/c": "uploads"}
    return table(spark, sf, "staging_queue").select("id", html.dispatched(F.col("source_url"), keys, "generic").alias("platform"))


def titled_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels by whole path parts, else by the page's title, else by its heading."""
    pick = lambda k, *x: F.element_at(F.array(*[F.lit(v).cast("string") for v in x]), (F.col("id") % k + 1).cast("int"))
    u = F.concat("source_url", pick(3, "/botox/x", "/none", "/a/lip-filler"))
    return table(spark, sf, "staging_queue").select("id", urls.titled_label(u, pick(4, "My Lip Filler story", None, "Nose Surgery and botox", "nothing"), pick(5, "Chin Implants", "", None, "PRP", "x")).alias("label"))


# --- links


def _links(spark: SparkSession, sf: str) -> DataFrame:
    kinds = [
        _text('<a href="/n', ID, '" rel="next">2</a><a href="/x">x</a>'), _text('<a href="/m', ID, '" class="pager next">go</a>'), _text('<a href="/l', ID, '" aria-label="다음">2</a>'),
        _text('<a href="/t', ID, '"> › </a><a>no address</a>'), _text("".join(f'<a href="/{k}">text</a>' for k in range(7)), "<figure></figure>"),
    ]
    return html.elements(_made(spark, sf, kinds))


def next_pages(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.next_pages(html.links(_links(spark, sf))).select("page_id", "href")


def listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    n = lambda t: F.count_if(F.col("tag") == t)
    return _links(spark, sf).groupBy("page_id").agg(n("a").alias("n_links"), n("figure").alias("n_figures")).select("page_id", frontier.is_listing(F.col("n_links"), F.col("n_figures")).alias("listing"))


def mobile_links(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses on the mobile host where there is one, without their query."""
    u = F.concat(F.element_at(F.array(F.lit("https://blog.a.test/"), F.lit("https://Blog.A.test/"), F.lit("https://b.test/")), (F.col("id") % 3 + 1).cast("int")), F.col("id").cast("string"), F.lit("?x=1"))
    return table(spark, sf, "staging_queue").select("id", urls.mobile(u, {"blog.a.test": "m.blog.a.test"}).alias("mobile"), urls.without_query(u).alias("plain"))


def page_addresses(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "source_target").select(F.explode(frontier.pages_of(F.col("source_name"), 5)).alias("url"))


def cursor_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of listings by their tokens: every staged row is a listing of up to eight pages, of which five are followed."""
    rows = table(spark, sf, "staging_queue").select(F.col("id").alias("listing"), F.explode(F.sequence(F.lit(0), (F.col("id") % 8).cast("int"))).alias("k"))
    token = lambda k: F.concat(F.lit("t"), k.cast("string"))
    listings = rows.select("listing", F.when(F.col("k") > 0, token(F.col("k"))).alias("cursor"), F.when(F.col("k") < F.col("listing") % 8, token(F.col("k") + 1)).alias("after"))
    return frontier.cursor_pages(cut(listings), F.concat(F.lit("/r/"), F.col("listing").cast("string")))


def search_hits(spark: SparkSession, sf: str) -> DataFrame:
    """The first three different document addresses of each language with a digit in them: the number is the feature."""
    d = table(spark, sf, "documents").where("url is not null").select("lang", "doc_id", F.col("url").alias("href"))
    return frontier.search_hits(d, ["lang"], ["doc_id"], r"[0-9]", 3)


def retry_delays(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", frontier.backoff((F.col("event_id") % 4 + 1).cast("int")).cast("long").alias("seconds"))


def joined_texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", texts.pair_text(F.array(F.col("lang"), F.lit(None).cast("string"), F.lit(""), F.col("source"))).alias("text"))


QUERIES = [
    page_strategies, attribute_pairs, figure_pairs, structural_signals, structural_scores, picture_contexts, cards, script_pictures, listing_galleries, platforms, titled_labels,
    next_pages, listing_pages, mobile_links, page_addresses, cursor_pages, search_hits, retry_delays, joined_texts,
]

U = "id AS page_id, 'u' || id || '-1.jpg' AS \"before\", 'u' || id || '-2.jpg' AS \"after\""
STRONG = {"before": ["caption", "", "data_attr,alt_text", "data_attr,css_class", "parent_attr", "", "filename,data_attr"]}
WEAK = "(1, 2, 3, 6)"
KIND = "CASE id % 7 " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(STRONG["before"])) + " END"
SIDE = {s: "(" + any_word(f"concat_ws(' ', {alt}, {url})", w) + ")" for s, alt, url, w in (("bb", "'before'", "before_url", BEFORE_WORDS), ("ab", "'result'", "after_url", BEFORE_WORDS), ("aa", "'result'", "after_url", AFTER_WORDS))}

SQL = {
    "page_strategies": f"SELECT {U}, [1, 2, 3, 4, 5, 5, 6][id % 8 + 1] AS strategy, 1 AS n FROM staging_queue WHERE id % 8 <> 7",
    "attribute_pairs": f"SELECT {U}, 1 AS pos FROM staging_queue WHERE id % 2 = 0",
    "figure_pairs": f"SELECT {U}, 1 AS n FROM staging_queue WHERE id % 4 <> 3",
    "structural_signals": f"SELECT id AS page_id, side, {KIND} AS strong, id % 7 IN {WEAK} AS weak FROM staging_queue, (VALUES ('before'), ('after')) s(side)",
    "structural_scores": f"SELECT id AS page_id, CASE WHEN ({KIND}) <> '' THEN 0.9 WHEN id % 7 IN {WEAK} THEN 0.2 ELSE 0.0 END::DOUBLE AS score, ({KIND}) <> '' AS explicit FROM staging_queue",
    "picture_contexts": "SELECT id AS page_id, 'u' || id || '-1.jpg' AS src, CASE WHEN id % 2 = 0 THEN 'alt lab cap ' || id || ' Head ' || id ELSE 'next' END AS said FROM staging_queue",
    "cards": """SELECT id AS page_id, CASE WHEN id % 3 < 2 THEN 't' || id END AS treatment_name, CASE WHEN id % 3 = 0 THEN 'p' END AS provider_name, CASE WHEN id % 3 < 2 THEN '2021-02' END AS date_posted FROM staging_queue""",
    "script_pictures": "SELECT id AS page_id, pos, CASE pos WHEN 0 THEN 'https://i/' || id || '.jpg' ELSE 'https://i/' || id || '-2.png' END AS url, CASE pos WHEN 0 THEN 'before ' || id END AS description FROM staging_queue, (VALUES (0), (1)) p(pos) WHERE id % 2 = 0",
    "listing_galleries": """SELECT id AS page_id, '/p' || id AS permalink, n, 'https://i/' || id || '/' || (n - 1) || '?a=1&b=2' AS "before", 'https://i/' || id || '/' || (n + 2) || '?a=1&b=2' AS "after" FROM staging_queue, (VALUES (1), (2)) p(n) WHERE id % 4 IN (0, 2)""",
    "platforms": "SELECT id, CASE WHEN contains(source_url, 'gallery') THEN 'gallery' WHEN contains(source_url, 'stories') THEN 'stories' WHEN contains(source_url, 'uploads/c') THEN 'uploads' ELSE 'generic' END AS platform FROM staging_queue",
    "titled_labels": f"""WITH s(slug, cat, o) AS (VALUES {SLUG_ROWS}),
        q AS (SELECT id, source_url || CASE id % 3 WHEN 0 THEN '/botox/x' WHEN 1 THEN '/none' ELSE '/a/lip-filler' END u, CASE id % 4 WHEN 0 THEN 'my lip filler story' WHEN 2 THEN 'nose surgery and botox' WHEN 3 THEN 'nothing' END t, CASE id % 5 WHEN 0 THEN 'chin implants' WHEN 1 THEN '' WHEN 3 THEN 'prp' WHEN 4 THEN 'x' END h FROM staging_queue),
        p AS (SELECT id, unnest(string_split(trim(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/')) x, generate_subscripts(string_split(trim(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/'), 1) i FROM q),
        e AS (SELECT id, min_by(cat, i) c FROM p JOIN s ON s.slug = p.x GROUP BY id),
        w AS (SELECT id, min_by(cat, o) FILTER (contains(t, replace(slug, '-', ' '))) a, min_by(cat, o) FILTER (contains(h, replace(slug, '-', ' '))) b FROM q, s GROUP BY id)
        SELECT q.id, coalesce(e.c, w.a, w.b) AS label FROM q LEFT JOIN e ON e.id = q.id LEFT JOIN w ON w.id = q.id""",
    "next_pages": "SELECT id AS page_id, '/' || ['n', 'm', 'l', 't'][id % 5 + 1] || id AS href FROM staging_queue WHERE id % 5 < 4",
    "listing_pages": "SELECT id AS page_id, id % 5 = 4 AS listing FROM staging_queue",
    "mobile_links": """SELECT id, CASE id % 3 WHEN 0 THEN 'https://m.blog.a.test/' WHEN 1 THEN 'https://m.blog.a.test/' ELSE 'https://b.test/' END || id || '?x=1' AS mobile,
        CASE id % 3 WHEN 0 THEN 'https://blog.a.test/' WHEN 1 THEN 'https://Blog.A.test/' ELSE 'https://b.test/' END || id AS plain FROM staging_queue""",
    "page_addresses": "SELECT source_name || '?page=' || k AS url FROM source_target, (SELECT unnest(range(1, 6)) k)",
    "cursor_pages": "SELECT id AS listing, k AS depth, '/r/' || id || CASE WHEN k > 1 THEN '?after=t' || (k - 1) ELSE '' END AS url FROM staging_queue, (SELECT unnest(range(1, 6)) k) WHERE k - 1 <= id % 8",
    "search_hits": """WITH o AS (SELECT lang, url AS href, min(doc_id) o FROM documents WHERE url IS NOT NULL AND regexp_matches(url, '[0-9]') GROUP BY 1, 2)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY o, href) AS n, href FROM o QUALIFY n <= 3""",
    "retry_delays": "SELECT event_id, (2 ** (event_id % 4 + 1))::BIGINT AS seconds FROM events",
    "joined_texts": "SELECT doc_id, concat_ws(' ', nullif(lang, ''), nullif(source, '')) AS text FROM documents",
    "page_elements": """SELECT tag, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM (SELECT doc_id, lower(unnest(regexp_extract_all(text, '<([a-zA-Z][a-zA-Z0-9]*)(?:\\s[^<>]*)?/?>', 1))) AS tag FROM documents) GROUP BY 1""",
    # a picture is one of the before side if its text or its address speaks of it; a page without both sides gives its neighbours
    "page_pairs": f"""WITH p AS (SELECT source_url, count(*) m, sum(({SIDE["bb"]})::INT + ({SIDE["ab"]})::INT) b, sum((NOT ({SIDE["ab"]}) AND ({SIDE["aa"]}))::INT) a FROM staging_queue GROUP BY 1)
        SELECT CASE WHEN least(a, b) > 0 THEN 3 ELSE 4 END AS strategy, sum(CASE WHEN least(a, b) > 0 THEN least(a, b) ELSE m END)::BIGINT AS n, count(*) AS n_pages FROM p GROUP BY 1""",
}
