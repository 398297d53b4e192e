"""Link graphs: breadth-first frontier, politeness schedule, link discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairlake.functions.urls import host
from pairlake.runtime import fresh_path


def breadth_first(edges: DataFrame, seeds: DataFrame, depth: int, allowed: DataFrame | None = None) -> DataFrame:
    """(url, depth): pages reached from the seeds (url) over edges (src, dst) in at most ``depth`` steps.

    Each step joins the last frontier with the edges and leaves out what was visited. What was
    visited is a table in the shared folder to which each step adds its own rows, so nothing is
    written twice. ``allowed`` (host, allowed): pages of hosts that are not allowed are not
    followed; unknown hosts are.
    """
    spark = edges.sparkSession
    path = fresh_path(spark, "visited")
    ok = lambda df: df if allowed is None else df.withColumn("host", host(F.col("url"))).join(allowed, "host", "left").where(F.coalesce("allowed", F.lit(True))).select("url")
    read = lambda p: spark.read.schema("url string").parquet(p)
    ok(seeds.select("url").where("coalesce(url, '') <> ''").distinct()).write.parquet(f"{path}/depth=0")
    for d in range(1, depth + 1):
        frontier = read(f"{path}/depth={d - 1}")
        if frontier.isEmpty():
            break
        found = ok(frontier.join(edges, F.col("url") == F.col("src")).select(F.col("dst").alias("url")).where("coalesce(url, '') <> ''").distinct())
        found.join(read(path), "url", "left_anti").write.parquet(f"{path}/depth={d}")
    return spark.read.schema("url string, depth int").parquet(path)


def schedule(requests: DataFrame, by: list[str], arrival: Column, order: list[str], gap: float, span: float | None = None) -> DataFrame:
    """Adds ``start``: s(i) = max(arrival(i), s(i-1) + gap) for each host, in order of arrival, then ``order``.

    Closed form: the running maximum of arrival - i * gap, plus i * gap. A host's requests are cut into
    spans of time: numbers and maxima are taken inside a span and carried over spans, so a host with a
    third of all requests is not one task. ``span``: by default 4096 gaps.
    """
    cuts = requests.withColumns({"at_": arrival, "span_": F.floor(arrival / (span or gap * 4096))})
    inner = Window.partitionBy(*by, "span_").orderBy("at_", *order)
    cuts = cuts.withColumn("k_", F.row_number().over(inner).cast("long"))
    # with k counted inside a span, a span's own maximum needs only be moved by the number of requests before it
    spans = cuts.groupBy(*by, "span_").agg(F.count(F.lit(1)).alias("n_"), F.max(F.col("at_") - F.col("k_") * gap).alias("m_"))
    over = Window.partitionBy(*by).orderBy("span_")
    spans = spans.withColumn("before_", F.sum("n_").over(over) - F.col("n_"))
    spans = spans.withColumn("carry_", F.max(F.col("m_") - F.col("before_") * gap).over(over.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.select(*[F.col(c).alias(f"{c}__") for c in by], F.col("span_").alias("span__"), "before_", "carry_")
    on = F.col("span_") == F.col("span__")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"{c}__"))
    rows = cuts.join(spans, on).withColumn("i_", F.col("before_") + F.col("k_"))
    own = F.max(F.col("at_") - F.col("i_") * gap).over(inner.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("start", F.greatest(own, F.col("carry_")) + F.col("i_") * gap).select(*requests.columns, "start")


def backoff(attempt: Column, base: float = 2.0) -> Column:
    """Seconds before the next attempt: 2, 4, 8, ..."""
    return F.pow(F.lit(base), attempt)


def discover(links: DataFrame, pattern: str, page_url: str = "page_url", href: str = "href", text: str = "text") -> DataFrame:
    """Links to the page's own host whose address or text matches."""
    return links.where((host(F.col(href)) == host(F.col(page_url))) & (F.col(href).rlike(pattern) | F.lower(text).rlike(pattern)))


def next_pages(links: DataFrame) -> DataFrame:
    """Links that lead to the next page of a listing: by their relation, class, label or text."""
    said = F.lower(F.concat_ws(" ", "class", "label"))
    return links.where((F.lower(F.coalesce("rel", F.lit(""))) == "next") | said.rlike(r"\bnext\b|pagination-next|다음") | F.trim("text").isin("Next", "next", "›", "»", "다음", "Próxima"))


def one_per_host(links: DataFrame, by: list[str], order: list[str], deny: list[str], href: str = "href") -> DataFrame:
    """The first link to each host that is not denied; denied hosts are named by a part of them."""
    hosts = links.withColumn("host", host(F.col(href))).where(F.col("host") != "")
    for d in deny:
        hosts = hosts.where(~F.contains("host", F.lit(d)))
    return hosts.groupBy(*by, "host").agg(F.min_by(href, F.struct(*order)).alias(href))


def is_listing(n_links: Column, n_figures: Column) -> Column:
    return (n_links > 5) & (n_figures < 3)


def pages_of(base: Column, pages: int, pattern: str = "?page=") -> Column:
    """Array of a listing's page addresses, from 1."""
    return F.transform(F.sequence(F.lit(1), F.lit(pages)), lambda k: F.concat(base, F.lit(pattern), k.cast("string")))


def drained(queue: DataFrame, pushed: DataFrame, visited: DataFrame) -> DataFrame:
    """(url, turn): the first queue, then what was pushed to the second one meanwhile, each address once and none that was visited."""
    every = queue.select("url", F.lit(0).alias("turn")).unionByName(pushed.select("url", F.lit(1).alias("turn")))
    return every.where("coalesce(url, '') <> ''").groupBy("url").agg(F.min("turn").alias("turn")).join(visited.select("url"), "url", "left_anti")


def cursor_pages(listings: DataFrame, base: Column, depth: int = 5) -> DataFrame:
    """(listing, depth, url): pages reached by following each page's ``after`` token, the first without one, at most ``depth``.

    listings (listing, cursor, after): the token that asks for a page (null for the first) and the one it gives for the next.
    """
    rows = listings.select("listing", "cursor", "after")
    here = rows.where("cursor is null").select("listing", F.lit(1).alias("depth"), "cursor", "after")
    found = here
    for d in range(2, depth + 1):
        last = here.where("after is not null").select("listing", F.col("after").alias("cursor"))
        here = rows.join(last, ["listing", "cursor"]).select("listing", F.lit(d).alias("depth"), "cursor", "after")
        found = found.unionByName(here)
    return found.select("listing", "depth", F.when(F.col("cursor").isNull(), base).otherwise(F.concat(base, F.lit("?after="), F.col("cursor"))).alias("url"))


def search_hits(links: DataFrame, by: list[str], order: list[str], pattern: str, most: int, href: str = "href") -> DataFrame:
    """(by, n, href): the first ``most`` different links of a result page whose address matches, numbered in order."""
    once = links.where(F.col(href).rlike(pattern)).groupBy(*by, href).agg(F.min(F.struct(*order)).alias("o_"))
    return once.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("o_", href))).where(F.col("n") <= most).select(*by, "n", href)


def run_by_source(results: DataFrame, source: str = "source") -> DataFrame:
    """(source, n_inserted, n_skipped, n_errors, failed) of page results (source, inserted, skipped, error): a source whose pages all failed is failed, others go on."""
    bad = F.col("error").isNotNull()
    return results.groupBy(source).agg(F.sum(F.when(~bad, F.col("inserted")).otherwise(0)).alias("n_inserted"), F.sum(F.when(~bad, F.col("skipped")).otherwise(0)).alias("n_skipped"), F.count_if(bad).alias("n_errors"), F.every(bad).alias("failed"))
