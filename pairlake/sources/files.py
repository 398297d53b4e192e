"""Pictures and local data sets as files, page sources from a YAML file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlake.operators.kernels import quality_of_bytes

PICTURES = r"(?i)\.(jpe?g|png|webp|gif|bmp|pgm|ppm)$"


def pictures(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """(path, name, folder, stem, size[, content]) of picture files below a folder; the bytes are read only if asked for."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.col("path").rlike(PICTURES))
    name = F.substring_index("path", "/", -1)
    cols = ["path", name.alias("name"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), F.regexp_replace(name, r"\.[^.]+$", "").alias("stem"), F.col("length").alias("size")]
    return df.select(*cols, *(["content"] if content else []))


def quality(spark: SparkSession, path: str) -> DataFrame:
    """Measures of all pictures below a folder."""
    return pictures(spark, path, content=True).select("path", quality_of_bytes("content").alias("q")).select("path", "q.*")


def split_folders(files: DataFrame) -> DataFrame:
    """Pairs of equal stems in folders named before and after."""
    b, a = (files.where(F.lower("folder") == f).select(F.lower("stem").alias("key"), F.col("path").alias(f)) for f in ("before", "after"))
    return b.join(a, "key").select("key", "before", "after")


def numbered(files: DataFrame) -> DataFrame:
    """Pairs named <number>_before and <number>_after in one folder."""
    part = F.regexp_extract(F.lower("stem"), r"^(\d+)[_\-](before|after)$", 2)
    own = files.withColumns({"side": part, "key": F.regexp_extract(F.lower("stem"), r"^(\d+)[_\-](before|after)$", 1)}).where("side <> ''")
    return own.groupBy("folder", "key").agg(F.min(F.when(F.col("side") == "before", F.col("path"))).alias("before"), F.min(F.when(F.col("side") == "after", F.col("path"))).alias("after")).where("before is not null and after is not null").select("key", "before", "after")


def renamed(files: DataFrame) -> DataFrame:
    """Pairs whose names differ by before and after."""
    b = files.where(F.contains(F.lower("stem"), F.lit("before"))).select("folder", F.lower("stem").alias("key"), F.col("path").alias("before"), F.replace(F.lower("stem"), F.lit("before"), F.lit("after")).alias("other"))
    a = files.select("folder", F.lower("stem").alias("other"), F.col("path").alias("after"))
    return b.join(a, ["folder", "other"]).select("key", "before", "after")


def local_pairs(files: DataFrame) -> DataFrame:
    """Pairs by the first of the three layouts that gives any."""
    found = None
    for k, f in enumerate((split_folders, numbered, renamed)):
        own = f(files).withColumn("strategy", F.lit(k))
        found = own if found is None else found.unionByName(own)
    least = found.agg(F.min("strategy").alias("strategy"))
    return found.join(F.broadcast(least), "strategy")


SOURCE = "ordinal int, name string, enabled boolean, rendering string, consent_tier int, rate_limit double, base_urls array<string>, calibration_source boolean, extra map<string,string>"
KNOWN = {"enabled", "rendering", "consent_tier", "rate_limit", "base_urls", "calibration_source"}


def source_rows(config: dict) -> list[tuple]:
    """One row per configured source with defaults: unknown rendering is static, an invalid tier 3, no rate limit 3 seconds."""
    rows = []
    for k, (name, raw) in enumerate((config.get("sources") or {}).items()):
        raw = raw or {}
        tier = raw.get("consent_tier", 3)
        rendering = raw.get("rendering", "static")
        rows.append((
            k, name, bool(raw.get("enabled", True)), rendering if rendering in ("static", "dynamic") else "static", tier if tier in (1, 2, 3) else 3, float(raw.get("rate_limit") or 3.0),
            [str(u) for u in raw.get("base_urls") or []], bool(raw.get("calibration_source", False)), {str(a): str(b) for a, b in raw.items() if a not in KNOWN},
        ))
    return rows


def sources(spark: SparkSession, path: str, include_disabled: bool = False) -> DataFrame:
    """Page sources of a YAML file (a few dozen entries), in order."""
    import yaml

    with open(path, encoding="utf-8") as f:
        df = spark.createDataFrame(source_rows(yaml.safe_load(f) or {}), SOURCE)
    return df if include_disabled else df.where("enabled")


def registered(sources_: DataFrame, registry: list[str], include_disabled: bool = False) -> DataFrame:
    """Configured sources in the order of the registry; names that aren't registered, or not configured, are left out."""
    names = sources_.sparkSession.createDataFrame(list(enumerate(registry)), "place int, name string")
    own = sources_ if include_disabled else sources_.where("enabled")
    return own.join(F.broadcast(names), "name").orderBy("place")


def with_cache(wanted: DataFrame, inventory: DataFrame, least: int = 1024) -> DataFrame:
    """Adds ``from_cache`` to files (path, ...): whether the inventory (path, size) has it with at least ``least`` bytes."""
    have = inventory.where(F.col("size") >= least).select("path").distinct().withColumn("from_cache", F.lit(True))
    return wanted.join(have, "path", "left").withColumn("from_cache", F.coalesce("from_cache", F.lit(False)))


def calibration_source(sources_: DataFrame) -> str:
    """Name of the first source that is marked for calibration; there must be one."""
    found = sources_.where("calibration_source").orderBy("ordinal").select("name").head()
    if found is None:
        raise ValueError("no source is marked as calibration_source")
    return found[0]


def seeds(sources_: DataFrame, pages: int, pattern: str = "?page=") -> DataFrame:
    """(name, url): the numbered pages of each base address."""
    numbers = F.sequence(F.lit(1), F.lit(pages))
    return sources_.select("name", F.explode("base_urls").alias("base")).select("name", F.explode(F.transform(numbers, lambda k: F.concat("base", F.lit(pattern), k.cast("string")))).alias("url"))


def query_seeds(templates: DataFrame, terms: DataFrame) -> DataFrame:
    """(name, url): search addresses of each template with each term, quoted; both are short lists."""
    from pairlake.functions.urls import quoted

    return templates.join(F.broadcast(terms.agg(F.collect_list("term").alias("ts"))), F.lit(True)).select("name", F.explode("ts").alias("term"), "template").select("name", F.replace("template", F.lit("{query}"), quoted(F.col("term"))).alias("url"))


def admitted(status: Column, content_type: Column, size: Column, least: int = 1024) -> Column:
    """'ok', 'retry' or the reason to give up on a fetched file."""
    kind = F.lower(F.substring_index(content_type, ";", 1))
    return (
        F.when(status.isin(429, 500, 502, 503, 504), "retry").when(status != 200, F.concat(F.lit("http_"), status.cast("string")))
        .when(~(kind.startswith("image/") | (kind == "application/octet-stream")), "bad_content_type").when(size < least, "too_small").otherwise("ok")
    )


def pair_downloads(results: DataFrame) -> DataFrame:
    """(pair_id, ok, drop): a pair is kept if both files came; a lone new file is to be dropped, a cached one stays."""
    own = results.groupBy("pair_id").agg(F.every("success").alias("ok"), F.collect_list(F.when(F.col("success") & ~F.col("from_cache"), F.col("path"))).alias("fresh"))
    return own.select("pair_id", "ok", F.when(F.col("ok"), F.array().cast("array<string>")).otherwise(F.col("fresh")).alias("drop"))


def download_stats(results: DataFrame) -> DataFrame:
    ok = F.col("success")
    return results.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(ok).alias("n_ok"), F.count_if(ok & F.col("from_cache")).alias("n_cached"), F.count_if(~ok).alias("n_failed"), F.coalesce(F.sum(F.when(ok, F.col("size"))), F.lit(0)).alias("n_bytes"))
