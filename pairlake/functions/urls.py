"""URLs as columns: host, absolute form, labels, storage paths."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairlake.functions.vocabulary import COMMUNITIES, SLUGS


def table_lookup(table: dict, key: Column) -> Column:
    """Value of a small fixed table; null for other keys."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def host(url: Column) -> Column:
    """Lower-case host with port and user part; an empty string where a URL has none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


@F.pandas_udf(T.StringType())
def _joined(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([urljoin(b or "", h or "") for b, h in zip(base, href)])


def absolute(href: Column, base: Column) -> Column:
    """Absolute form of a link on a page, without dot segments; an empty link stays empty.

    Built-in expressions only; ``absolute_with_dots`` also resolves ``./`` and ``../``.
    """
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    folder = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    whole = F.substring_index(base, "#", 1)
    return (
        F.when(F.coalesce(href, F.lit("")) == "", F.lit(""))
        .when(href.startswith("http"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("#"), F.concat(whole, href))
        .when(href.startswith("?"), F.concat(F.substring_index(whole, "?", 1), href))
        .otherwise(F.concat(folder, href))
    )


def absolute_with_dots(href: Column, base: Column) -> Column:
    """As ``absolute``; only links with dot segments leave generated code."""
    return F.when(href.rlike(r"(^|/)\.\.?(/|$)") & ~href.startswith("http"), _joined(base, href)).otherwise(absolute(href, base))


def url_label(url: Column) -> Column:
    """Category of a page URL: by community, whole path part, bounded slug (longest first), slug anywhere.

    Only slugs that occur in the path at all are tried as bounded slugs.
    """
    low = F.lower(url)
    community = table_lookup(COMMUNITIES, F.regexp_extract(low, r"/r/([^/?#]+)", 1))
    first = lambda found: table_lookup(SLUGS, F.try_element_at(found, F.lit(1)))
    longest = F.array(*[F.lit(s) for s in sorted(SLUGS, key=lambda s: -len(s))])

    def inside(p: Column) -> Column:
        whole = F.filter(F.split(F.btrim(p, F.lit("/")), "/"), lambda x: x.isin(*SLUGS))
        return F.struct(p.alias("p"), whole.alias("whole"), F.filter(longest, lambda s: F.contains(p, s)).alias("some"))

    def label(x: Column) -> Column:
        # Fixed value: what bounds a slug in a path.
        bounded = F.filter(x["some"], lambda s: F.rlike(x["p"], F.concat(F.lit(r"(?:^|[/_-])"), s, F.lit(r"(?:[/_-]|$)"))))
        return F.coalesce(first(x["whole"]), first(bounded), first(x["some"]))

    # the path and what is found in it are bound once each
    return F.coalesce(community, F.element_at(F.transform(F.transform(F.array(path(low)), inside), label), 1))


def exact_label(url: Column) -> Column:
    """Category by community, else by the first part of the address that is a slug as a whole."""
    low = F.lower(url)
    community = table_lookup(COMMUNITIES, F.regexp_extract(low, r"/r/([^/?#]+)", 1))
    parts = F.transform(F.split(F.rtrim(low, F.lit("/")), "/"), lambda x: F.substring_index(x, "?", 1))
    return F.coalesce(community, table_lookup(SLUGS, F.try_element_at(F.filter(parts, lambda x: x.isin(*SLUGS)), F.lit(1))))


def titled_label(url: Column, *texts: Column) -> Column:
    """Category by a whole path part, else by the first slug, in their fixed order, whose words are in a text; texts are tried in order."""
    whole = F.filter(F.split(F.btrim(path(url), F.lit("/")), "/"), lambda x: x.isin(*SLUGS))
    slugs = F.array(*[F.lit(s) for s in SLUGS])

    def said(text: Column) -> Column:
        low = F.lower(F.coalesce(text, F.lit("")))
        return table_lookup(SLUGS, F.try_element_at(F.filter(slugs, lambda s: F.contains(low, F.replace(s, F.lit("-"), F.lit(" ")))), F.lit(1)))

    return F.coalesce(table_lookup(SLUGS, F.try_element_at(whole, F.lit(1))), *map(said, texts))


EXTENSIONS = [".jpg", ".jpeg", ".png", ".webp", ".gif"]


def content_path(source: Column, url: Column) -> Column:
    """Content-addressed place of a picture: source, first two digits of the hash, hash and extension."""
    digest = F.md5(url)
    ext = F.lower(F.regexp_extract(path(url), r"(\.[^./]+)$", 1))
    ext = F.when(ext.isin(*EXTENSIONS), ext).otherwise(".jpg")
    return F.concat(F.lit("images/raw/"), source, F.lit("/"), F.substring(digest, 1, 2), F.lit("/"), digest, ext)


def shard_path(pair_id: Column, side: str) -> Column:
    """Place of an aligned picture: two-digit shard of the pair, pair and side."""
    return F.concat(F.lpad((F.abs(pair_id) % 100).cast("string"), 2, "0"), F.lit("/"), pair_id.cast("string"), F.lit(f"_{side}.jpg"))


def mobile(url: Column, hosts: dict[str, str]) -> Column:
    """URL with its host replaced by the host's mobile one."""
    h = host(url)
    to = table_lookup(hosts, h)
    return F.when(to.isNull(), url).otherwise(F.concat(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://)", 1), to, F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(.*)$", 1)))


def without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def quoted(text: Column) -> Column:
    """Text as part of a URL; a space becomes %20."""
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
