"""Picture addresses as columns: site, case, role and file of an image URL.

All expressions are built-in functions, so they stay inside generated code.
All work is done stage by stage. An address is first freed of what doesn't matter for what it shows (white
space, percent-encoding, letter case, a relay in front of it, port, query
string, fragment, resize folders), then its parts are taken out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Endings of hosts; a site is the one name before an ending plus the ending.
ENDINGS = ("co.example", "com.test", "example", "test")
SITE = r"([^./:@\s]+\.(?:" + "|".join(e.replace(".", r"\.") for e in ENDINGS) + r"))\.?(?::\d*)?(?:[/?#]|$)"
OTHER_SITE = r"^(?:[^/@]*@)?(?:[^/:]*\.)?([^./:\s]+\.[^./:\s]+)\.?(?::\d*)?(?:[/?#]|$)"

CASE = r"(?:/gallery/case-|/c/|/before-after/|/stories/|/media/patient|[?&;]case=)0*(\d+)"
FILE = r"(?:/c/\d+/(?:before|after)/|/stories/\d+/photo/(?:untreated|result)-|/media/patient\d+/0[12]/|/gallery/case-\d+/|/before-after/\d+/|[?&;]img=)([^/?#&;]+)"
#: On what FILE matches: the side that the form of address names.
BEFORE = r"^/c/\d+/before/|^/stories/\d+/photo/untreated-|^/media/patient\d+/01/|^/gallery/.*-before(?:[-_@.]|$)|^/before-after/.*_pre(?:[-_@.]|$)|^.img=.*-b$"
AFTER = r"^/c/\d+/after/|^/stories/\d+/photo/result-|^/media/patient\d+/02/|^/gallery/.*-after(?:[-_@.]|$)|^/before-after/.*_post(?:[-_@.]|$)|^.img=.*-a$"
FORMAT = r"(?:-\d{2,4}x\d{2,4}|-scaled|@\dx|_large|_medium|_small|_thumb|-thumb)?(?:\.(?:jpe?g|png|webp|gif|avif|bmp|tiff?|heic))?$"
ROLE_END = r"(?:-before|-after|_pre|_post)$"
ROLE_END_QUERY = r"-[ab]$"


def _decoded(url: Column) -> Column:
    plain = F.coalesce(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), url)
    return F.when(F.contains(url, F.lit("%")), plain).otherwise(url)


def _without(df: DataFrame, stages: list[dict[str, Column]], temporary: list[str]) -> DataFrame:
    """Columns added stage by stage, so that no expression holds another one several times."""
    for s in stages:
        df = df.withColumns(s)
    return df.drop(*temporary)


def with_addresses(df: DataFrame, urls: dict[str, str]) -> DataFrame:
    """Adds the addresses of URL columns (column -> new column): host and the rest of the URL,
    lower case, decoded, without scheme and relay; null stays null."""
    at, c = list(urls.values()), F.col
    relay = {x: F.when(F.contains(c(x), F.lit("://")), F.element_at(F.split(c(x), r"https?:/+"), -1)).otherwise(c(x)) for x in at}
    amp = {x: F.when(F.contains(c(x), F.lit("amp;")), F.replace(c(x), F.lit("amp;"), F.lit(""))).otherwise(c(x)) for x in at}
    double = {x: F.when(F.contains(c(x), F.lit("//")), F.regexp_replace(c(x), "/{2,}", "/")).otherwise(c(x)) for x in at}
    trim = {x: F.lower(F.btrim(c(x), F.lit(" \t\r\n\f "))) for x in at}
    return _without(df, [{x: _decoded(c(u)) for u, x in urls.items()}, {x: _decoded(c(x)) for x in at}, trim, amp, relay, double], [])


def _first(text: Column, pattern: str) -> Column:
    """First group of the first match, else null; the pattern is searched once."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), 1), F.lit(1))


def site(at: Column) -> Column:
    """The site of an address or a host; null where there is none."""
    host = F.substring_index(at, "/", 1)
    return F.coalesce(_first(host, SITE), _first(host, OTHER_SITE))


def case_number(at: Column) -> Column:
    """Digits of the case without leading zeros; null where the address has none."""
    return _first(at, CASE)


def with_pictures(df: DataFrame, urls: dict[str, str]) -> DataFrame:
    """Adds one string per URL column for the picture it shows: site, case, role and file.

    An address that has no known form stands for itself (without query and fragment).
    """
    c, own = F.col, {u: f"{x}_at" for u, x in urls.items()}
    df = with_addresses(df, own)
    found, parts, names, out = {}, {}, {}, {}
    for u, x in urls.items():
        at, whole, raw = c(own[u]), c(f"{x}_found"), c(f"{x}_raw")
        # everything but the site is read from the short part that names case, side and file
        found |= {f"{x}_found": F.regexp_extract(at, FILE, 0)}
        parts |= {f"{x}_raw": F.regexp_extract(whole, FILE, 1)}
        names |= {f"{x}_raw": F.regexp_replace(raw, FORMAT, "")}
        query = F.contains(whole, F.lit("img="))
        name = F.when(query, F.regexp_replace(raw, ROLE_END_QUERY, "")).otherwise(F.regexp_replace(raw, ROLE_END, ""))
        role = F.when(whole.rlike(BEFORE), "b").when(whole.rlike(AFTER), "a").otherwise("")
        case = F.when(query, case_number(at)).otherwise(case_number(whole))
        known = F.concat_ws("|", site(at), case, role, name)
        out |= {x: F.when(raw != "", known).otherwise(F.regexp_replace(at, "[?#].*$", ""))}
    return _without(df, [found, parts, names, out], [*found, *parts, *own.values()])


def with_site(df: DataFrame, domain: str, source_url: str, to: str, case_to: str | None = None) -> DataFrame:
    """Adds the site of an image (of its domain, or of its address where the domain is empty), and its case number."""
    c = F.col
    df = with_addresses(df, {source_url: "at_"}).withColumn("host_", F.regexp_replace(F.lower(F.btrim(c(domain), F.lit(" \t\r\n\f "))), "^https?:/+", ""))
    df = df.withColumn("host_", F.when(c("host_") != "", c("host_")).otherwise(c("at_")))
    df = df.withColumn(to, site(c("host_")))
    if case_to:
        df = df.withColumn(case_to, case_number(c("at_")))
    return df.drop("at_", "host_")


def usable(score: Column) -> Column:
    """The score where it is a number from 0 to 1, else null (NaN is above 1 in Spark's order)."""
    return F.when((score >= 0) & (score <= 1) & ~F.isnan(score), score + F.lit(0.0))
