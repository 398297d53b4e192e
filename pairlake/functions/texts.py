"""Rule cascades over text as columns."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairlake.functions.urls import table_lookup
from pairlake.functions.vocabulary import AFTER_TEXT, BEFORE_TEXT, DEFAULT_PROMPT, PRIORITY, PROMPTS, TEXT_RULES, ZONES_OF


def needed_literals(pattern: str) -> list[str]:
    """For each alternative of a rule's pattern, the longest run of letters that a match must hold."""
    body = re.sub(r"\\b|^\(|\)$", "", pattern.replace("(?", ""))
    out = []
    for alternative in body.strip("()").split("|"):
        rest = re.sub(r"\[[^\]]*\][?*]?|\\[a-zA-Z][?*]?", " ", alternative)
        out.append(max(re.findall(r"[^\W\d_]+", rest), key=len))
    return sorted(set(out))


def text_label(text: Column, threshold: float = 0.5) -> Column:
    """struct(category, brand, confidence, n) of the most specific matching rule; nulls below the threshold.

    Every pattern is a literal, compiled once, and only tried on a text that holds a run of letters
    which its matches need. Confidence is 0.4 and 0.3 a match, at most 1. The best
    match has the highest priority, then a brand, then the earliest rule; without a brand of its own it
    takes that of the first match that is no more specific.
    """
    rule = lambda k, c, b: F.struct(F.lit(PRIORITY.get(c, 0)).alias("p"), F.lit(int(b is not None)).alias("has"), F.lit(-k).alias("o"), F.lit(c).alias("c"), F.lit(b).cast("string").alias("b"))
    # the rules are written in lower case; a long s is the one letter that lower case leaves and any case would match
    low = F.translate(F.lower(text), "ſ", "s")

    def tried(low: Column, pattern: str) -> Column:
        near = reduce(lambda a, b: a | b, [F.contains(low, F.lit(x)) for x in needed_literals(pattern)])
        return near & low.rlike("(?U)" + pattern)

    def hits(low: Column) -> Column:
        return F.filter(F.array(*[F.when(tried(low, pattern), rule(k, c, b)) for k, (pattern, c, b) in enumerate(TEXT_RULES)]), lambda x: x.isNotNull())


    def chosen(h: Column) -> Column:
        best = F.array_max(h)
        carried = F.try_element_at(F.filter(h, lambda x: (x["has"] == 1) & (x["p"] <= best["p"])), F.lit(1))["b"]
        n = F.size(h)
        confidence = F.when(n == 0, 0.0).otherwise(F.round(F.least(F.lit(1.0), 0.4 + n * 0.3), 3))
        sure = (n > 0) & (confidence >= threshold)
        return F.struct(F.when(sure, best["c"]).alias("category"), F.when(sure, F.coalesce(best["b"], carried)).alias("brand"), confidence.alias("confidence"), n.alias("n"))

    # the lower-case text and the matches are bound once each
    return F.element_at(F.transform(F.transform(F.array(F.coalesce(low, F.lit(""))), hits), chosen), 1)


def pair_text(texts: Column) -> Column:
    """The non-empty texts of an array, joined by spaces."""
    return F.array_join(F.filter(texts, lambda t: t.isNotNull() & (t != "")), " ")


def detect_language(text: Column) -> Column:
    """ko by Hangul, pt by accented letters, else en; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike("[가-힣ᄀ-ᇿ]"), "ko").when(t.rlike("(?iu)[ãõáéíóúâêîôûç]"), "pt").otherwise("en")


def mentions(text: Column, words: list[str]) -> Column:
    """Whether a text holds any of the words, as a substring and in any case."""
    # an array of one text: its letters are lowered once, not for each word
    low = F.array(F.lower(F.coalesce(text, F.lit(""))))
    return F.exists(low, lambda t: reduce(or_, [F.contains(t, F.lit(w)) for w in words]))


def keyword_pair_score(before_text: Column, after_text: Column, similarity: Column | None = None) -> Column:
    """struct(score, method) of the texts beside the two pictures.

    Both sides named: 0.9; both empty: 0; else the given similarity of the texts, and where that is
    missing a part of 0.3 for each named side.
    """
    b, a = mentions(before_text, BEFORE_TEXT), mentions(after_text, AFTER_TEXT)
    empty = (F.trim(F.coalesce(before_text, F.lit(""))) == "") & (F.trim(F.coalesce(after_text, F.lit(""))) == "")
    partial = F.round(0.6 * (0.5 * b.cast("int") + 0.5 * a.cast("int")), 4)
    rest = partial if similarity is None else F.coalesce(similarity, partial)
    score = F.when(empty, 0.0).when(b & a, 0.9).otherwise(rest)
    method = F.when(empty, "none").when(b & a, "keyword")
    method = method.otherwise("partial") if similarity is None else method.when(similarity.isNotNull(), "semantic").otherwise("partial")
    return F.struct(score.alias("score"), method.alias("method"))


def prompt(category: Column, brand: Column) -> Column:
    base = F.coalesce(table_lookup(PROMPTS, category), F.lit(DEFAULT_PROMPT))
    return F.when(F.coalesce(brand, F.lit("")) != "", F.concat(base, F.lit(" using "), brand)).otherwise(base)


def zones_for(category: Column) -> Column:
    """Zones that matter for a category; none for unknown ones."""
    known = F.create_map(*[x for k, v in ZONES_OF.items() for x in (F.lit(k), F.array(*[F.lit(z) for z in v]))])
    return F.coalesce(F.try_element_at(known, F.lower(category)), F.array().cast("array<string>"))


def reason_bucket(reason: Column) -> Column:
    """Stage of a reject reason, by the words before its colon."""
    head = F.substring_index(reason, ":", 1)
    has = lambda *w: F.exists(F.array(*[F.lit(x) for x in w]), lambda x: F.contains(head, x))
    return F.when(has("quality"), "quality").when(has("detection", "face"), "detection").when(has("landmark"), "landmarks").when(has("alignment"), "alignment").when(has("pose"), "pose").otherwise("other")


def quality_reason(blur: Column, uniformity: Column, brightness: Column, width: Column, height: Column, limits: dict[str, float]) -> Column:
    """First failing check of a picture in fixed order, null where all pass.

    A null or NaN measure fails no check of its own; infinite ones compare as numbers.
    """
    brightness = F.when(~F.isnan(brightness), brightness)  # Spark takes NaN for the largest number
    low, even, dark, bright = limits["min_blur"], limits["min_uniformity"], limits["min_brightness"], limits["max_brightness"]
    return (
        F.when((width < limits["min_width"]) | (height < limits["min_height"]), "resolution_too_small")
        .when(blur < low, F.format_string(f"blur_too_low:%.1f<{low}", blur))
        .when(uniformity < even, F.format_string(f"lighting_uneven:%.2f<{even}", uniformity))
        .when(brightness > bright, F.format_string(f"overexposed:%.1f>{bright}", brightness))
        .when(brightness < dark, F.format_string(f"underexposed:%.1f<{dark}", brightness))
    )
