"""Text normalisation shared by the text operators of this subpackage.

Pure functions on Python strings, meant to be called inside Arrow batches.
They undo what a page does to wording without changing it: markup, entities,
invisible characters, end-of-line hyphens, letter case, accents, width forms
and look-alike letters of other scripts.
"""

from __future__ import annotations

import html
import re
import unicodedata

# Characters that print nothing: soft hyphen, zero-width spaces and joiners,
# direction marks, word joiner and byte-order mark.
INVISIBLE = re.compile("[­͏؜᠎​-‏‪-‮⁠-⁤︀-️﻿]")
BLOCK_TAG = re.compile(
    r"<\s*/?\s*(?:p|div|br|hr|li|ul|ol|td|th|tr|table|h[1-6]|section|article|blockquote|dd|dt|dl|pre)\b[^<>]{0,400}>", re.I
)
INLINE_TAG = re.compile(r"</?[A-Za-z!][^<>]{0,400}>")
LINE_HYPHEN = re.compile(r"(?<=[^\W\d_])[-‐‑]\s*\n\s*(?=[^\W\d_])")
MARKS = re.compile("[̀-ͯ]")
FOREIGN = re.compile("[Ͱ-ԯ]")
WORD = re.compile(r"[^\W_]+")

# Lower-case Cyrillic and Greek letters that look like Latin ones.
LOOKALIKE = str.maketrans({
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i",
    "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t",
    "у": "y", "х": "x", "ԛ": "q", "ԝ": "w", "г": "r", "п": "n",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "γ": "y",
})


def fold(text: str) -> str:
    """Case, width, accents and look-alike letters folded; other characters kept."""
    if text.isascii():
        return text.lower()
    text = MARKS.sub("", unicodedata.normalize("NFKD", text).casefold())
    if FOREIGN.search(text):
        text = text.translate(LOOKALIKE)
    return unicodedata.normalize("NFC", text)


def plain(text: str | None) -> str:
    """Text without markup, entities, invisible characters and line hyphens."""
    if not text:
        return ""
    if "<" in text:
        text = INLINE_TAG.sub("", BLOCK_TAG.sub(" ", text))
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = INVISIBLE.sub("", text)
    if "\n" in text:
        text = LINE_HYPHEN.sub("", text)
    return text


def words(text: str | None) -> list[str]:
    """Folded words of a text; an empty list for null or wordless text."""
    return WORD.findall(fold(plain(text)))
