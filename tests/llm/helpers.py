"""Small tables with every awkward case, and plain definitions to hold operators against."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"
LONG = "lorem ipsum dolor sit amet " * 8000

AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog today", "en", "a", 1, "x"),
    (2, "the  quick\tbrown fox jumps over the lazy dog\ntoday", "en", "a", 1, "x"),
    (3, None, None, None, None, None),
    (4, "", "en", "b", 0, None),
    (5, " \n\t ", "en", "b", 3, None),
    (6, LONG, "en", "b", len(LONG), ""),
    (6, LONG, "en", "b", len(LONG), ""),
    (None, "the quick brown fox jumps over the lazy dog today", "en", "a", 1, "x"),
    (7, "é ü 汉字 😀 \x00 end", "xx", "c", 9, "y"),
    (8, "one", "en", "c", 3, "y"),
]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


def none(spark):
    return spark.createDataFrame([], DOCS)


def words(text: str | None) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
