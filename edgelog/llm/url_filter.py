"""URL filters: host and path rules, and exact membership in a list by a Bloom filter cascade.

The first level is a Bloom filter of the listed keys. Over the corpus's complete set of
keys its false positives are known, so the second level encodes those, the third the
listed keys that the second wrongly holds, and so on until a level errs on none. Asking
the levels in turn then answers exactly for every key of the corpus. A level is an array
of words that reaches the tasks as a scalar subquery: rows are neither joined nor shuffled.

The filters grow with the list, about ``1.44 * log2(others / listed)`` bits a listed key,
not with the corpus; ``MAX_BYTES`` bounds what is sent, beyond it the build refuses.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, log, log2, sqrt
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from edgelog.llm import shared

MAX_BYTES = 1 << 30
#: Words of a host name's labels, split at hyphens, that put the host on the list.
UNWANTED = ("ads", "adult", "bets", "casino", "cheap", "pills", "spam")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The production rules.
RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    below = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
    return below & F.startswith(path, F.lit(rule.path))


def best_rule(rules: Sequence[Rule], host: Column, path: Column, what: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, else null; of equal length the first."""
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        out = F.when(_fits(rule, host, path), F.lit(getattr(rule, what))).otherwise(out)
    return out


@dataclass
class Level:
    """A Bloom filter: its words in one row, bits, hash functions, and the salt of its hashes."""

    words: DataFrame
    bits: int
    hashes: int
    salt: int

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.salt), F.lit(i), key), F.lit(self.bits).cast("long")) for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words, out = self.words.scalar(), F.lit(True)
        for place in self.places(key):
            word = F.element_at(words, (F.shiftright(place, 6) + 1).cast("int"))
            out = out & (F.getbit(word, place.bitwiseAND(63).cast("int")) == 1)
        return out


def _level(keys: DataFrame, bits: int, hashes: int, salt: int) -> Level:
    """Encode column ``key``. Bits meet by word, partial sums first; a row of words is written."""
    if bits // 8 > MAX_BYTES:
        raise ValueError(f"a filter of {bits // 8} bytes exceeds {MAX_BYTES}")
    level = Level(keys, bits, hashes, salt)
    place = F.explode(F.array(*level.places(F.col("key")))).alias("place")
    marked = keys.select(place).select(F.shiftright("place", 6).alias("at"), F.expr("shiftleft(1L, int(place & 63))").alias("word"))
    empty = keys.sparkSession.range(ceil(bits / 64)).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word"))
    words = marked.unionByName(empty).groupBy("at").agg(F.bit_or("word").alias("word"))
    row = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]).alias("words"))
    level.words = shared.stored(row, "filter")
    return level


class Cascade:
    """Exact membership for the keys it was built over."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def listed(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[i].holds(key), out).otherwise(F.lit(i % 2 == 1))
        return out


def build(universe: DataFrame, listed: Column) -> Cascade:
    """Cascade over column ``key`` of ``universe``, which may repeat keys; ``listed`` marks keys on the list.

    Null keys count as empty ones. With nothing listed no level is made and no key is a member.
    """
    keys = universe.select(F.coalesce("key", F.lit("")).alias("key")).distinct()
    keys = shared.stored(keys.select("key", listed.alias("listed")), "keys")
    inside, outside = keys.filter("listed").select("key"), keys.filter("not coalesce(listed, false)").select("key")
    levels: list[Level] = []
    n_in, n_out = inside.count(), outside.count()
    held, n, others = inside, n_in, outside
    while n:
        rate = min(0.5, sqrt(0.5) * n_in / max(1, n_out)) if not levels else 0.5
        bits = max(64, ceil(n * log2(1 / rate) / log(2)))
        level = _level(held, bits, max(1, round(log2(1 / rate))), len(levels))
        levels.append(level)
        # what this level wrongly holds of the other side is what the next one encodes
        wrong = shared.stored(others.filter(level.holds(F.col("key"))), "wrong")
        held, n, others = wrong, wrong.count(), held
    return Cascade(levels)


def unwanted(host: Column) -> Column:
    """The list: hosts with one of the ``UNWANTED`` words between dots and hyphens."""
    return host.rlike(r"(^|[.-])(" + "|".join(UNWANTED) + r")([.-]|$)")


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    The longest fitting rule decides; without one, hosts on the list are blocked and all
    others allowed. Null urls and such without ``://`` have an empty host and path and
    are allowed. Rows, repeated ones too, and other columns stay; columns with those four
    names are replaced.
    """
    own = ("host", "path", "rule", "verdict")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in own]
    parsed = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    cascade = build(parsed.select(F.col("host").alias("key")), unwanted(F.col("key")))
    host, path = F.col("host"), F.col("path")
    method = F.when(cascade.listed(host), "block").otherwise("allow")
    return parsed.select(
        "*", best_rule(rules, host, path, "text").alias("rule"),
        F.coalesce(best_rule(rules, host, path, "verdict"), method).alias("verdict"),
    )


def report(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")
