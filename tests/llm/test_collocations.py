from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgelog.llm import collocations as C

from .helpers import awkward, none

ALL_WORDS, ALL_PAIRS = np.full(1 << C.BITS - 6, -1), np.full(1 << 14, 255, np.uint8)
COLUMNS = "doc_id long, text string, lang string"


def brute(rows, least, top, percent=100, size=5):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", low(text or "")):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(size, len(words) - i) + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    frequent = {p: f for p, f in counts.items() if f >= least}
    out = []
    for (lang, p), a in frequent.items():
        if len(p) < 2:
            continue
        inside = any(
            l2 == lang and len(q) > len(p) and 100 * f >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (l2, q), f in frequent.items()
        )
        if not inside:
            cuts = [(1000 * a * total[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], total[lang], score))
    ranked = []
    for lang in {o[0] for o in out}:
        order = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        ranked += [(lang, at, *o[1:]) for at, o in enumerate(order[:top], 1)]
    return sorted(ranked)


def got(docs, **options):
    return sorted(map(tuple, C.collocations(docs, **options).collect()))


def pairs(docs):
    return [(r.text, r.lang) for r in docs.collect()]


TEXTS = [
    ("The QUICK brown fox. The quick\tbrown  fox, jumps! the quick brown fox jumps over it", "en"),
    ("a a a a a a a a a", "en"), ("a a a a a a a a a", None), ("a a a a a a a a a", "und"), ("a a a a a a a a a", "x\x00y"),
    ("É é É é\x0bé é\x00é é x é x é x", "fr"), ("\x1c \x1c \x1c \x1c", "fr"), ("\xff y \xff y \xff y", "fr"), ("", "en"), (None, "en"), (" .,;: ", "de"),
]


@pytest.mark.parametrize("least, top, percent", [(1, 2000, 100), (2, 5, 100), (2, 2000, 50), (3, 1, 100)])
def test_equals_counting_every_ngram(spark, least, top, percent):
    docs = spark.createDataFrame([(i, *t) for i, t in enumerate(TEXTS)], COLUMNS)
    assert got(docs, least=least, top=top, percent=percent) == brute(TEXTS, least, top, percent)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got(docs, least=20, top=300) == brute(pairs(docs), 20, 300)


def test_awkward_rows_clashing_columns_and_empty_table(spark):
    docs = awkward(spark).withColumnRenamed("score", "w1").withColumnRenamed("source", "key").withColumnRenamed("n_chars", "n")
    assert got(docs, least=2, top=2000) == brute(pairs(docs), 2, 2000)
    assert got(none(spark), least=1, top=10) == []


def test_small_chunks_and_hot_words_change_nothing(spark, sf, monkeypatch):
    """Windows cross chunks, words are counted in parts, and runs of hot words make longer keys."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).coalesce(2)
    want = brute(pairs(docs), 5, 100)
    for chunk, words, hot in ((7, 50, 1), (1000, 10_000, 100_000), (997, 400_000, 20)):
        for name, value in (("CHUNK", chunk), ("PART", max(3, chunk // 3)), ("MAX_WORDS", words), ("HOT", hot)):
            monkeypatch.setattr(C, name, value)
        if chunk > 7:
            assert got(docs, least=5, top=100) == want
    made = C.Windows(ALL_WORDS, ALL_PAIRS, set(), 0)
    monkeypatch.setattr(C, "CHUNK", 3)
    rows = [b for b in made.add("en", b"a b c d e f. g h")] + list(made.flush())
    full = Counter()
    for batch in rows:
        for row in batch.to_pylist():
            full[tuple(row[f"w{i}"] for i in range(1, 6))] += row["n"]
    k = {w: C.key("en", w.encode(), 0) for w in "abcdefgh"}
    spelled = lambda text: tuple([k[w] for w in text] + [0] * (5 - len(text)))
    assert full == Counter(map(spelled, ("abcde", "bcdef", "cdef", "def", "ef", "f", "gh", "h")))


def test_words_with_one_hash_start_again_with_another_seed(spark, monkeypatch):
    plain, seeds = C.key, []

    def vocabulary(docs, seed=0):
        seeds.append(seed)
        words = real(docs, seed)
        return words if seed else words.withColumn("key", F.lit(5).cast("long"))

    real = C.vocabulary
    monkeypatch.setattr(C, "vocabulary", vocabulary)
    docs = spark.createDataFrame([(1, "a b a b a b", "en")], COLUMNS)
    assert got(docs, least=2, top=9) == brute([("a b a b a b", "en")], 2, 9) and seeds == [0, 1] and plain is C.key


def test_scores_beyond_64_bits_are_exact(spark):
    big = 90_000_000_000_000_001
    found = spark.createDataFrame([([1, 2], big), ([1], big + 2), ([2], big + 4)], "p array<long>, f long")
    lang = spark.createDataFrame([(1, "en", big + 7)], "key long, lang string, n long")
    row = C.scored(found, lang).first()
    assert row.score == 1000 * big * (big + 7) // ((big + 2) * (big + 4))


def test_a_hot_word_is_spread(spark):
    """A third of all windows begin with one pair; their keys reach past it."""
    text = " ".join(f"hot pair w{i}" for i in range(4000))
    docs = spark.createDataFrame([(1, text, "en")], COLUMNS)
    hot = {C.key("en", w, 0) for w in (b"hot", b"pair")}
    made = C.windows(docs, ALL_WORDS, ALL_PAIRS, hot, 0)
    rows = made.filter(F.col("w1") == C.key("en", b"hot", 0)).select("free").distinct().collect()
    assert [r.free for r in rows] == [3]


def test_pairs_and_triples_below_the_threshold_are_cut_and_no_others(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bits = C.counters(docs, ALL_WORDS, 0, 80_000, 30).reshape(2, -1)
    for size in (2, 3):
        counts = Counter()
        for text, lang in pairs(docs):
            for piece in re.split("[.,;:!?\n-\r]", (text or "").encode().lower().decode()):
                words = [w for w in re.split("[ \t]+", piece) if w]
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
        keys = {p: np.array([*(C.key(p[0], w.encode(), 0) for w in p[1:]), 0][:3]) for p in counts}
        told = {p: C._counters(k, 16)[size - 2][0] for p, k in keys.items()}
        passes = {p for p, at in told.items() if bits[size - 2][at >> 3] >> (at & 7) & 1}
        assert {p for p, n in counts.items() if n >= 30} <= passes and len(passes) < 0.3 * len(counts)


def test_packed_runs_read_back():
    rng = np.random.default_rng(3)
    for size in (1, 2, 1000, 1 << C.RUN_BITS):
        at = np.sort(rng.choice(1 << C.RUN_BITS, size, replace=False))
        n = rng.integers(1, 65536, size).astype("<u2")
        places, counts = C._unpack(C._pack(at, n))
        assert (places == at).all() and (counts == n).all()
