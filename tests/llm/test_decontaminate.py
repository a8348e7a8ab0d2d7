from __future__ import annotations

import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from edgelog.llm import decontaminate as D, shared

from .helpers import awkward, none, words

ITEMS = "item_id long, text string"


def brute(docs, items, n=10):
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (items_ := windows.get(tuple(w[k : k + size]))) is not None:
                    found |= items_
                    hit.update(range(k, k + size))
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def report(docs, items):
    return sorted((tuple(r) for r in D.report(docs, items).collect()), key=repr)


def test_report_matches_brute_force(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert report(docs, items) == brute(rows, [tuple(r) for r in items.select("item_id", "text").collect()])


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_awkward_rows_in_any_blocks(spark, block_bytes, monkeypatch):
    items = [
        (10, "Quick brown fox"), (11, "lorem ipsum dolor sit amet lorem ipsum dolor sit amet lorem"), (12, None), (13, ""), (14, "one"),
        (14, "汉字 😀"), (None, "lazy dog today"), (15, "the quick brown fox jumps over the lazy cat today and more words"),
    ]
    docs = awkward(spark)
    monkeypatch.setattr(D.with_matches, "__defaults__", (*D.with_matches.__defaults__[:-1], block_bytes))
    assert report(docs, spark.createDataFrame(items, ITEMS)) == brute([(r.doc_id, r.text) for r in docs.collect()], items)


def test_random_texts_of_few_words(spark):
    rng = np.random.default_rng(5)
    text = lambda n: " ".join(rng.choice(list("abcd"), n))
    docs = [(i, text(int(rng.integers(0, 300)))) for i in range(60)]
    items = [(i, text(int(rng.integers(1, 40)))) for i in range(40)] + [(99, docs[3][1])]
    made = spark.createDataFrame(docs, "doc_id long, text string").repartition(1)
    assert report(made, spark.createDataFrame(items, ITEMS)) == brute(docs, items)


def test_longest_match_and_its_place(spark):
    docs = spark.createDataFrame([(1, "x y a b c d e f g h i j k l z"), (2, "b c d e f g h i j k q")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "s a b c d e f g h i j k l t")], ITEMS)
    best = D.longest_by_item(D.with_matches(docs, items)).first()
    assert (best.item, best.doc, best.item_word, best.doc_word, best.length) == ("5", 1, 1, 2, 12)


def test_decontaminate_keeps_columns_and_clean_rows(spark):
    docs = awkward(spark).withColumnRenamed("score", "found")
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog")], ITEMS)
    left = D.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect())) == [3, 4, 5, 6, 6, 7, 8]
    assert D.decontaminate(none(spark), items).count() == 0
    assert D.decontaminate(docs, items.limit(0)).count() == docs.count()


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 4, 500)
    array = D.SuffixArray(ids, 3, 40)
    tails = [tuple(ids[i : i + 40][: (list(ids[i : i + 40]) + [0]).index(0)]) for i in array.at]
    assert tails == sorted(tails) and len(tails) == (ids > 0).sum()


def test_a_shard_takes_little_memory():
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 5000, 2000)) for _ in range(540)]
    block = D.make_block([(i, t[:400]) for i, t in enumerate(texts[:40])], 10)
    tracemalloc.start()
    hits = [len(cut) for part in shared.slices(pa.array(texts), D.SHARD_BYTES) for cut in D.search_shard(part, block)[1]]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(bool, hits)) == 40
    assert peak < 40 << 20  # 117 MB in shards of 6 MB
