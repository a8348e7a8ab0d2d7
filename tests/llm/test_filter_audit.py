from __future__ import annotations

import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgelog.llm import filter_audit as A

from .helpers import LONG, awkward, none

LABELS = "doc_id long, quality int, toxic int"


def fails(rows):
    """The five conditions, word for word."""
    out = []
    for doc, text, lang in rows:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        before = [d for d, t, _ in rows if (t or "") == text and d is not None and doc is not None and d < doc]
        told = [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            re.search("[#$%&*|]", text) is not None, bool(before),
        ]
        out.append((doc, lang or "", {f for f, no in zip("ABCDE", told) if no}))
    return out


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = defaultdict(list)
    for doc, part, failed in fails(rows):
        parts[part].append((doc, failed))
    out = []
    for part, docs in parts.items():
        shapley, made = defaultdict(int), []
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                all_fail = [x for x in docs if f in x[1]]
                made.append(
                    (part, "".join(order), step, len(left), len(gone), len(all_fail) - len(gone), sum(x[1] == {f} for x in docs),
                     sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone), f)
                )
        out += [(*m[:-1], shapley[m[-1]]) for m in made]
    return sorted(out)


def got(docs, labels):
    return sorted(map(tuple, A.report(docs, labels).collect()))


ROWS = [
    (10, "A B C", "en"), (3, "A B C", "fr"), (3, "A B C", "en"), (None, "A B C", "en"), (11, " ".join(f"w{i}" for i in range(100)), "en"),
    (12, " ".join(f"w{i % 80}" for i in range(100)), "en"), (13, " ".join(f"w{i % 79}" for i in range(100)), "en"), (14, "a|b " + LONG, None),
    (15, "\x1c Ünï " * 120, ""), (16, "A" + "b" * 9, "en"), (17, "AB" + "c" * 9, "en"), (18, None, None), (19, "", ""), (20, "", "en"),
]
SAID = [(10, 1, 1), (10, 0, 0), (3, 0, 1), (3, None, None), (99, 1, 1), (None, 1, 1), (12, 1, 0), (20, 2, 1)]


def test_equals_a_replay_of_every_order(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    assert got(docs, spark.createDataFrame(SAID, LABELS)) == brute(ROWS, SAID)


def test_awkward_rows_clashing_columns_and_empty_tables(spark):
    docs = awkward(spark).withColumnRenamed("score", "mask").withColumnRenamed("source", "digest").withColumnRenamed("n_chars", "part")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert got(docs, spark.createDataFrame([], LABELS)) == brute(rows, [])
    assert got(none(spark), spark.createDataFrame(SAID, LABELS)) == []


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert got(docs, labels) == brute(rows, [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])


def test_walk_toggles_one_filter_at_a_time():
    rng = np.random.default_rng(1)
    mask, counts = np.arange(64), rng.integers(0, 100, (64, 2))
    states = A.walk(mask, counts, 6)
    for subset in range(64):
        assert (states[subset] == counts[mask & subset == 0].sum(0)).all()


def test_any_filters_and_parts(spark):
    """The walk takes other filters than the five: cells of three, without weights."""
    cell = spark.createDataFrame([("p", 0, 5), ("p", 3, 2), ("p", 6, 1)], "part string, mask int, docs long")
    state = {r.subset: r.docs for r in A.states(cell, 3, []).collect()}
    assert state == {0: 8, 1: 6, 2: 5, 3: 5, 4: 7, 5: 5, 6: 5, 7: 5}
    step = A.steps(A.states(cell, 3, []), "XYZ", []).filter("filter_order = 'YXZ'").orderBy("step")
    assert [(r.kept, r.removed, r.redundant, r.unique_fails) for r in step.collect()] == [(5, 3, 0, 0), (5, 0, 2, 0), (5, 0, 1, 0)]


def test_one_group_of_copies(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("en").alias("lang"))
    assert A.masks(docs).filter("mask & 16 = 16").count() == 2999


@pytest.mark.parametrize("text", ["", "a" * (3 << 20), "a b " * (1 << 19)])
def test_long_texts_are_read_whole(text):
    words = text.split()
    assert A.failures(text.encode()) == (len(words) < 100) + 2 * (100 * len(set(words)) < 80 * len(words))
