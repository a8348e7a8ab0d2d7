from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edgelog.llm import quality as Q, shared, toxicity as X

from .helpers import awkward, none


def auc(scored, label):
    good, bad = [s for s, y in scored if y == label], [s for s, y in scored if y != label]
    return np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])


@pytest.fixture(scope="module")
def large(spark):
    base = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")


def test_toxicity_ranks_the_held_out_fold(large):
    docs, labels = large
    got = X.report(docs, labels)
    assert got.count() == docs.count()
    held = got.filter("held_out").join(labels, "doc_id").collect()
    assert auc([(r.score, r.toxic) for r in held], 1) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in held)
    told = got.join(labels, "doc_id").filter("not held_out and toxic = 1 and predicted = 1").collect()
    assert sum(bool(r.offending) for r in told) > 0.8 * len(told)


def test_noisy_or_finds_the_word_and_the_sentence():
    rng = np.random.default_rng(0)
    plain = [f"w{i}" for i in range(60)]
    texts, labels = [], []
    for i in range(300):
        sentences = [" ".join(rng.choice(plain, 6)) for _ in range(int(rng.integers(1, 12)))]
        if i % 3 == 0:
            at = int(rng.integers(0, len(sentences)))
            sentences[at] += " vile"
        texts.append(". ".join(sentences))
        labels.append(int(i % 3 == 0))
    model = X._fit(texts, np.array(labels))
    score, found = X.judge(pa.array(["w1 w2 w3. w4 Vile w5! w6", "w1 w2. " * 200, "", None]), model, True)
    assert score[0] > 0.9 and score[1] < 0.5 and score[2] == score[3] < 0.1
    assert [s["sentence"] for s in found[0]] == ["w4 Vile w5"] and found[1:] == [[], [], []]


def test_fit_holds_the_words_of_few_texts_at_once(monkeypatch):
    rng = np.random.default_rng(1)
    words = np.array([f"word{i}" for i in range(3000)])
    texts = [". ".join(" ".join(rng.choice(words, 8)) for _ in range(40)) + (" vile" if i % 4 == 0 else "") for i in range(800)]
    labels = (np.arange(800) % 4 == 0).astype(np.int64)
    monkeypatch.setattr(X, "ROUNDS", 3)
    tracemalloc.start()
    X._fit(texts, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * sum(map(len, texts))
    made = []
    for size in (1, 5000, 1 << 30):
        monkeypatch.setattr(X, "PART_BYTES", size)
        made.append(X._fit(texts[:80], labels[:80]))
    for model in made[1:]:
        assert (model.features == made[0].features).all() and (model.weights == made[0].weights).all() and model.bias == made[0].bias


def test_toxicity_of_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 0), (8, 1), (None, 1), (6, None), (2, 5), (99, 1)], "doc_id long, toxic int")
    got = X.with_score(docs, X.fit(docs, labels))
    assert got.columns == docs.columns[:-1] + ["score"] and got.count() == docs.count()
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert X.report(none(spark), labels).count() == 0
    for toxic, predicted in ((1, 1), (0, 0)):
        only = spark.createDataFrame([(1, toxic)], "doc_id long, toxic int")
        assert {r.predicted for r in X.report(docs, only.filter("doc_id = 1")).collect()} == {predicted if not X.report(docs, only).filter("doc_id = 1").first().held_out else 0}
    assert X.reject(docs, labels.limit(0)).columns == docs.columns
    assert X.reject(docs, labels.limit(0)).count() == docs.count()


def test_scores_see_the_text_only(spark, large):
    docs, labels = large
    model = X.learnt(docs, labels)
    one = X.with_score(docs.selectExpr("doc_id", "text"), model).collect()
    two = {r.doc_id: r.score for r in X.with_score(docs.selectExpr("doc_id", "text", "'z' AS lang", "'z' AS source"), model).collect()}
    assert all(two[r.doc_id] == r.score for r in one)


def test_quality_of_the_held_out_fold(large):
    docs, labels = large
    got = Q.report(docs, labels)
    assert got.count() == docs.count()
    held = got.filter("held_out").join(labels, "doc_id").collect()
    assert auc([(r.score, r.quality) for r in held], 1) > 0.95
    assert np.mean([r.predicted == r.quality for r in held]) > 0.93


@pytest.mark.parametrize("module, label", [(X, "toxic"), (Q, "quality")])
def test_one_huge_text_does_not_crowd_out_a_label(spark, module, label):
    rows = [(i, f"{'vile bad' if i % 2 else 'kind good'} words number {i}", "s", "l") for i in range(80)]
    first = spark.range(80).orderBy(F.xxhash64("id")).first().id
    rows[first] = (first, "huge words " * 20000, "s", "l")
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], f"doc_id long, {label} int")
    model = module.fit(docs, labels, size=100_000)
    probe = spark.createDataFrame([(1, "vile bad words", "s", "l"), (2, "kind good words", "s", "l")], docs.schema)
    scored = (X.with_score if module is X else Q.with_scores)(probe, model).collect()
    score = {r.doc_id: r.score for r in scored}
    assert score[1] > 0.5 > score[2]
    told = labels.withColumnRenamed(label, "y")
    chosen = shared.sample(docs, told, "y", ["text"], 600).collect()
    assert {r.y for r in chosen} == {0, 1} and sum(len(r.text) for r in chosen) <= 600 and first not in {r.doc_id for r in chosen}
    only = shared.sample(docs.filter(f"doc_id = {first} or doc_id % 2 <> {first % 2}"), told, "y", ["text"], 600).collect()
    assert {r.y for r in only} == {0, 1}
    assert shared.shares([5, 100, 100], 65) == [5, 30, 30]


def test_views_teach_each_other():
    """Only the other view can tell the unlabelled rows of this one."""
    n = 400
    rng = np.random.default_rng(2)
    label = np.arange(n) % 2
    dense = lambda *cols: Q.Rows(np.repeat(np.arange(len(cols)), n), np.concatenate(cols), np.tile(np.arange(n), len(cols)), n)
    one = dense(2.0 * label - 1 + 0.3 * rng.normal(size=n), np.ones(n))
    two = dense(1.0 - 2 * label + 0.3 * rng.normal(size=n), np.ones(n))
    told = np.where(np.arange(n) < 40, label, -1)
    models, handed = Q.cotrain([one, two], [2, 2], told)
    assert (handed > 0).all()
    for view, model in zip((one, two), models):
        assert np.mean((model.a * view.margin(model.weights) + model.b > 0) == label) > 0.97


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 0), (8, 1), (None, 1), (6, None), (2, 7), (7, 1), (5, 0)], "doc_id long, quality int")
    got = Q.with_scores(docs, Q.fit(docs, labels))
    assert got.count() == docs.count() and got.columns == docs.columns[:-1] + list(Q.SCORES)
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert Q.report(none(spark), labels).count() == 0
    assert {r.score for r in Q.report(docs, labels.limit(0)).collect()} == {0.5}
