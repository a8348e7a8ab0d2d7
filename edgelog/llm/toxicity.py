"""Toxicity by multiple-instance learning: sentence scores under document labels.

Only whole documents are labelled. A sentence's score is a logistic function of the words
and word beginnings it holds; a document's score is the noisy-or of its sentences: one
offending sentence is enough, many harmless ones leave it low. The weights are those that
make the noisy-or fit the labels, and the sentences that score high are what to show.

The model is fitted in one task from a bounded sample of labelled rows (``SAMPLE_ROWS``,
``SAMPLE_BYTES``); it holds at most ``FEATURES`` weights. Scoring reads every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from edgelog.llm import shared

#: Labelled documents to learn from: this many of each label at most, and bytes in all.
SAMPLE_ROWS = 5000
SAMPLE_BYTES = 10 << 20
#: Features a model keeps, and documents a feature must be seen in.
FEATURES = 8192
MIN_DOCS = 3
ROUNDS = 300
RATE = 0.1
DECAY = 1e-3
#: Standard deviations from which a feature starts with a share of its log odds, and that share.
CLEAR, START = 4.0, 0.5
#: A sentence is offending, and a document toxic, from this score on.
THRESHOLD = 0.5
#: Word beginnings that are features besides the word, in bytes, and the salt of each.
BEGINNINGS = (4, 5, 6)
#: Bytes of text that are split at once; what that holds is about 60 times as much.
PART_BYTES = 1 << 18
#: Bytes that end a sentence.
BREAKS = b".!?\n"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True

OFFENDING = T.ArrayType(T.StructType([T.StructField("sentence", T.StringType()), T.StructField("score", T.DoubleType())]))


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float


@dataclass
class Sentences:
    """Sentences of a batch: the row of each, where it lies, and hashed features by sentence."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    sentence: np.ndarray  # of each feature
    feature: np.ndarray
    data: np.ndarray


def split(texts: pa.Array) -> Sentences:
    raw, offsets = shared.text_bytes(texts)
    data = shared.LOWER[raw]
    starts, ends = shared.word_spans(data, offsets)
    cut = _BREAK[data]
    cut[offsets[1:-1]] = True  # a row starts a sentence
    number = np.cumsum(cut)[starts] if len(starts) else np.zeros(0, np.int64)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = number[1:] != number[:-1]
    if len(starts):  # a row's first word may stand right on the row's first byte
        fresh |= np.isin(starts, offsets[:-1])
    head = np.flatnonzero(fresh)
    owner = np.cumsum(fresh) - 1
    row = np.searchsorted(offsets, starts[head], side="right") - 1
    kinds = [shared.word_hashes(data, starts, ends)]
    long_enough = [np.arange(len(starts))]
    for size in BEGINNINGS:
        has = np.flatnonzero(ends - starts >= size)
        kinds.append(shared.word_hashes(data, starts[has], starts[has] + size) ^ np.uint64(size))
        long_enough.append(has)
    which = np.concatenate(long_enough)
    last = np.append(head[1:], len(starts)) - 1
    return Sentences(row, starts[head], ends[last] if len(head) else head, owner[which], np.concatenate(kinds), raw)


def _fit(texts: list[str | None], labels: np.ndarray) -> Model:
    """Gradient steps on the likelihood of the labels under the noisy-or."""
    none = Model(np.zeros(0, np.uint64), np.zeros(0), -20.0)
    if not len(labels) or labels.min() == labels.max():
        return none if not len(labels) or labels[0] == 0 else Model(none.features, none.weights, 20.0)
    parts = shared.slices(pa.array(texts, pa.string()), PART_BYTES)
    features, seen, toxic = _counted(parts, labels)
    share = labels.mean()
    spread = (toxic - share * seen) / np.sqrt(seen * share * (1 - share))
    usable = np.flatnonzero(seen >= MIN_DOCS)
    chosen = np.sort(usable[np.argsort(-np.abs(spread[usable]), kind="stable")[:FEATURES]])
    # The noisy-or stops teaching once a document is explained, so words that mostly come
    # together with stronger ones would stay unlearnt: each starts from its own log odds.
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    odds = np.log((toxic + 0.5) / (n1 + 1)) - np.log((seen - toxic + 0.5) / (n0 + 1))
    start = np.where(spread >= CLEAR, START * np.maximum(odds, 0), 0.0)
    model = Model(features[chosen], start[chosen], -8.0)
    sentence, slot, doc = _placed(parts, model)
    n_sentences, n_docs = len(doc), len(texts)
    step1, step2 = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    even = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (len(labels) - labels.sum()))
    for t in range(1, ROUNDS + 1):
        s = model.bias + np.bincount(sentence, model.weights[slot], n_sentences)
        p = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
        log_clean = -np.bincount(doc, np.logaddexp(0, s), n_docs)
        clean = np.exp(log_clean)
        pull = np.where(labels == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * even
        g = pull[doc] * p
        grad = np.append(np.bincount(slot, g[sentence], len(chosen)), g.sum())
        step1 = 0.9 * step1 + 0.1 * grad
        step2 = 0.99 * step2 + 0.01 * grad**2
        # the offset keeps weights still whose documents are all explained
        move = RATE * (step1 / (1 - 0.9**t)) / (np.sqrt(step2 / (1 - 0.99**t)) + 1e-5)
        model.weights = (1 - RATE * DECAY) * model.weights - move[:-1]
        model.bias -= move[-1]
    return model


def _counted(parts: list[pa.Array], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features in order, documents that hold each, and those of them labelled 1."""
    features, seen, toxic = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)
    first = 0
    for part in parts:
        bags = split(part)
        doc_of = bags.row[bags.sentence]
        _, once = np.unique(bags.feature * _ODD + doc_of.astype(np.uint64), return_index=True)
        found, index, n = np.unique(bags.feature[once], return_inverse=True, return_counts=True)
        marked = np.bincount(index, labels[first + doc_of[once]], len(found))
        features, index = np.unique(np.concatenate([features, found]), return_inverse=True)
        seen = np.bincount(index, np.concatenate([seen, n]), len(features)).astype(np.int64)
        toxic = np.bincount(index, np.concatenate([toxic, marked]), len(features))
        first += len(part)
    return features, seen, toxic


def _placed(parts: list[pa.Array], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sentence and place in the model of each known feature, as :func:`_known`, and the document of each sentence."""
    sentences, slots, docs, first, held = [], [], [], 0, 0
    for part in parts:
        bags = split(part)
        sentence, slot = _known(bags, model)
        sentences.append(sentence + held)
        slots.append(slot)
        docs.append(bags.row + first)
        first, held = first + len(part), held + len(bags.row)
    return tuple(np.concatenate([*x, np.zeros(0, np.int64)]) for x in (sentences, slots, docs))


def _known(bags: Sentences, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sentence and place in the model of each known feature, once per sentence."""
    if not len(model.features):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(model.features, bags.feature), len(model.features) - 1)
    known = np.flatnonzero(model.features[at] == bags.feature)
    both = np.unique(bags.sentence[known] * len(model.features) + at[known])
    return both // len(model.features), both % len(model.features)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Model:
    """Learn from the labelled documents of ``docs``: ``labels`` has ``doc_id`` and ``toxic`` 0 or 1.

    At most ``rows`` of each label take part, chosen by a hash of the id, and ``size`` bytes
    of text in all, as :func:`shared.sample` deals them to the labels; equal texts count
    once. Other labels, and null ids, are left out. Without one of the two labels every document gets the score of the other one,
    without any label 0.
    """
    usable = labels.filter("doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    some = [usable.filter(F.col("toxic") == y).orderBy(*order).limit(rows) for y in (0, 1)]
    sample = shared.sample(docs, some[0].union(some[1]), "toxic", ["text"], size)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[str, int] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                texts.setdefault(text or "", toxic)
        model = _fit(list(texts), np.array(list(texts.values()), np.int64))
        parts = [model.features.tobytes(), model.weights.astype(np.float64).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([*parts, model.bias], [pa.binary(), pa.binary(), pa.float64()])], names=["f", "w", "b"])

    ordered = sample.repartition(1).sortWithinPartitions(*order)
    found = ordered.mapInArrow(shared.released(learn), "f binary, w binary, b double").collect()
    if not found:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -20.0)
    return Model(np.frombuffer(found[0].f, np.uint64), np.frombuffer(found[0].w, np.float64), found[0].b)


def judge(texts: pa.Array, model: Model, locate: bool) -> tuple[np.ndarray, list[list[dict]] | None]:
    bags = split(texts)
    sentence, slot = _known(bags, model)
    s = model.bias + np.bincount(sentence, model.weights[slot], len(bags.row))
    doubt = np.bincount(bags.row, np.logaddexp(0, s), len(texts))
    # a text without words is one sentence without features
    empty = np.bincount(bags.row, minlength=len(texts)) == 0
    doubt[empty] = np.logaddexp(0, model.bias)
    score = -np.expm1(-doubt)
    if not locate:
        return score, None
    found: list[list[dict]] = [[] for _ in range(len(texts))]
    p = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
    for k in np.flatnonzero(p >= THRESHOLD):
        words = bags.data[bags.start[k] : bags.end[k]].tobytes().decode("utf-8", "replace")
        found[bags.row[k]].append({"sentence": words, "score": float(p[k])})
    return score, found


def with_score(docs: DataFrame, model: Model, score: str = "score", offending: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with its toxicity in ``score`` (0 to 1) and the sentences to blame in ``offending``.

    Scores depend on the text alone. Null, empty and wordless texts score as one sentence
    without features. Rows and other columns stay as they are; columns of the same names are replaced.
    """
    new = {score: T.DoubleType()} | ({offending: OFFENDING} if offending else {})
    kept = [f for f in docs.schema.fields if f.name not in new]
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t in new.items())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [judge(part, model, offending is not None) for part in shared.slices(batch.column(text), PART_BYTES)]
            made = np.concatenate([score for score, _ in parts] + [np.zeros(0)])
            found = [row for _, rows in parts for row in rows or []]
            columns = [batch.column(f.name).cast(f.type) for f in list(arrow)[: len(kept)]]
            columns.append(pa.array(made))
            if offending:
                columns.append(pa.array(found, arrow.field(offending).type))
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    shared.bound_batches(docs.sparkSession)
    return docs.mapInArrow(shared.released(run), schema)


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learnt(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(docs, labels.filter(~held_out(F.col("doc_id"))))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = with_score(docs.select("doc_id", "text"), learnt(docs, labels), offending="offending")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending",
    )


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that score below the threshold, columns unchanged."""
    score = "score" + "_" * max((len(c) for c in docs.columns if c.startswith("score")), default=0)
    scored = with_score(docs, learnt(docs, labels), score)
    return scored.filter(F.col(f"`{score}`") < THRESHOLD).select(*(F.col(f"`{c}`") for c in docs.columns))
