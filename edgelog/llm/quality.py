"""Quality by co-training two views of a document.

The content view sees the words of the text. The metadata view sees what surrounds them:
source, language, sizes, and shares of kinds of characters. Each view is a logistic
classifier fitted on the labelled rows of a bounded sample; then, for some rounds, each
gives the unlabelled rows it is most sure of, with its label, to the other view to learn
from. At the end both views are calibrated on labelled rows that neither has learnt from,
and their calibrated log odds are combined into one score for every document.

The model is fitted in one task (``SAMPLE_ROWS``, ``SAMPLE_BYTES``); scoring reads every
whole text, with exact counts of its words and characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from edgelog.llm import shared

#: Rows of the sample: of each label, and without a label; and bytes of their texts in all.
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 16 << 20
#: Buckets of the hashed words, and of the hashed source and language.
WORDS, PLACES = 1 << 15, 64
ROUNDS = 4
#: Rows a view hands over in a round, as a share of the unlabelled ones, and its least sureness.
HANDED, SURE = 0.1, 0.9
STEPS, RATE, L2 = 150, 0.1, 1e-3
#: Every so many labelled rows one is kept for calibration.
CALIBRATION = 4
THRESHOLD = 0.5

#: Salt of the marks between words.
_GAP = np.uint64(0xA5A5A5A5A5A5A5A5)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_LETTER = shared.WORD & ~_DIGIT
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
#: Kinds of characters whose shares are metadata.
_KINDS = np.stack([_SPACE, _DIGIT, _LETTER, _UPPER, np.arange(256) == 10, ~_SPACE & ~_DIGIT & ~_LETTER]).astype(np.int64)


@dataclass
class View:
    """Logistic model with its calibration ``a * margin + b``."""

    weights: np.ndarray
    a: float = 1.0
    b: float = 0.0


@dataclass
class Rows:
    """Sparse rows: feature, value and row of each entry."""

    feature: np.ndarray
    value: np.ndarray
    row: np.ndarray
    n: int

    def margin(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.feature] * self.value, self.n)


def content(texts: pa.Array) -> Rows:
    """Log counts of hashed words and of the marks between them, each row of length one, and a constant."""
    data, offsets = shared.text_bytes(texts)
    data = shared.LOWER[data]
    starts, ends = shared.word_spans(data, offsets)
    row = np.searchsorted(offsets, starts, side="right") - 1
    hashes = shared.word_hashes(data, starts, ends)
    gap = np.flatnonzero((row[1:] == row[:-1]) & (starts[1:] - ends[:-1] <= 8))
    marks = shared.word_hashes(data, ends[gap], starts[gap + 1]) ^ _GAP
    row = np.append(row, row[gap])
    bucket = (np.append(hashes, marks) >> np.uint64(40)).astype(np.int64) % WORDS
    both, count = np.unique(row * WORDS + bucket, return_counts=True)
    row, bucket = both // WORDS, both % WORDS
    value = np.log1p(count)
    size = np.sqrt(np.bincount(row, value**2, len(texts)))
    every = np.arange(len(texts))
    return Rows(np.append(bucket, np.full(len(texts), WORDS)), np.append(value / size[row], np.ones(len(texts))), np.append(row, every), len(texts))


def metadata(texts: pa.Array, sources: list[str | None], langs: list[str | None]) -> Rows:
    """Source, language, log sizes, shares of kinds of characters and of repeats, and a constant."""
    data, offsets = shared.text_bytes(texts)
    starts, ends = shared.word_spans(data, offsets)
    n = len(texts)
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    shares = [np.bincount(row, kind[data[: offsets[-1]]], n) / np.maximum(size, 1) for kind in _KINDS]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    words = np.bincount(owner, minlength=n)
    hashes = shared.word_hashes(data, starts, ends)
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])) + 1
    repeats = np.bincount(owner[again], minlength=n) / np.maximum(words, 1)
    dense = [*shares, repeats, np.log1p(size) / 10, np.log1p(words) / 10, size / np.maximum(words, 1) / 20, np.ones(n)]
    features, values, rows = [], [], []
    for i, column in enumerate(dense):
        features.append(np.full(n, i)), values.append(column), rows.append(np.arange(n))
    base = len(dense)
    for salt, names in ((1, sources), (2, langs)):
        told = pa.array([f"{salt}{name or ''}" for name in names], pa.string())
        raw, at = shared.text_bytes(told)
        hashed = shared.word_hashes(raw, at[:-1], at[1:]) if n else np.zeros(0, np.uint64)
        features.append(base + (hashed >> np.uint64(40)).astype(np.int64) % PLACES), values.append(np.ones(n)), rows.append(np.arange(n))
        base += PLACES
    return Rows(np.concatenate(features).astype(np.int64), np.concatenate(values), np.concatenate(rows), n)


META = len(_KINDS) + 5 + 2 * PLACES


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _learn(rows: Rows, target: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """Weighted logistic regression by gradient steps; rows of weight 0 do not take part."""
    w, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    even = weight / max(weight.sum(), 1e-9)
    for t in range(1, STEPS + 1):
        error = (_sigmoid(rows.margin(w)) - target) * even
        grad = np.bincount(rows.feature, error[rows.row] * rows.value, size) + L2 * w / 10
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        w -= RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return w


def _calibrated(margin: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Platt scaling: slope and offset that fit held margins to labels; as they are without both labels."""
    if len(target) < 8 or target.min() == target.max():
        return 1.0, 0.0
    rows = Rows(np.repeat([0, 1], len(target)), np.append(margin, np.ones(len(target))), np.tile(np.arange(len(target)), 2), len(target))
    a, b = _learn(rows, target, np.ones(len(target)), 2)
    return float(a), float(b)


def cotrain(views: list[Rows], sizes: list[int], labels: np.ndarray, rounds: int = ROUNDS) -> tuple[list[View], np.ndarray]:
    """Fit both views on ``labels`` (0, 1, or -1 for none); also how many labels each was handed."""
    known = np.flatnonzero(labels >= 0)
    held = known[CALIBRATION - 1 :: CALIBRATION]
    mine = np.zeros(len(labels), bool)
    mine[known] = True
    mine[held] = False
    share = max(1, int(HANDED * (labels < 0).sum()))
    targets = [np.where(mine, labels, 0).astype(float) for _ in views]
    weights = [mine.astype(float) for _ in views]
    models = [_learn(v, t, w, s) for v, t, w, s in zip(views, targets, weights, sizes)]
    for _ in range(rounds):
        for i, view in enumerate(views):
            p, other = _sigmoid(view.margin(models[i])), 1 - i
            sure = np.maximum(p, 1 - p)
            free = np.flatnonzero((labels < 0) & (weights[other] == 0) & (sure >= SURE))
            handed = free[np.argsort(-sure[free], kind="stable")[:share]]
            targets[other][handed] = p[handed] >= 0.5
            weights[other][handed] = 0.5  # a colleague's word counts half
        models = [_learn(v, t, w, s) for v, t, w, s in zip(views, targets, weights, sizes)]
    made = []
    for view, model in zip(views, models):
        a, b = _calibrated(view.margin(model)[held], labels[held].astype(float))
        made.append(View(model, a, b))
    return made, np.array([((w > 0) & ~mine).sum() for w in weights])


@dataclass
class Model:
    views: list[View]
    a: float  # of the sum of the calibrated log odds
    b: float

    def score(self, views: list[Rows]) -> tuple[np.ndarray, list[np.ndarray]]:
        odds = [v.a * rows.margin(v.weights) + v.b for v, rows in zip(self.views, views)]
        return _sigmoid(self.a * sum(odds) + self.b), [_sigmoid(o) for o in odds]


def _fit(texts: pa.Array, sources: list, langs: list, labels: np.ndarray) -> Model:
    known = labels[labels >= 0]
    sizes = [WORDS + 1, META]
    if not len(known) or known.min() == known.max():
        flat = 0.0 if not len(known) else 20.0 * (2 * known[0] - 1)
        return Model([View(np.zeros(s)) for s in sizes], 0.0, flat)
    views = [content(texts), metadata(texts, sources, langs)]
    made, _ = cotrain(views, sizes, labels)
    held = np.flatnonzero(labels >= 0)[CALIBRATION - 1 :: CALIBRATION]
    odds = sum(v.a * rows.margin(v.weights) + v.b for v, rows in zip(made, views))
    a, b = _calibrated(odds[held], labels[held].astype(float))
    return Model(made, a, b)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Model:
    """Learn from documents and ``labels`` (``doc_id``, ``quality`` 0 or 1).

    The sample has at most ``rows`` labelled rows as they come by a hash of the id, and as
    many without a label, in ``size`` bytes of text in all, as :func:`shared.sample` deals
    them to both labels and the rest. Labels of other values and null ids are left out. With one label only, every document gets its score; with none, 0.5.
    """
    usable = labels.filter("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    told = usable.orderBy(*order).limit(2 * rows)
    free = docs.select("doc_id").filter("doc_id is not null").join(labels.select("doc_id"), "doc_id", "left_anti")
    free = free.orderBy(*order).limit(2 * rows).select("doc_id", F.lit(-1).alias("quality"))
    sample = shared.sample(docs, told.union(free), "quality", ["text", "source", "lang"], size)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        seen: set[str] = set()
        for batch in batches:
            for text, source, lang, quality in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                if (text or "") not in seen:
                    seen.add(text or "")
                    kept.append((text or "", source, lang, quality))
        model = _fit(pa.array([k[0] for k in kept], pa.string()), [k[1] for k in kept], [k[2] for k in kept], np.array([k[3] for k in kept], np.int64))
        flat = np.concatenate([[model.a, model.b], *([v.a, v.b] for v in model.views), *(v.weights for v in model.views)])
        yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary())], names=["m"])

    found = sample.repartition(1).sortWithinPartitions(*order).mapInArrow(learn, "m binary").collect()
    if not found:
        return Model([View(np.zeros(WORDS + 1)), View(np.zeros(META))], 0.0, 0.0)
    flat = np.frombuffer(found[0].m)
    first, second = flat[6 : 6 + WORDS + 1], flat[6 + WORDS + 1 :]
    return Model([View(first, flat[2], flat[3]), View(second, flat[4], flat[5])], flat[0], flat[1])


SCORES = ("score", "content_score", "metadata_score")


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and the calibrated scores of both views.

    Needs ``text, source, lang``; nulls count as empty, and empty texts are scored by what
    is left. Rows, repeated ones too, and other columns stay; columns of the same names are replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in SCORES]
    schema = T.StructType([*kept, *(T.StructField(name, T.DoubleType()) for name in SCORES)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in shared.slices(batch.column("text")):
                rows = batch.slice(at, len(part))
                at += len(part)
                views = [content(part), metadata(part, rows.column("source").to_pylist(), rows.column("lang").to_pylist())]
                score, single = model.score(views)
                columns = [rows.column(f.name).cast(f.type) for f in list(arrow)[: len(kept)]]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, [score, *single])], schema=arrow)

    shared.bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: scores, and whether it is kept. Learns only outside the held-out fold."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))), labels.filter(~held_out(F.col("doc_id"))))
    scored = with_scores(docs.select("doc_id", "text", "source", "lang"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *SCORES, (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
