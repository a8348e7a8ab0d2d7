"""How filters interact: what each removes, at every place of every order.

A document is a mask of the filters it fails, so a part of the corpus is at most ``2^k``
cells of equal masks. A reflected Gray code then walks all subsets of the filters and
toggles one filter at a time. Each cell keeps a counter of its failures that are active;
where it leaves or reaches zero, the cell goes from or comes back to the survivors. The
``2^k`` states of the walk are stored, and every step of every order is the difference of
two of them: no order is replayed over the documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from edgelog.llm import shared

#: The filters of :func:`marks`, in bit order; the last is told by :func:`masks`.
FILTERS = "ABCDE"
MIN_WORDS = 100
_MARKED = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(65, 91))
_NOT_CAPITALS = bytes(b for b in range(256) if b not in _CAPITALS)
#: Bytes 10xxxxxx go on with a code point; all others begin one.
_INSIDE = bytes(range(0x80, 0xC0))


def failures(body: bytes) -> int:
    """Bits of the filters A to D that a text fails; words are runs without ASCII white space."""
    words, distinct = 0, set()
    for piece in shared.spaced(body):
        found = piece.split()
        words += len(found)
        distinct.update(found)
    points = len(body.translate(None, _INSIDE))
    capitals = len(body.translate(None, _NOT_CAPITALS))
    told = (words < MIN_WORDS, 100 * len(distinct) < 80 * words, 100 * capitals > 10 * points, _MARKED.search(body) is not None)
    return sum(1 << bit for bit, fails in enumerate(told) if fails)


def marks(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, part, mask`` of A to D, and the ``digest`` of the text.

    A null text counts as empty, a null ``lang`` as the empty string. Other columns are not read.
    """
    shared.bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [b or b"" for b in batch.column("body").to_pylist()]
            made = pa.array([failures(b) for b in bodies], pa.int32())
            digest = pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), made, digest], ["doc_id", "part", "mask", "digest"])

    part = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
    slim = docs.select("doc_id", part, F.col("text").cast("binary").alias("body"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, part string, mask int, digest binary")


def masks(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask`` with the bit of E set where a smaller ``doc_id`` has the same text.

    Rows that share the smallest id do not fail, nor do rows without an id, which are neither
    smaller nor larger than others. Groups of copies, however large, meet as one row per task.
    """
    # written once: read for the groups and for the rows; plain tables let hot digests be split
    facts = shared.stored(marks(docs), "marks")
    groups = facts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    repeated = shared.stored(groups.filter("first < last").select("digest", "first"), "repeated")
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    return facts.join(repeated, "digest", "left").select("doc_id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def labelled(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """``masked`` with ``good`` (quality 1) and ``toxic`` (toxic 1): 1 where any label row of the id says so, else 0.

    A null id has no label.
    """
    said = [F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    told = shared.stored(labels.groupBy(F.col("doc_id").alias("label_id")).agg(*said).filter("label_id is not null and good + toxic > 0"), "told")
    full = masked.join(told, F.col("doc_id") == F.col("label_id"), "left")
    return full.select("part", "mask", *(F.coalesce(n, F.lit(0)).alias(n) for n in ("good", "toxic")))


def cells(marked: DataFrame, weights: list[str]) -> DataFrame:
    """``part, mask, docs`` and the sums of ``weights``: at most ``2^k`` rows per part."""
    return marked.groupBy("part", "mask").agg(F.count("*").alias("docs"), *(F.sum(w).cast("long").alias(w) for w in weights))


def walk(mask: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Survivors (a row of sums each) of all ``2^k`` subsets of filters, indexed by subset."""
    active = np.zeros(len(mask), np.int64)
    alive = counts.sum(0)
    states = np.zeros((1 << k, counts.shape[1]), np.int64)
    states[0], subset = alive, 0
    for turn in range(1, 1 << k):
        toggled = (turn & -turn).bit_length() - 1
        fails = (mask >> toggled & 1).astype(bool)
        if subset >> toggled & 1:
            active[fails] -= 1
            alive = alive + counts[fails & (active == 0)].sum(0)
        else:
            alive = alive - counts[fails & (active == 0)].sum(0)
            active[fails] += 1
        subset ^= 1 << toggled
        states[subset] = alive
    return states


def states(cell: DataFrame, k: int, weights: list[str]) -> DataFrame:
    """``part, subset, docs`` and ``weights``: what survives each subset of the ``k`` filters."""
    held = ["docs", *weights]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = walk(rows["mask"].to_numpy(np.int64), rows[held].to_numpy(np.int64), k)
        return pd.DataFrame({"part": key[0], "subset": np.arange(1 << k, dtype=np.int32), **{n: found[:, i] for i, n in enumerate(held)}})

    return cell.groupBy("part").applyInPandas(run, "part string, subset int, " + ", ".join(f"{n} long" for n in held))


def steps(state: DataFrame, filters: str, weights: list[str]) -> DataFrame:
    """Every step of every order of ``filters``, as differences of stored states.

    ``part, filter_order, step, kept, removed, redundant, unique_fails``, a ``<weight>_lost``
    per weight, and ``shapley``: the filter's ``removed`` summed over all orders.
    """
    k, full = len(filters), (1 << len(filters)) - 1
    lost = [f"{w}_lost" for w in weights]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        at = rows.sort_values("subset")[["docs", *weights]].to_numpy(np.int64)
        out, shapley = [], [0] * k
        for order in permutations(range(k)):
            before = 0
            for step, f in enumerate(order, 1):
                after = before | 1 << f
                gone = at[before] - at[after]
                fails, alone = at[0, 0] - at[1 << f, 0], at[full ^ 1 << f, 0] - at[full, 0]
                shapley[f] += gone[0]
                name = "".join(filters[i] for i in order)
                out.append((key[0], name, step, at[after, 0], gone[0], fails - gone[0], alone, *gone[1:], f))
                before = after
        made = pd.DataFrame(out, columns=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *lost, "f"])
        made["shapley"] = made.pop("f").map(dict(enumerate(shapley)))
        return made

    numbers = ", ".join(f"{n} long" for n in ["kept", "removed", "redundant", "unique_fails", *lost, "shapley"])
    return state.groupBy("part").applyInPandas(run, f"part string, filter_order string, step int, {numbers}")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`steps` of the five filters over ``docs``, a part per ``lang``.

    A row of ``docs`` counts as a document, repeated rows and ids too. An empty table has no parts.
    """
    weights = ["good", "toxic"]
    cell = cells(labelled(masks(docs), labels), weights)
    return steps(states(cell, len(FILTERS), weights), FILTERS, weights)
