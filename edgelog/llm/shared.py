"""Scratch folders and byte-level word splitting shared by the operators."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from edgelog.session import shared_dir


def ship(spark: SparkSession) -> None:
    """Let Python workers that share the driver's files import this library from where it lies.

    A cluster whose executors do not see that folder gets the library by ``--py-files``.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    held = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in held:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, held)])


#: Bytes of one Arrow batch on its way to Python; a batch holds a row at least.
BATCH_BYTES = 2 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Cap the bytes of Arrow batches of this session; a smaller bound of the user's stays."""
    held = spark.conf.get(_BATCH_KEY).rstrip("bB")
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in ``spark.checkpoint.dir``; a local session without one gets its own."""
    base = shared_dir(spark)
    spark.sparkContext.setCheckpointDir(f"{base}/rdd") if spark.sparkContext.getCheckpointDir() is None else None
    return f"{base}/edgelog-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that starts with ``base`` and that ``df`` does not have."""
    names = set(df.columns)
    return next(n for n in (base + "_" * k for k in range(len(names) + 1)) if n not in names)


def without(marked: DataFrame, mark: str, gone: DataFrame) -> DataFrame:
    """Rows of ``marked``, without its column ``mark``, whose id and mark are no row of ``gone``.

    ``gone`` has the id and the mark, in this order. Ids compare null-safe, marks in full: a
    short hash of both only finds the rows in doubt, so that the broadcast stays small.
    """
    gone = stored(gone.toDF("gone_id", "gone_mark").distinct(), "gone")
    short = stored(gone.select(F.xxhash64("gone_id", "gone_mark").alias("short")).distinct(), "short")
    doubt = F.xxhash64(marked["doc_id"], marked[mark]) == short["short"]
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col(mark) == F.col("gone_mark"))
    found = marked.join(short, doubt, "left_semi").join(gone, same, "left_anti")
    return marked.join(short, doubt, "left_anti").unionAll(found).drop(mark)


#: A text of a sample may take this part of its bytes at most.
LARGEST_PART = 40


def shares(totals: list[int], size: int) -> list[int]:
    """``size`` dealt out evenly; what one does not need goes to those that do."""
    out, left = [0] * len(totals), size
    for done, k in enumerate(sorted(range(len(totals)), key=totals.__getitem__)):
        out[k] = min(totals[k], left // (len(totals) - done))
        left -= out[k]
    return out


def sample(docs: DataFrame, told: DataFrame, label: str, columns: list[str], size: int) -> DataFrame:
    """``doc_id``, the ``columns`` of ``docs`` (the text first) and ``label``, in ``size`` bytes of text in all.

    ``told`` has the chosen ids with their label and must be small. Each label has its own
    share of the bytes, so one never crowds out another. An id gives one text, equal texts
    count once. A text above ``size / LARGEST_PART`` is left out, but where a label has no
    other its shortest stays. The bound holds before texts meet in one task.
    """
    text = F.coalesce(F.col(columns[0]), F.lit(""))
    key = F.struct((F.octet_length(text) > size // LARGEST_PART).alias("long"), F.xxhash64(text).alias("mark"), F.octet_length(text).cast("long").alias("bytes"))
    own = docs.select("doc_id", key.alias("key")).join(F.broadcast(told), "doc_id").groupBy("doc_id", label).agg(F.min("key").alias("key"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    once = own.groupBy("key").agg(F.min_by(F.struct("doc_id", label), F.struct(*order)).alias("row")).select("key.*", "row.*")
    by = Window.partitionBy(label).orderBy("long", F.when(F.col("long"), F.col("bytes")), *order)
    line = once.select("*", F.row_number().over(by).alias("place"), F.sum("bytes").over(by).alias("held"))
    line = stored(line.filter("place = 1 or not long"), "sample")
    totals = line.groupBy(label).agg(F.max("held").alias("bytes")).orderBy(label).collect()
    fits = F.lit(False)
    for row, share in zip(totals, shares([r["bytes"] for r in totals], size)):
        fits |= (F.col(label) == row[label]) & (F.col("held") <= share)
    kept = line.filter(fits | (F.col("place") == 1)).select(F.col("doc_id").alias("id"), F.col("mark").alias("kept_mark"), label)
    rows = docs.join(F.broadcast(kept), (docs["doc_id"] == F.col("id")) & (F.xxhash64(text) == F.col("kept_mark")))
    # copies of a row that share its id meet before the shuffle
    return rows.groupBy("doc_id", label).agg(F.min(F.struct(*columns)).alias("row")).select("doc_id", "row.*", label)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts behind each other, eight spare bytes at the end, and row offsets."""
    if len(texts) == 0:
        return np.zeros(8, np.uint8), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    data = np.zeros(offsets[-1] - offsets[0] + 8, np.uint8)
    data[:-8] = raw[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(texts: pa.Array, size: int = 2 << 20) -> list[pa.Array]:
    """``texts`` in runs of about ``size`` bytes, at least a row each, to bound what a step holds."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, cuts, at = np.cumsum(lengths), [0], 0
    while at < len(texts):
        before = ends[at] - lengths[at]
        at = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        cuts.append(at)
    return [texts.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]


_SPACE = re.compile(rb"[\x20\x09-\x0D]")

def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` that gives memory back when a task ends; Python workers live on for tasks of other stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed pages otherwise
            if trim is not None:
                trim(0)

    return run


_BYTE = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
#: A-Z to a-z, every other byte as it is.
LOWER = np.where(_UPPER, _BYTE + 32, _BYTE).astype(np.uint8)
#: Bytes of a word: digits, letters of ASCII, and all bytes of longer UTF-8 sequences.
WORD = ((_BYTE >= 48) & (_BYTE <= 57)) | _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)

_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word of :func:`text_bytes`; no word crosses two rows."""
    inside = np.zeros(len(data) + 1, bool)
    inside[1 : len(data) - 7] = WORD[data[:-8]]
    left, right = inside[:-1].copy(), inside[1:].copy()
    here = right.copy()
    left[offsets[:-1]] = False
    starts = np.flatnonzero(here & ~left)
    after = np.append(right[1:], False)
    ends_at = offsets[1:] - 1
    after[ends_at[ends_at >= 0]] = False
    return starts, np.flatnonzero(here & ~after) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; words up to eight bytes never collide with each other."""
    eight = np.ndarray((len(data) - 7,), np.dtype("<u8"), data, strides=(1,))
    length = ends - starts
    out = _mixed(eight[starts] & _KEEP[np.minimum(length, 8)])
    live, done = np.flatnonzero(length > 8), 8
    while len(live):
        part = eight[starts[live] + done] & _KEEP[np.minimum(length[live] - done, 8)]
        out[live] = _mixed(out[live] ^ np.uint64(done) ^ (part * _MIX + np.uint64(done)))
        done += 8
        live = live[length[live] > done]
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x ^= x >> np.uint64(32)
    return x * _MIX


def spaced(body: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """``body`` in pieces of about ``size`` bytes, each cut where ASCII white space begins."""
    at = 0
    while len(body) - at > size:
        space = _SPACE.search(body, at + size)
        if space is None:
            break
        yield body[at : space.start()]
        at = space.start()
    yield body[at:] if at else body
