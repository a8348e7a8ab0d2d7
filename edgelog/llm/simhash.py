"""SimHash near-duplicates with bit-sliced comparison.

A text's fingerprint is the bitwise majority of the XXH64 values (seed 42) of its
shingles. Texts with equal fingerprints are one node. Two nodes link when they differ in
``RADIUS`` bits or fewer, and components of links are the groups.

Candidates come from an exact pigeonhole: of four blocks of 16 bits, two at most can
differ, so linked nodes share two blocks, for one of six choices. Where more than
``GROUP`` nodes share one choice, the other 32 bits are cut into eight blocks and six of
them must agree as well; at most 256 different fingerprints then remain together. Both
steps lose no link.

Inside a group the fingerprints are stored as bit planes, 64 lanes to a word. A row is
compared with all lanes of a word at once: each plane's difference goes through a
carry-save counter of two bits and an overflow, and a word is abandoned as soon as all
its lanes exceed the radius. A group reports a star per local component, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from edgelog.llm import exact_dedup, shared
from edgelog.llm.components import components

RADIUS = 2
SHINGLE = 3
SEED = 42
GROUP = 2048
#: Shingles whose bits are counted at once.
_CHUNK = 1 << 20
_BYTES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of the whole text, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())), np.uint64, len(starts),
    )


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bitwise majority of each run of ``counts`` hashes; zero for an empty run."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    # byte counters hold 255 at most: runs are cut into parts of that size
    first = np.cumsum(counts[full]) - counts[full]
    parts = -(-counts[full] // 255)
    owner = np.repeat(np.arange(len(full)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    cuts = first[owner] + 255 * nth
    heads = np.flatnonzero(nth == 0)
    for bit in range(8):
        packed = np.add.reduceat((hashes >> np.uint64(bit)) & _BYTES, cuts)
        sums = np.add.reduceat(packed.view(np.uint8).reshape(-1, 8).astype(np.int64), heads, axis=0)
        for byte in range(8):
            over = 2 * sums[:, byte] > counts[full]
            out[full] |= over.astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def majorities(texts: Iterable[np.ndarray]) -> np.ndarray:
    """The fingerprint of each text, given as its shingle hashes, as a signed long."""
    made, hashes, held = [], [], 0
    for found in texts:
        hashes.append(found)
        held += len(found)
        if held > _CHUNK:
            made.append(majority(np.concatenate(hashes), np.array([*map(len, hashes)])))
            hashes, held = [], 0
    if hashes:
        made.append(majority(np.concatenate(hashes), np.array([*map(len, hashes)])))
    return np.concatenate([*made, np.zeros(0, np.uint64)]).view(np.int64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = majorities(map(shingle_hashes, batch.column(1).to_pylist()))
        kept = [k for k in range(batch.num_columns) if k != 1]
        yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(fp)], names=[*(batch.schema.names[k] for k in kept), "fp"])


def fingerprints(docs: DataFrame, text: str = "text", mark: Column | None = None) -> DataFrame:
    """``doc_id``, the ``mark`` if given, and fingerprint ``fp`` (64 bits as a signed long) of each whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns, schema = ["doc_id", F.col(text).alias("text")], f"doc_id {kind}, fp long"
    if mark is not None:
        columns, schema = [*columns, mark.alias("mark")], f"doc_id {kind}, mark string, fp long"
    return docs.select(*columns).mapInArrow(_fingerprints, schema)


def _masks(bits: int, blocks: int, kept: int) -> list[int]:
    """Masks that keep ``kept`` of ``blocks`` equal blocks, as signed values of 64 bits."""
    width = bits // blocks
    one = (1 << width) - 1
    found = [sum(one << (width * i) for i in chosen) for chosen in combinations(range(blocks), kept)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in found]


def _folded(fp: Column, mask: int) -> Column:
    """The 32 bits that ``mask`` leaves out, side by side in the low bits."""
    out, at = F.lit(0).cast("long"), 0
    for block in range(4):
        if not (mask >> (16 * block)) & 1:
            out = out.bitwiseOR(F.shiftleft(F.shiftright(fp, 16 * block).bitwiseAND(0xFFFF), 16 * at))
            at += 1
    return out


def groups(nodes: DataFrame, limit: int = GROUP) -> DataFrame:
    """``fps``: arrays of at most ``max(limit, 256)`` fingerprints that hold all candidates."""
    fp = F.col("fp")
    coarse = [
        F.struct(F.lit(i).alias("choice"), fp.bitwiseAND(F.lit(m)).alias("key"), _folded(fp, m).alias("rest"))
        for i, m in enumerate(_masks(64, 4, 2))
    ]
    keyed = nodes.select("fp", F.explode(F.array(*coarse)).alias("k")).select("fp", "k.*")
    shared_keys = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).filter("n > 1")
    fine = [F.struct(F.lit(i + 1).alias("part"), F.col("rest").bitwiseAND(F.lit(m)).alias("sub")) for i, m in enumerate(_masks(32, 8, 6))]
    whole = F.array(F.struct(F.lit(0).alias("part"), F.lit(0).cast("long").alias("sub")))
    return (
        keyed.join(shared_keys, ["choice", "key"])
        .select("choice", "key", "fp", F.explode(F.when(F.col("n") <= limit, whole).otherwise(F.array(*fine))).alias("s"))
        .groupBy("choice", "key", "s.part", "s.sub").agg(F.collect_list("fp").alias("fps"))
        .filter(F.size("fps") > 1).select("fps")
    )


def linked_lanes(fps: np.ndarray, sizes: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions in ``fps`` within ``radius`` (at most 2), inside groups of ``sizes``."""
    fps = fps.view(np.uint64)
    words = -(-sizes // 64)
    first_row, first_word = np.cumsum(sizes) - sizes, np.cumsum(words) - words
    group = np.repeat(np.arange(len(sizes)), sizes)
    lane = np.arange(len(fps)) - first_row[group]
    slot = first_word[group] * 64 + lane
    planes = np.zeros((64, int(words.sum())), np.uint64)
    for bit in range(64):
        lanes = np.zeros(planes.shape[1] * 64, np.uint8)
        lanes[slot] = (fps >> np.uint64(bit)) & np.uint64(1)
        planes[bit] = np.packbits(lanes, bitorder="little").view("<u8")
    # a row meets the words from its own onwards, in its own only the lanes behind it
    own = lane // 64
    count = words[group] - own
    row = np.repeat(np.arange(len(fps)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    word = first_word[group[row]] + own[row] + nth
    left, right = [], []
    for at in range(0, len(row), _CHUNK):
        a, b = _within(fps, planes, row[at : at + _CHUNK], word[at : at + _CHUNK], nth[at : at + _CHUNK], lane, group, sizes, first_row, first_word, radius)
        left.append(a)
        right.append(b)
    none = np.zeros(0, np.int64)
    return np.concatenate([*left, none]), np.concatenate([*right, none])


def _within(fps, planes, row, word, nth, lane, group, sizes, first_row, first_word, radius):
    every = np.uint64(2**64 - 1)
    behind = (lane[row] % 64 + 1).astype(np.uint64)
    below = np.where(behind == 64, every, (np.uint64(1) << np.minimum(behind, np.uint64(63))) - np.uint64(1))
    dead = np.where(nth == 0, below, np.uint64(0))
    used = sizes[group[row]] - 64 * (word - first_word[group[row]])
    past = np.where(used >= 64, np.uint64(0), every << np.minimum(np.maximum(used, 0), 63).astype(np.uint64))
    dead |= past
    ones, twos = np.zeros(len(row), np.uint64), np.zeros(len(row), np.uint64)
    for bit in range(64):
        differ = planes[bit][word] ^ (np.uint64(0) - ((fps[row] >> np.uint64(bit)) & np.uint64(1)))
        carry = ones & differ
        ones ^= differ
        dead |= twos & carry  # four or more
        twos ^= carry
        beyond = {0: ones | twos, 1: twos, 2: ones & twos}[radius]
        dead |= beyond
        if bit % 4 == 3:
            live = np.flatnonzero(dead != every)
            if len(live) < 0.8 * len(row):
                row, word, dead, ones, twos = row[live], word[live], dead[live], ones[live], twos[live]
    live = np.flatnonzero(dead != every)
    row, word, alive = row[live], word[live], ~dead[live]
    which, at = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    g = group[row[which]]
    return row[which], first_row[g] + 64 * (word[which] - first_word[g]) + at


def stars(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest position each of ``n`` positions reaches over the pairs."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root != root[root]).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _lanes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The fingerprints of a batch of groups, and the pairs of their positions that link."""
    lists = batch.column(0)
    offsets = lists.offsets.to_numpy()
    fps = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    return fps, *linked_lanes(fps, np.diff(offsets).astype(np.int64))


def _partner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps, a, b = _lanes(batch)
        first = np.full(len(fps), len(fps))
        np.minimum.at(first, b, a)
        found = np.flatnonzero(first < len(fps))
        yield pa.RecordBatch.from_arrays([pa.array(fps[first[found]]), pa.array(fps[found])], names=["u", "v"])


def partners(nodes: DataFrame) -> DataFrame:
    """``u, v``: for each fingerprint ``fp`` one other that links with it, from each group that has one before it."""
    return groups(nodes).mapInArrow(shared.released(_partner), "u long, v long").distinct()


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps, a, b = _lanes(batch)
        root = stars(a, b, len(fps))
        moved = np.flatnonzero(root != np.arange(len(fps)))
        yield pa.RecordBatch.from_arrays([pa.array(fps[moved]), pa.array(fps[root[moved]])], names=["u", "v"])


def components_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``, the smallest id reachable.

    Null, empty and blank texts have fingerprint zero and link like any other. Repeated rows come
    back as often as they are there. Rows without an id belong to their component but
    never name it; a component of such rows only has a null id. An empty table gives none.
    """
    return _components(docs, text).select("doc_id", "fp", "component_id")


def _components(docs: DataFrame, text: str, mark: Column | None = None) -> DataFrame:
    held = shared.stored(fingerprints(docs, text, mark), "fingerprints")
    nodes = held.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(groups(nodes).mapInArrow(_link, "u long, v long"))
    placed = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    known = shared.stored(placed.select("fp", "root").join(named, "root").select("fp", "component_id"), "components")
    return held.join(known, "fp")


def deduplicate(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id names their component: one of each group; columns unchanged.

    Rows without an id stay only where no row of their component has one, all of them.
    Of rows that share the naming id, each in the component stays.
    """
    # a row that goes is told by its id and the digest of its text, as ids may be null or repeated
    digest = exact_dedup.sha256(F.coalesce(F.col(text), F.lit("")))
    goes = ~F.col("doc_id").eqNullSafe(F.col("component_id"))
    mark = shared.fresh(docs, "mark")
    return shared.without(docs.withColumn(mark, digest), mark, _components(docs, text, digest).filter(goes).select("doc_id", "mark"))


def report(docs: DataFrame) -> DataFrame:
    return components_of(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
