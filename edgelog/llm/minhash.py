"""Near-duplicates by five-word shingles: SimHash and banded MinHash, then the exact Jaccard similarity.

Distinct texts are nodes. Two nodes link when their sets of shingles have a similarity of
``SIMILAR`` or more; components of links are the groups. Texts without words are alike. A
node has ``BANDS`` keys of ``ROWS`` minima each; a pair at similarity 0.8 shares one of them
with probability 1 - (1 - 0.8**5)**20 = 0.9996, a pair above with more.

Candidates come first from the fingerprints of :mod:`~edgelog.llm.simhash`, here over five words: its pigeonhole
gives each node one of its own fingerprint and, per group, one within ``simhash.RADIUS`` bits. Most pairs
at 0.8 are further apart than any pigeonhole of 64 bits can bound, so the keys find those.

Nodes that share a key are first compared with one center of the key, which joins the copies of
a common text however many they are. Only keys whose nodes then lie in several components
are looked at again: every node outside the key's largest component is compared with nodes
of the key, in blocks of about ``BLOCK``, by sketches of ``BANDS * ROWS`` minima of 16 bits. It
proposes its nearest node of other components in one block, then four in four, and so on, until all
blocks are seen and nothing new is proposed: no group is cut at any size, and its pairs are not expanded.
Pairs whose sketches agree in fewer than ``NEAR`` minima are passed over (at similarity 0.8
about one in 5000); all others are checked on their whole sets, so no link is false.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from edgelog.llm import exact_dedup, shared, simhash
from edgelog.llm.components import components

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 20, 5
#: Minima that must agree, of ``BANDS * ROWS``; nodes in a block.
NEAR = 65
BLOCK = 1024
#: Nodes whose ids are broadcast; of more, a bitmap of ``2 ** BITS`` bits tells tasks which texts may be theirs.
FEW = 1 << 13
BITS = 24
#: Shingles whose minima are taken at once.
_CHUNK = 2048
_RANDOM = np.random.default_rng(42)
_ODD = _RANDOM.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_PLUS = _RANDOM.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles; none for a text without words."""
    return np.unique(simhash.shingle_hashes(text, SHINGLE))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least of each hash function; of the empty set the largest value."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        np.minimum(least, (hashes[at : at + _CHUNK, None] * _ODD + _PLUS).min(axis=0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One key for each band."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column ^ (column >> np.uint64(31))) * _FOLD
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def sketch(least: np.ndarray) -> bytes:
    return ((least * _FOLD) >> np.uint64(48)).astype("<u2").tobytes()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        least = []

        def hashed(texts: list[str | None]) -> Iterator[np.ndarray]:
            for text in texts:
                found = simhash.shingle_hashes(text, SHINGLE)
                least.append(minima(np.unique(found)))
                yield found

        prints = simhash.majorities(hashed(batch.column(2).to_pylist()))
        ends = np.arange(len(least) + 1, dtype=np.int32) * BANDS
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*map(bands, least), np.zeros(0, np.int64)])))
        columns = [batch.column(0), batch.column(1), lists, pa.array([sketch(x) for x in least], pa.binary()), pa.array(prints)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "bands", "sketch", "fp"])


def _bitmap(wanted: DataFrame) -> np.ndarray:
    """A bit per slot of the nodes of ``wanted``, which are digests: their first bits name it."""
    slot = F.shiftright(F.conv(F.hex(F.substring("node", 1, 4)), 16, 10).cast("long"), 32 - BITS).alias("slot")
    cell = wanted.select(slot).selectExpr("shiftright(slot, 6) AS cell", "shiftleft(1L, CAST(slot & 63 AS INT)) AS bit")
    found = cell.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(1 << BITS - 6, np.int64)
    bits[found["cell"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bits


def _marked(batch: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch:
    slot = np.frombuffer(b"".join(batch.column(0).to_pylist()), ">u4")[::4].astype(np.int64) >> 32 - BITS
    return batch.filter(pa.array(bits[slot >> 6] >> (slot & 63) & 1 == 1))


def _sets(sent=None):
    """Nodes and their whole sets; of the nodes that the broadcast bitmap ``sent`` marks, where there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if sent is not None:
                batch = _marked(batch, sent.value)
            made = [shingles(text).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["node", "hashes"])

    return run


def _sets_of(wanted: DataFrame, base: DataFrame) -> DataFrame:
    """``node, hashes`` of the nodes ``wanted``. Texts stay where they lie; only sets are shuffled."""
    texts, schema = base.select("node", "text"), "node binary, hashes binary"
    if wanted.count() <= FEW:
        made = texts.join(F.broadcast(wanted), "node", "left_semi").mapInArrow(shared.released(_sets()), schema)
    else:
        sent = base.sparkSession.sparkContext.broadcast(_bitmap(wanted))
        made = texts.mapInArrow(shared.released(_sets(sent)), schema).join(wanted, "node", "left_semi")
    return made.groupBy("node").agg(F.first("hashes").alias("hashes"))


def _near(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.array([np.frombuffer(x.as_buffer(), "<u2") for x in batch.column(c)]).reshape(-1, BANDS * ROWS) for c in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((a == b).sum(axis=1) >= least))

    return run


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for a, b in zip(batch.column(2), batch.column(3)):
            left, right = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            least = min(len(left), len(right))
            both = len(np.intersect1d(left, right, True)) if least >= SIMILAR * max(len(left), len(right)) else 0
            linked.append(both >= SIMILAR * (len(left) + len(right) - both))
        yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def _met(nodes: DataFrame) -> DataFrame:
    """``key, node, center``: the nodes of every key that several share, and one of them."""
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    center = F.min_by("node", F.xxhash64("node")).alias("center")
    # written, so that both sides of the join are plain shuffles and hot keys can be split
    keys = shared.stored(keyed.groupBy("key").agg(F.count("*").alias("n"), center).filter("n > 1").select("key", "center"), "keys")
    return shared.stored(keyed.join(keys, "key"), "met")


def _alike(nodes: DataFrame) -> DataFrame:
    """``u, v``: nodes whose fingerprints are equal or within ``simhash.RADIUS`` bits, a node of each fingerprint for all of it."""
    prints = shared.stored(nodes.groupBy("fp").agg(F.min_by("node", F.xxhash64("node")).alias("center")), "prints")
    same = nodes.select("node", "fp").join(prints, "fp").filter("node <> center").select(*_pair("node", "center"))
    linked = simhash.partners(prints).join(prints.toDF("u", "a"), "u").join(prints.toDF("v", "b"), "v")
    return same.union(linked.select(*_pair("a", "b")))


def _linked(pairs: DataFrame, nodes: DataFrame, base: DataFrame) -> DataFrame:
    """Those of ``pairs`` that link: by their sketches first, then by their whole sets."""
    told = nodes.select("node", "sketch")
    both = pairs.join(told.toDF("u", "a"), "u").join(told.toDF("v", "b"), "v").select("u", "v", "a", "b")
    near = shared.stored(both.mapInArrow(shared.released(_near(NEAR)), "u binary, v binary"), "near")
    wanted = shared.stored(near.select("u").union(near.select("v")).distinct().toDF("node"), "wanted")
    made = shared.stored(_sets_of(wanted, base), "sets")
    both = near.join(made.toDF("u", "a"), "u").join(made.toDF("v", "b"), "v")
    return shared.stored(both.select("u", "v", "a", "b").mapInArrow(shared.released(_similar), "u binary, v binary"), "links")


def _members(met: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, node, root, blocks, asks`` of the keys whose nodes lie in several components.

    Nodes outside the largest component of a key ask.
    """
    placed = met.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    apart = sizes.groupBy("key").agg(F.count("*").alias("roots"), F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("main"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    apart = shared.stored(apart.filter("roots > 1").select("key", F.col("main.root").alias("main"), blocks), "apart")
    return shared.stored(placed.join(apart, "key").select("key", "node", "root", "blocks", (F.col("root") != F.col("main")).alias("asks")), "members")


def _proposals(members: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """``u, v``: for nodes that ask, their ``most`` nearest of other components in each of ``most`` blocks of a key.

    ``more`` tells that a node has others as near in one of them.
    """
    placed = members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    steps = F.explode(F.sequence(F.lit(0), F.least(F.col("blocks"), F.lit(most)) - 1)).alias("step")
    asking = placed.filter("asks").select("key", "node", "root", "asks", "blocks", "own", steps)
    asking = asking.select("key", "node", "root", "asks", F.col("own").alias("row"), F.pmod(F.col("own") + F.col("step"), F.col("blocks")).alias("column"))
    # a node is sent only to rows of blocks where some node asks
    asked = placed.select("key", "node", "root", F.lit(False).alias("asks"), "blocks", F.col("own").alias("column"), steps)
    asked = asked.withColumn("row", F.pmod(F.col("column") - F.col("step"), F.col("blocks"))).drop("blocks", "step")
    asked = asked.join(placed.filter("asks").select("key", F.col("own").alias("row")).distinct(), ["key", "row"], "left_semi")
    rows = asked.unionByName(asking).join(nodes.select("node", "sketch"), "node")
    member = F.struct("node", "root", "sketch", "asks").alias("member")
    groups = rows.groupBy("key", "row", "column").agg(F.collect_list(member).alias("members")).select("members")
    found = groups.mapInArrow(shared.released(_nearest(most, NEAR)), "u binary, v binary, more boolean")
    return found.groupBy("u", "v").agg(F.max("more").alias("more"))


def _nearest(most: int, near: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, more = [], [], []
            for members in batch.column(0):
                held = members.values
                node, asks = held.field("node").to_pylist(), held.field("asks").to_numpy(zero_copy_only=False)
                _, root = np.unique(np.array(held.field("root").to_pylist(), object), return_inverse=True)
                minima = np.array([np.frombuffer(x.as_buffer(), "<u2") for x in held.field("sketch")]).T
                rows, columns = np.flatnonzero(asks), np.flatnonzero(~asks)  # those that ask are among the asked too
                if not len(rows) or not len(columns):
                    continue
                same = np.zeros((len(rows), len(columns)), np.uint8)
                for least in minima:
                    same += least[rows, None] == least[None, columns]
                same[root[rows, None] == root[None, columns]] = 0
                for at, row in enumerate(same):
                    found = np.flatnonzero(row >= near)
                    cut = len(found) > most
                    found = found[np.argsort(-row[found].astype(np.int16), kind="stable")][:most]
                    more += [cut] * len(found)
                    u += [min(node[rows[at]], node[columns[k]]) for k in found]
                    v += [max(node[rows[at]], node[columns[k]]) for k in found]
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(more, pa.bool_())], names=["u", "v", "more"])

    return run


def roots(base: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, root`` of nodes that are not the smallest of their component; ``base`` has ``node`` and ``text``."""
    met = _met(nodes)
    stars = met.filter("node <> center").select(*_pair("node", "center"))
    tried = shared.stored(stars.union(_alike(nodes)).distinct(), "stars")
    links = _linked(tried, nodes, base)
    most, told = 1, None
    while True:
        found = components(links).toDF("node", "root")
        met = _members(met, found)  # a key whose nodes have met stays out
        if told is None:  # no other nodes are compared from here on
            told = shared.stored(nodes.select("node", "sketch").join(met.select("node").distinct(), "node", "left_semi"), "told")
        nearest = shared.stored(_proposals(met, told, most), "proposals")
        new = shared.stored(nearest.join(tried, ["u", "v"], "left_anti").select("u", "v"), "new")
        if not new.isEmpty():
            links = links.union(_linked(new, told, base))
            tried = tried.union(new)
        elif nearest.filter("more").isEmpty() and met.filter(F.col("asks") & (F.col("blocks") > most)).isEmpty():
            return found
        most *= 4


def _node(text: str) -> Column:
    """Half of the SHA-256 of a text; null counts as empty."""
    return F.substring(F.unhex(exact_dedup.sha256(F.coalesce(F.col(text), F.lit("")))), 1, 16)


def deduplicate(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id names their component, the smallest: one of each group; columns unchanged.

    Null, empty and blank texts have no shingles and are one group; a text of fewer than five
    words is one shingle. Rows without an id stay only where no row of their component has
    one, all of them. Of rows that share the naming id, each in the component stays. An empty
    table gives no rows; other columns, whatever their names, are carried along.
    """
    shared.bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = docs.select("doc_id", _node(text).alias("node"), F.col(text).alias("text"))
    held = shared.stored(base.mapInArrow(shared.released(_sketch), f"doc_id {kind}, node binary, bands array<long>, sketch binary, fp long"), "sketches")
    nodes = held.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("fp").alias("fp"))
    nodes = shared.stored(nodes, "nodes")
    found = roots(base, nodes)
    placed = shared.stored(nodes.select("node", "first").join(found, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), "placed")
    named = shared.stored(placed.groupBy("root").agg(F.min("first").alias("component_id")), "named")
    known = shared.stored(placed.join(named, "root").select("node", "component_id"), "known")
    goes = held.select("doc_id", "node").join(known, "node").filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    mark = shared.fresh(docs, "mark")
    return shared.without(docs.withColumn(mark, _node(text)), mark, goes.select("doc_id", "node"))
