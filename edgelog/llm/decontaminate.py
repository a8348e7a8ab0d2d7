"""Benchmark decontamination with suffix arrays over shards of the training texts.

Words are maximal runs of digits, ASCII letters (A-Z lower-cased) and characters beyond
ASCII. A *window* is ``n`` consecutive words of one benchmark item; an item of fewer
words, but not none, is one window.

A shard is a run of documents of about ``SHARD_BYTES``. The shard's words become ids in the
vocabulary of the test block, words the block never uses become 0, and a suffix array
sorts all suffixes that start with a test word, as deep as the longest item. Each test
suffix is then binary-searched, giving the interval of its verbatim occurrences. Nothing
is shuffled, no shard depends on another, and a lost task only rebuilds its own shards.

The benchmark travels to the tasks in blocks of at most ``block_bytes`` of text, one
narrow stage per block. Words are compared by a 64-bit hash to find occurrences; each
hit is then compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from edgelog.llm import shared

#: Text bytes of a shard; a longer text is a shard of its own. A task holds about 25 times as much for it.
SHARD_BYTES = 1 << 20

MATCH = T.StructType(
    [
        T.StructField("item", T.StringType()),  # item id as text
        T.StructField("item_word", T.LongType()),  # where the longest match starts in the item
        T.StructField("doc_word", T.LongType()),  # and in the document
        T.StructField("length", T.LongType()),  # its words
    ]
)
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("starts", T.ArrayType(T.LongType())),  # hit word ranges, merged
        T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("matches", T.ArrayType(MATCH)),
    ]
)


@dataclass
class Block:
    """Test words of one block: ids, item bounds, and the distinct windows with their places."""

    items: list[str | None]
    vocabulary: np.ndarray
    ids: np.ndarray
    words: list[bytes]
    first: np.ndarray  # first word of each item in ids
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # size: ids, places by window, bounds
    depth: int


def make_block(rows: list[tuple[object, str | None]], n: int) -> Block:
    data, offsets = shared.text_bytes(pa.array([text or "" for _, text in rows], pa.string()))
    data = shared.LOWER[data]
    starts, ends = shared.word_spans(data, offsets)
    vocabulary, ids = np.unique(shared.word_hashes(data, starts, ends), return_inverse=True)
    ids = ids.astype(np.int64) + 1
    first = np.searchsorted(starts, offsets)
    raw = data.tobytes()
    by_size: dict[int, list[np.ndarray]] = {}
    for a, b in zip(first[:-1], first[1:]):
        if b > a:
            size = min(n, b - a)
            by_size.setdefault(int(size), []).append(np.arange(a, b - size + 1))
    windows = {}
    for size, places in by_size.items():
        at = np.concatenate(places)
        distinct, which = np.unique(ids[at[:, None] + np.arange(size)], axis=0, return_inverse=True)
        order = np.argsort(which.ravel(), kind="stable")
        bounds = np.searchsorted(which.ravel()[order], np.arange(len(distinct) + 1))
        windows[size] = (distinct, at[order], bounds)
    return Block(
        [None if item is None else str(item) for item, _ in rows], vocabulary, ids,
        [raw[a:b] for a, b in zip(starts, ends)], first, windows, int(np.diff(first).max(initial=0)),
    )


class SuffixArray:
    """Suffixes of ``ids`` that start with a known word (not 0), sorted to ``depth`` words."""

    def __init__(self, ids: np.ndarray, bits: int, depth: int):
        self.bits, self.per, self.n = bits, max(1, 63 // bits), len(ids)
        padded = np.zeros(len(ids) + depth + 2 * self.per, np.int64)
        padded[: len(ids)] = ids
        key = np.zeros(len(padded) - self.per + 1, np.int64)
        for j in range(self.per):
            key = (key << bits) | padded[j : j + len(key)]
        self.key = key
        at = np.flatnonzero(ids)
        at = at[np.argsort(key[at], kind="stable")]
        at = self._deepen(at, depth)
        self.at = at

    def _deepen(self, at: np.ndarray, depth: int) -> np.ndarray:
        """Prefix doubling: only suffixes that still tie are sorted again."""
        new = np.ones(len(at), bool)
        new[1:] = self.key[at[1:]] != self.key[at[:-1]]
        rank = np.zeros(self.n + 1, np.int64)
        group = np.flatnonzero(new)[np.cumsum(new) - 1] if len(at) else np.zeros(0, np.int64)
        rank[at] = group + 1
        done = self.per
        while done < depth and len(at):
            last = np.append(new[1:], True)
            tied = np.flatnonzero(~(new & last))
            if not len(tied):
                break
            here = at[tied]
            pair = (rank[here] << 32) | rank[np.minimum(here + done, self.n)]
            order = np.argsort(pair, kind="stable")
            at[tied], pair = here[order], pair[order]
            fresh = np.ones(len(tied), bool)
            fresh[1:] = pair[1:] != pair[:-1]
            new[tied] = fresh
            rank[at[tied]] = tied[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] + 1
            done *= 2
        return at

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ids, the interval of suffixes that start with it."""
        size = windows.shape[1]
        parts, masks = [], []
        for j in range(0, size, self.per):
            held = min(self.per, size - j)
            value = np.zeros(len(windows), np.int64)
            for k in range(held):
                value = (value << self.bits) | windows[:, j + k]
            parts.append((j, value, self.bits * (self.per - held)))
        return self._bound(parts, len(windows), False), self._bound(parts, len(windows), True)

    def _bound(self, parts: list, m: int, after: bool) -> np.ndarray:
        low, high = np.zeros(m, np.int64), np.full(m, len(self.at), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            where = self.at[np.minimum(middle, len(self.at) - 1)]
            less, same = np.zeros(m, bool), np.ones(m, bool)
            for j, value, drop in parts:
                held = self.key[where + j] >> drop
                less |= same & (held < value)
                same &= held == value
            right = less | same if after else less
            low = np.where(open_ & right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return low


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each count repeated, and 0.. within it."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def search_shard(texts: pa.Array, block: Block) -> tuple[np.ndarray, list[np.ndarray], list[list[dict]]]:
    """Words, hit ranges (starts, ends by word) and longest match per item, for each text."""
    rows = len(texts)
    data, offsets = shared.text_bytes(texts)
    data = shared.LOWER[data]
    starts, ends = shared.word_spans(data, offsets)
    first = np.searchsorted(starts, offsets)
    n_words = np.diff(first)
    none = np.zeros((0, 2), np.int64)
    if not len(starts) or not len(block.ids):
        return n_words, [none] * rows, [[] for _ in range(rows)]
    hashes = shared.word_hashes(data, starts, ends)
    near = np.minimum(np.searchsorted(block.vocabulary, hashes), len(block.vocabulary) - 1)
    known = np.where(block.vocabulary[near] == hashes, near + 1, 0)
    row = np.repeat(np.arange(rows), n_words)
    place = np.arange(len(starts)) + row  # one unknown word between two texts
    ids = np.zeros(len(starts) + rows, np.int64)
    ids[place] = known
    array = SuffixArray(ids, int(len(block.vocabulary)).bit_length(), block.depth)
    found = []
    for size, (distinct, places, bounds) in block.windows.items():
        low, high = array.search(distinct)
        window, nth = _spread(high - low)
        at = array.at[low[window] + nth]
        found.append((at, window, np.full(len(at), size), places, bounds))
    cover = np.zeros(len(ids) + 1, np.int64)
    per_doc: list[list[dict]] = [[] for _ in range(rows)]
    word_row = np.zeros(len(ids), np.int64)
    word_row[place] = row
    for at, window, size, places, bounds in found:
        if not len(at):
            continue
        right = _verbatim(data, starts, ends, at - word_row[at], block, places[bounds[window]], int(size[0]))
        at, window, size = at[right], window[right], size[right]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + size, -1)
        _longest(per_doc, at, window, int(size[0]) if len(size) else 0, places, bounds, word_row, first, block)
    hit = np.cumsum(cover[:-1])[place] > 0
    edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # a range that runs over a row's end is cut there
    cut = [none] * rows
    for a, b in zip(begin, end):
        while a < b:
            r = row[a]
            stop = min(b, first[r + 1])
            cut[r] = np.vstack([cut[r], [[a - first[r], stop - first[r]]]])
            a = stop
    return n_words, cut, per_doc


def _verbatim(data, starts, ends, word, block: Block, test, size: int) -> np.ndarray:
    """Whether the bytes of each occurrence are those of the test words; hashes could collide."""
    right = np.ones(len(word), bool)
    if not (np.diff(np.sort(block.vocabulary)) > 0).all():
        raise AssertionError("vocabulary holds a hash twice")
    lengths = np.fromiter(map(len, block.words), np.int64, len(block.words))
    flat = np.frombuffer(b"".join(block.words) + bytes(8), np.uint8)
    begin = np.cumsum(lengths) - lengths
    for j in range(size):
        w, t = word + j, test + j
        same = (ends[w] - starts[w]) == lengths[t]
        right &= same
        todo = np.flatnonzero(same)
        longest = int(lengths[t[todo]].max(initial=0))
        for k in range(longest):
            todo = todo[lengths[t[todo]] > k]
            differs = data[starts[w[todo]] + k] != flat[begin[t[todo]] + k]
            right[todo[differs]] = False
    return right


def _longest(per_doc, at, window, size, places, bounds, word_row, first, block: Block) -> None:
    """Chain windows that follow each other in both texts; keep the longest chain per item."""
    if not len(at):
        return
    owner, nth = _spread((bounds[1:] - bounds[:-1])[window])
    test = places[bounds[window[owner]] + nth]
    at = at[owner]
    item = np.searchsorted(block.first, test, side="right") - 1
    doc = word_row[at]
    diagonal = at - test
    order = np.lexsort((at, diagonal, item, doc))
    at, test, item, doc, diagonal = at[order], test[order], item[order], doc[order], diagonal[order]
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(at))) + size - 1
    pick = np.lexsort((at[begin], -length, item[begin], doc[begin]))
    kept = np.ones(len(pick), bool)
    kept[1:] = (doc[begin[pick[1:]]] != doc[begin[pick[:-1]]]) | (item[begin[pick[1:]]] != item[begin[pick[:-1]]])
    for p in pick[kept]:
        b = begin[p]
        d, i = int(doc[b]), int(item[b])
        per_doc[d].append(
            {
                "item": block.items[i], "item_word": int(test[b] - block.first[i]),
                "doc_word": int(at[b] - d - first[d]), "length": int(length[p]),
            }
        )


def _stage(block: Block, text: str, out: str, schema: pa.Schema) -> Callable:
    """A narrow stage that adds what ``block`` finds in column ``text`` to column ``out``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, found = batch.column(out).to_pylist(), []
            shards = (search_shard(part, block) for part in shared.slices(batch.column(text), SHARD_BYTES))
            rows = (row for shard in shards for row in zip(*shard))
            for old, (n_words, parts, matches) in zip(before, rows):
                if old is not None:
                    parts = np.vstack([parts, np.column_stack([old["starts"], old["ends"]]).astype(np.int64).reshape(-1, 2)])
                    parts = _merged(parts)
                found.append(
                    {
                        "n_words": int(n_words), "starts": parts[:, 0].tolist(), "ends": parts[:, 1].tolist(),
                        "matches": (old["matches"] if old else []) + matches,
                    }
                )
            columns = [pa.array(found, schema.field(out).type) if f.name == out else batch.column(f.name).cast(f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _merged(parts: np.ndarray) -> np.ndarray:
    if len(parts) < 2:
        return parts
    parts = parts[np.lexsort((parts[:, 1], parts[:, 0]))]
    reach = np.maximum.accumulate(parts[:, 1])
    new = np.ones(len(parts), bool)
    new[1:] = parts[1:, 0] > reach[:-1]
    begin = np.flatnonzero(new)
    return np.column_stack([parts[begin, 0], reach[np.append(begin[1:], len(parts)) - 1]])


def blocks(benchmark: DataFrame, n: int, block_bytes: int) -> Iterator[Block]:
    """The test set in blocks of about ``block_bytes``; the driver holds one block at a time."""
    rows: list[tuple[object, str | None]] = []
    held = 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        rows.append((row[0], row[1]))
        held += len(row[1] or "")
        if held >= block_bytes:
            yield make_block(rows, n)
            rows, held = [], 0
    if rows:
        yield make_block(rows, n)


def with_matches(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", out: str = "found", block_bytes: int = 32 << 20,
) -> DataFrame:
    """``docs`` with a struct column ``out``: words, hit word ranges and longest matches.

    Every row of ``docs`` comes back once, whatever its other columns; a column already
    named ``out`` is replaced. Null and empty texts have no words. Null and empty items
    have no windows. An item with a null id marks words, but its match carries no id.
    Repeated rows are judged one by one. Without rows or items nothing is found.
    ``matches`` holds, per item row with an occurring window, the longest verbatim match
    in the document; ties go to the first place.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [c for c in docs.columns if c != out]
    df = docs.select(*(F.col(f"`{c}`") for c in kept), F.lit(None).cast(FOUND).alias(out))
    schema = to_arrow_schema(df.schema)
    shared.bound_batches(docs.sparkSession)
    some = False
    for block in blocks(benchmark, n, block_bytes):
        df = df.mapInArrow(shared.released(_stage(block, text, out, schema)), df.schema)
        some = True
    if not some:  # no items: the words still count
        df = df.mapInArrow(shared.released(_stage(make_block([], n), text, out, schema)), df.schema)
    return df


def n_hit(found: str = "found") -> F.Column:
    """Words of the document inside any occurrence of a window."""
    spans = F.zip_with(f"{found}.starts", f"{found}.ends", lambda a, b: b - a)
    return F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: s + x)


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text") -> DataFrame:
    """Rows of ``docs`` in which no window of the benchmark occurs, columns unchanged."""
    found = "found" + "_" * max((len(c) for c in docs.columns if c.startswith("found")), default=0)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return with_matches(docs, benchmark, n, text, found).filter(F.size(f"`{found}`.starts") == 0).select(*kept)


def longest_by_item(matched: DataFrame, doc: str = "doc_id", found: str = "found") -> DataFrame:
    """Per item, its longest verbatim match over all documents and where it is (ties: smallest id)."""
    each = matched.select(F.col(doc).alias("doc"), F.explode(f"{found}.matches").alias("m"))
    best = F.max_by(F.struct("doc", "m.item_word", "m.doc_word", "m.length"), F.struct("m.length", -F.col("doc")))
    return each.groupBy(F.col("m.item").alias("item")).agg(best.alias("best")).select("item", "best.*")


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """One row per document: words, hit words, items found and whether it is contaminated."""
    found = with_matches(docs.select("doc_id", "text"), benchmark, n)
    items = F.array_sort(F.array_distinct(F.filter(F.transform("found.matches", lambda m: m["item"]), lambda i: i.isNotNull())))
    return (
        found.select("doc_id", F.col("found.n_words").alias("n_words"), n_hit().alias("n_hit"), items.alias("items"))
        .select(
            "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )
