"""Phrase collocations from one count of padded longest windows.

At every word the window of the ``size`` words that begin there is taken from lead columns,
padded where its piece of text ends. Only these longest windows are counted; a phrase of
fewer words is a prefix of them, so Spark's ROLLUP over the window's columns sums its
occurrences. No shorter n-gram is ever exploded.

What makes that fit: a phrase is no more frequent than its words, its pairs and triples of
neighbours and its prefixes. A word below the threshold pads the window like an end of text, and
so does the end of a pair or triple whose counter, shared by all of one hash, is below it.
Bitmaps of bounded size tell them; where one is full, a window is longer than it needs to be, never
shorter. Tasks meet windows by their first two words, sum them along the sorted prefixes and
cut each after its last frequent prefix, and only what is left enters the ROLLUP.

**Hot groups.** Where the leading words of a window are all hot (each at least
``1 / HOT`` of all words, so at most ``HOT`` exist), the words behind them take part in the
key, up to the first that is not hot: a task then gets less than ``1 / HOT`` of all windows
for a key, or equal windows, of which each chunk of text sends one row.

**Words** are told by a 64-bit hash of language and word. The table of all distinct words is
checked for two with one hash; there the count starts again with another seed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from edgelog.llm import shared

SIZE = 5
#: A word with at least this part of all words is hot.
HOT = 256
#: Bits of the bitmap of frequent words, 8 MB at every size of the input.
BITS = 26
#: Counters of pairs, and of triples: one for ``WORDS_PER_COUNTER`` words of the corpus, ``2 ** COUNTER_BITS``
#: at most (a bitmap of 8 MB), in runs of ``2 ** RUN_BITS`` that are summed together.
WORDS_PER_COUNTER = 8
COUNTER_BITS = 26
RUN_BITS = 16
#: Distinct words a task counts before it sends them; words in a chunk, and in a part of one that is worked on at once.
MAX_WORDS = 400_000
CHUNK = 6_000_000
PART = 1 << 18
#: Groups in which the candidates of a language first meet to be ranked.
DEAL = 32

_ENDS = b".,;:!?\n\v\f\r"
_END = b"\xff"  # no byte of UTF-8
_SPLIT = bytes.maketrans(_ENDS + b"\t", _END * len(_ENDS) + b" ")
_BLANK = bytes.maketrans(_ENDS, b" " * len(_ENDS))


def _slim(docs: DataFrame) -> DataFrame:
    shared.bound_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("body"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body")):
            if body.is_valid:
                yield lang, body.as_py().lower()


def key(lang: str, word: bytes, seed: int) -> int:
    """The hash of a word of a language, as a signed long; 0 and -1 stand for no word."""
    return int(np.uint64(xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang.encode(), seed))).astype(np.int64))


def vocabulary(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``lang, word, key, n``: every distinct word and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                words = list(counts)
                columns = [
                    pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()),
                    pa.array([key(lang, w, seed) for w in words], pa.int64()), pa.array(list(counts.values()), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "key", "n"])
            held.clear()

        for lang, body in _rows(batches):
            for piece in shared.spaced(body.translate(_BLANK)):
                held.setdefault(lang, Counter()).update(piece.split())
                if sum(map(len, held.values())) > MAX_WORDS:
                    yield from flush()
        yield from flush()

    parts = _slim(docs).mapInArrow(run, "lang string, word binary, key long, n long")
    return parts.groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


def _checked(docs: DataFrame) -> tuple[DataFrame, int]:
    """The stored vocabulary under the first seed that tells all words apart."""
    seed = 0
    while True:
        words = shared.stored(vocabulary(docs, seed), "vocabulary")
        shared_key = words.groupBy("key").count().filter("count > 1 or key in (0, -1)")
        if shared_key.isEmpty():
            return words, seed
        seed += 1


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """A bit per slot of the keys of frequent words: ``2 ** BITS`` bits, whatever their number."""
    slot = F.shiftrightunsigned("key", 64 - BITS).alias("slot")
    cell = frequent.select(slot).selectExpr("shiftright(slot, 6) AS cell", "shiftleft(1L, CAST(slot & 63 AS INT)) AS bit")
    found = cell.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(1 << BITS - 6, np.int64)
    bits[found["cell"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bits


class Chunks:
    """Running text as numbered words, in chunks that keep ``lead`` words of the one before."""

    def __init__(self, bitmap: np.ndarray, seed: int, lead: int):
        self.bitmap, self.seed, self.lead = bitmap, seed, lead
        self.words: dict[str, dict[bytes, int]] = {}
        self.keys: list[int] = [0]
        self.runs: list[np.ndarray] = []
        self.held = 0

    def made(self, numbers: np.ndarray, count: int, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What the first ``count`` places of ``numbers`` give; ``keys`` are the hashes of the numbers."""
        raise NotImplementedError

    def _number(self, lang: str, word: bytes, table: dict[bytes, int]) -> int:
        """A word's number in this chunk; words that are certainly not frequent are 0, as is an end."""
        hashed = key(lang, word, self.seed)
        slot = (hashed & (1 << 64) - 1) >> 64 - BITS
        if self.bitmap[slot >> 6] >> (slot & 63) & 1:
            self.keys.append(hashed)
            table[word] = len(self.keys) - 1
        else:
            table[word] = 0
        return table[word]

    def add(self, lang: str, body: bytes) -> Iterator[pa.RecordBatch]:
        """Take the words of a text; what a full chunk gives comes out."""
        body = body.translate(_SPLIT).replace(_END, b" \xff ")
        for piece in shared.spaced(body):
            table = self.words.setdefault(lang, {_END: 0})
            found = piece.split()
            try:
                numbers = np.fromiter(map(table.__getitem__, found), np.int32, len(found))
            except KeyError:
                for word in dict.fromkeys(found):
                    if word not in table:
                        self._number(lang, word, table)
                numbers = np.fromiter(map(table.__getitem__, found), np.int32, len(found))
            self.runs.append(numbers)
            self.held += len(numbers)
            if self.held >= CHUNK:
                yield from self.flush(last=False)
        self.runs.append(np.zeros(1, np.int32))

    def flush(self, last: bool = True) -> Iterator[pa.RecordBatch]:
        """Work off the chunk; its last words begin the next one unless it is the ``last``."""
        numbers = np.concatenate([*self.runs, np.zeros(self.lead if last else 0, np.int32)])
        count = len(numbers) - self.lead
        if count <= 0:
            return
        keys = np.array(self.keys, np.int64)
        rest = keys[numbers[count:]]
        yield from self.made(numbers, count, keys)
        # the words carried over get numbers of the next chunk
        self.words, self.keys = {}, [0]
        carried = np.zeros(len(rest), np.int32)
        for at, hashed in enumerate(rest.tolist()):
            if hashed:
                self.keys.append(hashed)
                carried[at] = len(self.keys) - 1
        self.runs, self.held = [carried], 0


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (first * np.uint64(0x9E3779B97F4A7C15) + second) * np.uint64(0xC2B2AE3D27D4EB4F)
        return mixed ^ mixed >> np.uint64(32)


def _counters(words: np.ndarray, bits: int) -> list[np.ndarray]:
    """The counter of the pair, and of the triple, that begins at each of the keys ``words`` but the last two."""
    words = words.view(np.uint64)
    pair = _mixed(words[:-2], words[1:-1])
    with np.errstate(over="ignore"):
        return [(m * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64) for m in (pair, _mixed(pair, words[2:]))]


class Counters(Chunks):
    """Counters of pairs and triples of neighbours, summed per chunk: a run number and a packed run a row."""

    def __init__(self, bitmap: np.ndarray, seed: int, bits: int, least: int):
        super().__init__(bitmap, seed, 2)
        self.bits, self.least = bits, least

    def made(self, numbers: np.ndarray, count: int, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        found: tuple[list, list] = ([], [])
        for at in range(0, count, PART):
            part = numbers[at : min(at + PART, count) + 2]
            full = (part[:-2] != 0) & (part[1:-1] != 0)
            for kind, counter in enumerate(_counters(keys[part], self.bits)):
                found[kind].append(counter[full if kind == 0 else full & (part[2:] != 0)].astype(np.uint32))
        for kind, parts in enumerate(found):
            at, n = np.unique(np.concatenate(parts), return_counts=True)
            at, n = at.astype(np.int64), np.minimum(n, min(self.least, 65535)).astype("<u2")
            runs, starts = np.unique(at >> RUN_BITS, return_index=True)
            ends = np.append(starts[1:], len(at)).tolist()
            packed = [_pack(at[a:b] & (1 << RUN_BITS) - 1, n[a:b]) for a, b in zip(starts.tolist(), ends)]
            if len(runs):
                numbered = runs + (kind << self.bits - RUN_BITS)
                yield pa.RecordBatch.from_arrays([pa.array(numbered.astype(np.int32)), pa.array(packed, pa.binary())], ["run", "packed"])


def _pack(at: np.ndarray, n: np.ndarray) -> bytes:
    """Places in a run and their counts: steps between places and counts, byte by byte, compressed."""
    steps = np.diff(at, prepend=0).astype("<u2")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.view(np.uint8).reshape(-1, 2).T.tobytes() for x in (steps, n)))


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(2, 2, -1)
    steps, n = (np.ascontiguousarray(x.T).view("<u2").ravel() for x in plain)
    return np.cumsum(steps, dtype=np.int64), n.astype(np.int64)


class Windows(Chunks):
    """Counted windows of keys; ``both`` holds the bitmaps of pairs and of triples, one behind the other."""

    def __init__(self, bitmap: np.ndarray, both: np.ndarray, hot: set[int], seed: int, size: int = SIZE):
        super().__init__(bitmap, seed, size + 1)
        self.both, self.hot, self.size = both.reshape(2, -1), hot, size
        self.bits = (both.size * 4).bit_length() - 1

    def _goes_on(self, numbers: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
        """Whether the pair, and the triple, that begins at each place may be frequent."""
        out: list[list[np.ndarray]] = [[], []]
        for at in range(0, len(numbers) - 2, PART):
            part = numbers[at : at + PART + 2]
            full = part[1:-1] != 0
            for kind, counter in enumerate(_counters(keys[part], self.bits)):
                full = full & (self.both[kind][counter >> 3] >> (counter & 7) & 1).astype(bool)
                if kind:
                    full &= part[2:] != 0
                out[kind].append(full)
        return [np.concatenate(parts) for parts in out]

    def made(self, numbers: np.ndarray, count: int, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        pair, triple = self._goes_on(numbers, keys)
        longer = np.flatnonzero((numbers[:count] != 0) & pair[:count])
        single = np.bincount(numbers[:count], minlength=len(keys)) - np.bincount(numbers[longer], minlength=len(keys))
        single[0] = 0
        alone = np.flatnonzero(single)
        yield self._rows([alone, *[np.zeros(len(alone), np.int64)] * (self.size - 1)], single[alone], keys)
        if len(longer):
            columns, live = [numbers[longer], numbers[longer + 1]], np.ones(len(longer), bool)
            for k in range(2, self.size):
                live = live & pair[longer + k - 1] & triple[longer + k - 2]
                columns.append(np.where(live, numbers[longer + k], 0))
            yield self._counted(columns[: self.size], keys)

    def _counted(self, columns: list[np.ndarray], keys: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        change = np.zeros(len(order), bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = np.flatnonzero(change)
        return self._rows([c[first] for c in columns], np.diff(np.append(first, len(order))), keys)

    def _rows(self, columns: list[np.ndarray], n: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        leading, run = np.zeros(len(n), np.int32), np.ones(len(n), bool)
        hot = np.array([k in self.hot for k in self.keys])
        for c in columns:
            run &= hot[c]
            leading += run
        free = np.clip(leading + 1, 2, self.size).astype(np.int32)
        arrays = [pa.array(keys[c]) for c in columns] + [pa.array(free), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, [*_columns(self.size), "free", "n"])


def _columns(size: int) -> list[str]:
    return [f"w{i}" for i in range(1, size + 1)]


def _work(docs: DataFrame, make: Callable[[], Chunks], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = make()
        for lang, body in _rows(batches):
            yield from chunks.add(lang, body)
        yield from chunks.flush()

    return _slim(docs).mapInArrow(run, schema)


def counters(docs: DataFrame, bitmap: np.ndarray, seed: int, total: int, least: int) -> np.ndarray:
    """A bit per counter of pairs, and of triples, that reaches ``least``: those of the others occur less often.

    Runs of counters meet in sorted order and are summed one at a time, so a task holds one
    run whatever the corpus. The driver gets the bitmaps, ``2 ** COUNTER_BITS`` bits each at most.
    """
    bits = min(COUNTER_BITS, max(RUN_BITS, (total // WORDS_PER_COUNTER).bit_length()))
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)
    packed = _work(docs, lambda: Counters(sent.value, seed, bits, least), "run int, packed binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = None, None
        made = lambda: pa.RecordBatch.from_arrays(
            [pa.array([held], pa.int32()), pa.array([np.packbits(sums >= min(least, 65535), bitorder="little").tobytes()], pa.binary())], ["run", "bits"]
        )
        for batch in batches:
            for number, row in zip(batch.column("run").to_pylist(), batch.column("packed")):
                if number != held:
                    if held is not None:
                        yield made()
                    held, sums = number, np.zeros(1 << RUN_BITS, np.int64)
                at, n = _unpack(row.as_py())
                sums[at] += n
        if held is not None:
            yield made()

    summed = packed.repartition("run").sortWithinPartitions("run").mapInArrow(run, "run int, bits binary")
    out = np.zeros(2 << bits - 3, np.uint8)
    for row in shared.stored(summed, "counters").toLocalIterator():
        out[row["run"] << RUN_BITS - 3 : row["run"] + 1 << RUN_BITS - 3] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def windows(docs: DataFrame, bitmap: np.ndarray, counter_bits: np.ndarray, hot: set[int], seed: int, size: int = SIZE) -> DataFrame:
    """``w1..``, ``n`` and ``free``, the words that make the key of a window; 0 pads it."""
    context = docs.sparkSession.sparkContext
    sent, both = context.broadcast(bitmap), context.broadcast(counter_bits)
    schema = ", ".join(f"{c} long" for c in _columns(size)) + ", free int, n long"
    return _work(docs, lambda: Windows(sent.value, both.value, hot, seed, size), schema)


def cut(counted: DataFrame, least: int, size: int = SIZE) -> DataFrame:
    """Windows cut after their last prefix that may reach ``least``, summed: ``w1.., n``.

    A prefix is judged only where all its occurrences share the key of the window.
    """
    names = _columns(size)
    part = F.xxhash64(*(F.when(F.col("free") >= k, F.col(c)) for k, c in enumerate(names, 1)))
    met = counted.withColumn("part", part).repartition("part").sortWithinPartitions("part", *names[:-1])
    for k in range(size - 1, 1, -1):
        met = met.withColumn(f"s{k}", F.sum("n").over(Window.partitionBy("part", *names[:k])))
    kept = F.lit(size)
    for k in range(size - 1, 1, -1):
        kept = F.when((F.col("free") <= k) & (F.col(f"s{k}") < least), k - 1).otherwise(kept)
    met = met.withColumn("kept", kept)
    short = [F.when(F.col("kept") >= k, F.col(c)).otherwise(0).alias(c) for k, c in enumerate(names, 1)]
    return met.select(*short, "n").groupBy(*names).agg(F.sum("n").alias("n"))


def phrases(longest: DataFrame, least: int, size: int = SIZE) -> DataFrame:
    """``p`` (keys of the words) and ``f`` of every phrase up to ``size`` words with ``f >= least``."""
    names = _columns(size)
    level = F.lit(size) - F.bit_count(F.grouping_id())
    summed = longest.rollup(*names).agg(F.sum("n").alias("f"), level.cast("int").alias("k")).filter((F.col("k") > 0) & (F.col("f") >= least))
    return summed.select(F.slice(F.array(*names), 1, F.col("k")).alias("p"), "f").filter(~F.array_contains("p", 0))


def scored(found: DataFrame, lang: DataFrame) -> DataFrame:
    """Candidates ``p, lang, a, l, r, n, score`` by their lowest-scoring cut, the first of equals."""
    # 1000 a n and l r in 38 digits; counts may have 17
    wide = {c: f"CAST({c} AS DECIMAL(17,0))" for c in ("a", "n", "l", "r")}
    whole = "CAST(1000 * {a} * {n} AS DECIMAL(38,0)) div CAST({l} * {r} AS DECIMAL(38,0))".format(**wide)
    size = F.size("p")
    named = found.filter(size > 1).join(lang, F.col("p")[0] == F.col("key")).select("p", "lang", "n", F.col("f").alias("a"))
    parted = named.withColumn("cut", F.explode(F.sequence(F.lit(1), size - 1)))
    parted = parted.withColumn("head", F.slice("p", F.lit(1), F.col("cut"))).withColumn("tail", F.slice("p", F.col("cut") + 1, size - F.col("cut")))
    both = parted.join(found.select(F.col("p").alias("head"), F.col("f").alias("l")), "head").join(found.select(F.col("p").alias("tail"), F.col("f").alias("r")), "tail")
    best = F.min(F.struct(F.expr(whole).alias("score"), "cut", "l", "r")).alias("best")
    return both.groupBy("p", "lang", "a", "n").agg(best).select("p", "lang", "a", "best.l", "best.r", "n", "best.score")


def unabsorbed(candidates: DataFrame, found: DataFrame, percent: int = 100) -> DataFrame:
    """``candidates`` that lie in no longer phrase of ``found`` with ``percent`` of their count."""
    size = F.size("p")
    longer = found.filter(size > 2).withColumn("k", F.explode(F.sequence(F.lit(2), size - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), size - F.col("k") + 1)))
    inside = longer.groupBy(F.slice("p", F.col("at"), F.col("k")).alias("q")).agg(F.max("f").alias("most"))
    return candidates.join(inside, (F.col("p") == F.col("q")) & (100 * F.col("most") >= percent * F.col("a")), "left_anti")


def ranked(candidates: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language, with their texts; rows meet in small groups first."""
    order = [F.desc("score"), F.desc("a")]
    dealt = Window.partitionBy("lang", F.pmod(F.xxhash64("p"), F.lit(DEAL))).orderBy(*order)
    near = candidates.withColumn("place", F.rank().over(dealt)).filter(F.col("place") <= top)
    near = near.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= top).drop("place")
    spelled = near.select("p", F.posexplode("p").alias("at", "key")).join(words.select("key", F.col("word").cast("string").alias("word")), "key")
    text = spelled.groupBy("p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ").alias("phrase"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    full = near.join(text, "p").withColumn("rank", place.cast("long")).filter(F.col("rank") <= top)
    return full.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, percent: int = 100, size: int = SIZE) -> DataFrame:
    """The best phrases of 2 to ``size`` words per language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), parted at ``.,;:!?`` and line ends, and split at spaces and
    tabs. Null and empty texts have no words, a null ``lang`` is ``und``; repeated rows count
    again. Phrases with fewer than ``least`` occurrences are no candidates; those inside a
    longer one with ``percent`` of their count are dropped. Ties of score go to the larger
    count, then to the phrase's bytes. Other columns are not read; an empty table gives no rows.
    """
    words, seed = _checked(docs)
    frequent = shared.stored(words.filter(F.col("n") >= least).select("key", "lang", "word", "n"), "frequent")
    totals = shared.stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    everything = totals.agg(F.sum("n")).first()[0] or 0
    # fewer than HOT + 1 words can each be 1 / HOT of all
    hot = {r["key"] for r in frequent.filter(F.col("n") * HOT >= everything).select("key").collect()}
    bitmap = _bitmap(frequent)
    counted = windows(docs, bitmap, counters(docs, bitmap, seed, everything, least), hot, seed, size)
    longest = shared.stored(cut(counted, least, size), "windows")
    found = shared.stored(phrases(longest, least, size), "phrases")
    lang = frequent.select("key", "lang").join(totals, "lang")
    left = unabsorbed(scored(found, lang), found, percent)
    return ranked(shared.stored(left, "scored"), frequent, top)
