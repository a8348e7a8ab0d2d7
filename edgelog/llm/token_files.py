"""Token ids of documents in binary files, compressed one by one under a shared dictionary.

A corpus of token ids lies in a folder:

    data/shard-<number>-<attempt>.bin   magic, hash of the dictionary, then a zstandard
                                        frame per document, in ascending order of the id
    index                               Parquet: where each document's frame lies
    shards                              Parquet: ids before each shard, its file and sizes
    dictionary                          Parquet: one row, the dictionary and its SHA-256

Ids are little-endian unsigned 32-bit integers, the end id last. The dictionary is trained
on the serialized ids of a bounded sample, so that a short document compresses nearly as
well alone as in a block and is read without its neighbours: its index row gives the byte
range.

Documents are encoded and compressed where they lie; only frames are shuffled. A task
writes a file under a name of its own attempt and hands its index rows to Spark, which
commits them once: a task that runs again or twice leaves a file that no index row names.
``data`` is written by tasks through ``pyarrow.fs``, so the folder's URI must be one that
it opens (``file:``, ``hdfs:``, ``s3:``, ``gs:`` and others), shared by all executors.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from edgelog.llm import shared

MAGIC = b"EDGETOK1"
HEADER = len(MAGIC) + 32
#: The sample a dictionary is trained on: texts of so many ids, none above ``SAMPLE_TEXT`` bytes.
SAMPLE_ROWS = 2000
SAMPLE_TEXT = 16 << 10
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
#: Bytes of frames per file, about; bytes read from one at once.
SHARD_BYTES = 64 << 20
READ_BYTES = 4 << 20
#: Words a worker keeps, in each of two generations; texts up to this many bytes are worked on at once, and so many of them learnt from.
KNOWN_WORDS = 600_000
PIECE = 1 << 20
TOGETHER = 64


#: A cut that joins nothing: between a letter or digit and ASCII punctuation, but for the apostrophe of contractions. The
#: letters are Latin, Greek and Cyrillic ones, which stay letters under normal form and lower case, all but U+0130.
_WORD = r"[^\W_\u0130\u0250-\u036F\u0530-\U0010FFFF]"
_POINT = r"[!-&(-/:-@\[-`{-~]"
_CUT = re.compile(f"(?<={_WORD})(?={_POINT})|(?<={_POINT})(?={_WORD})")


class Coder:
    """Whole texts to serialized ids, by the tokenizer in ``path``.

    The tokenizer drops white space and joins nothing across it, nor letters and digits with the
    punctuation beside them. So words between ASCII white space, and their parts between such
    cuts, are encoded by themselves, by the library, and kept while they fit in bounds. Parts that
    are letters only go to the library many at a time: each is one word to it, whose last
    token is one that ends words; where the count of those differs, parts go one by one.
    Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # words are kept here
        names = self.tokenizer.get_vocab()
        self.last = np.zeros(max(names.values()) + 1, bool)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last[[i for name, i in names.items() if suffix and name.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(made.ids, "<u4").tobytes() for made in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of letters only."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(texts) or (len(ends) and ends[-1] != len(ids)):
            return self._library(texts)
        raw, at = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [raw[a:b] for a, b in zip(at[:-1], at[1:])]

    def _learn(self, words: Iterable[bytes]) -> None:
        """Make all of ``words`` known; what was known is kept for one more generation."""
        if len(self.known) > KNOWN_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        letters: dict[bytes, str] = {}
        other: dict[bytes, str] = {}
        cut: dict[bytes, list[bytes]] = {}
        for word in words:
            if word in known:
                continue
            if word in older:
                known[word] = older[word]
            elif word.isalpha() or (text := word.decode("utf-8", "replace")).isalpha():
                letters[word] = word.decode()
            else:
                parts = _CUT.split(text)
                if len(parts) == 1:
                    other[word] = text
                    continue
                cut[word] = raws = [p.encode() for p in parts]
                for raw, part in zip(raws, parts):
                    if raw in known:
                        continue
                    if raw in older:
                        known[raw] = older[raw]
                    else:
                        (letters if part.isalpha() else other)[raw] = part
        known.update(zip(letters, self._words(list(letters.values()))))
        known.update(zip(other, self._library(list(other.values()))))
        for word, raws in cut.items():
            known[word] = b"".join(map(known.__getitem__, raws))

    def _ids(self, words: list[bytes]) -> bytes:
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            self._learn(dict.fromkeys(words))
            return b"".join(map(self.known.__getitem__, words))

    def encode(self, body: bytes) -> bytes:
        return b"".join(self._ids(piece.split()) for piece in shared.spaced(body, PIECE))

    def encode_all(self, bodies: list[bytes]) -> list[bytes]:
        """Of many texts; the words that are new to short ones are learnt together."""
        made: list[bytes] = []
        for start in range(0, len(bodies), TOGETHER):
            some = bodies[start : start + TOGETHER]
            words = [b.split() if len(b) <= PIECE else None for b in some]
            self._learn(set().union(*filter(None, words)).difference(self.known))
            made += [self.encode(b) if w is None else self._ids(w) for b, w in zip(some, words)]
        return made


_CODERS: dict[str, Coder] = {}


def _coder(path: str) -> Coder:
    """One per Python worker, kept over its tasks."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def _end(end: int | None) -> bytes:
    return b"" if end is None else np.array([end], "<u4").tobytes()


def train(docs: DataFrame, path: str, end: int | None = 1, text: str = "text") -> bytes:
    """A dictionary for the ids of ``docs``; empty where the sample is too small to train one.

    The sample is a text each of the ``SAMPLE_ROWS`` ids of smallest hash, but for those above
    ``SAMPLE_TEXT`` bytes. One task trains; the driver gets ``DICTIONARY_BYTES`` at most.
    """
    shared.bound_batches(docs.sparkSession)
    slim = docs.select(F.xxhash64("doc_id").alias("mark"), F.col(text).cast("binary").alias("body"))
    bound = slim.select("mark").distinct().orderBy("mark").limit(SAMPLE_ROWS).agg(F.max("mark")).first()[0]
    if bound is None:
        return b""
    chosen = slim.filter((F.col("mark") <= bound) & F.octet_length("body").between(1, SAMPLE_TEXT)).groupBy("mark").agg(F.min("body").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        samples = [ids + _end(end) for batch in batches for ids in coder.encode_all(batch.column("body").to_pylist())]
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples)).as_bytes()
        except zstandard.ZstdError:
            made = b""
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["dictionary"])

    rows = chosen.select("body").repartition(1).mapInArrow(run, "dictionary binary").collect()
    return bytes(rows[0]["dictionary"]) if rows else b""


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def frames(docs: DataFrame, path: str, dictionary: bytes, end: int | None = 1, text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, frame`` of every whole text; null and empty ones have the end id only."""
    shared.bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, last = _coder(path), _end(end)
        held = _dictionary(dictionary)
        if held is not None:
            held.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=held)
        for batch in batches:
            ids = [i + last for i in coder.encode_all([b or b"" for b in batch.column("body").to_pylist()])]
            counts = pa.array([len(i) // 4 for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, pa.array(map(press.compress, ids), pa.binary())], ["doc_id", "n_tokens", "frame"])

    return docs.select("doc_id", F.col(text).cast("binary").alias("body")).mapInArrow(run, f"doc_id {kind}, n_tokens long, frame binary")


def write(docs: DataFrame, base: str, path: str, end: int | None = 1, text: str = "text", shard_bytes: int = SHARD_BYTES) -> None:
    """Write the token ids of ``docs`` to the folder ``base``, in ascending order of ``doc_id``.

    Null ids come first; rows that share an id, equal ones too, all stay, in the order of their
    frames' hashes and bytes. An empty table leaves empty tables and no file. Other columns are
    not read. ``base`` must be new.
    """
    spark = docs.sparkSession
    dictionary = train(docs, path, end, text)
    told = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(told, dictionary)], "hash binary, dictionary binary").coalesce(1).write.parquet(f"{base}/dictionary")
    made = shared.stored(frames(docs, path, dictionary, end, text), "frames")
    size = made.agg(F.sum(F.octet_length("frame").cast("long"))).first()[0] or 0
    place = ["doc_id", "mark", "frame"]
    # the hash splits the rows of a hot id over several files
    marked = made.withColumn("mark", F.xxhash64("frame"))
    dealt = marked.repartitionByRange(max(1, -(-size // shard_bytes)), "doc_id", "mark").sortWithinPartitions(*place).drop("mark")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.bin"
        rows, out, at, before = [], None, HEADER, 0
        system, folder = pafs.FileSystem.from_uri(base)
        for batch in batches:
            if batch.num_rows and out is None:
                system.create_dir(f"{folder}/data", recursive=True)
                out = system.open_output_stream(f"{folder}/data/{name}")
                out.write(MAGIC + told)
            lengths = []
            for frame in batch.column("frame"):
                out.write(frame.as_buffer())
                lengths.append(len(frame.as_buffer()))
            counts = batch.column("n_tokens").to_numpy()
            ends, ids = at + np.cumsum(lengths, dtype=np.int64), before + np.cumsum(counts, dtype=np.int64)
            same = pa.array([shard] * batch.num_rows, pa.int32())
            columns = [batch.column("doc_id"), same, pa.array([name] * batch.num_rows, pa.string()), pa.array(ends - lengths), pa.array(np.array(lengths, np.int64)), pa.array(counts), pa.array(ids - counts)]
            rows.append(pa.RecordBatch.from_arrays(columns, ["doc_id", "shard", "file", "offset", "length", "n_tokens", "before"]))
            if batch.num_rows:
                at, before = int(ends[-1]), int(ids[-1])
        if out is not None:
            out.close()
        yield from rows  # a file is whole before Spark sees a row of its index

    schema = f"doc_id {kind}, shard int, file string, offset long, length long, n_tokens long, before long"
    dealt.mapInArrow(run, schema).write.parquet(f"{base}/index")
    index = spark.read.parquet(f"{base}/index")
    totals = index.groupBy("shard", "file").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"), F.sum("length").alias("bytes"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    totals.withColumn("start", F.coalesce(F.sum("tokens").over(ahead), F.lit(0))).write.parquet(f"{base}/shards")


def read(spark: SparkSession, base: str, ids: list | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of the folder ``base``, or of the ``ids`` named.

    ``ids`` are the serialized ids, ``start`` is the number of ids before them in the corpus.
    Only the byte ranges of the documents wanted are read. A file under another dictionary and
    a frame that does not hold what the index says are errors.
    """
    held = spark.read.parquet(f"{base}/dictionary").first()
    raw, told = bytes(held["dictionary"]), bytes(held["hash"])
    if hashlib.sha256(raw).digest() != told:
        raise ValueError("the dictionary does not match its hash")
    index = spark.read.parquet(f"{base}/index")
    if ids is not None:
        index = index.filter(F.col("doc_id").isin(ids))
    shards = spark.read.parquet(f"{base}/shards").select("shard", "start")
    rows = index.join(shards, "shard").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "file", "offset", "length")
    kind = index.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = pafs.FileSystem.from_uri(base)
        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
        file, opened = None, None
        for batch in batches:
            names, offsets, lengths, counts = (batch.column(c).to_pylist() for c in ("file", "offset", "length", "n_tokens"))
            for a, b in _runs(names, offsets, lengths, counts):
                if names[a] != file:
                    if opened is not None:
                        opened.close()
                    file, opened = names[a], system.open_input_file(f"{folder}/data/{names[a]}")
                    if opened.read_at(HEADER, 0) != MAGIC + told:
                        raise ValueError(f"{names[a]} was not written under this dictionary")
                body, made = opened.read_at(offsets[b - 1] + lengths[b - 1] - offsets[a], offsets[a]), []
                for i in range(a, b):
                    at = offsets[i] - offsets[a]
                    made.append(expand.decompress(body[at : at + lengths[i]]) if lengths[i] else b"")
                    if len(made[-1]) != 4 * counts[i]:
                        raise ValueError(f"a frame of {names[a]} does not hold what the index says")
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(made, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
        if opened is not None:
            opened.close()

    return rows.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary")


def _runs(names: list[str], offsets: list[int], lengths: list[int], counts: list[int]) -> Iterator[tuple[int, int]]:
    """Rows whose frames lie behind each other in one file, up to ``READ_BYTES`` of ids at once."""
    start, size = 0, 0
    for i in range(len(names)):
        broken = i > start and (names[i] != names[i - 1] or offsets[i] != offsets[i - 1] + lengths[i - 1])
        if i > start and (broken or size + 4 * counts[i] > READ_BYTES):
            yield start, i
            start, size = i, 0
        size += 4 * counts[i]
    if names:
        yield start, len(names)


def report(docs: DataFrame, path: str, end: int = 1) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens`` and the CRC-32 of its ids' bytes."""
    base = shared.scratch(docs.sparkSession, "tokens")
    write(docs, base, path, end)
    found = read(docs.sparkSession, base)
    return found.select("doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
