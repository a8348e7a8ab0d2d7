"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding.

A rank file lists tokens by merge order. A token sequence is the encoding of its bytes
exactly if every two neighbours stay apart when merged on their own. So the machine's
state is the last token, and from it any token may follow that the state tolerates and
the next bytes spell: not yet deterministic, as several spell their beginning. An arc is
determinised when it is first needed: the lookahead runs along the token trie as far as
the bytes go, which is bounded by the longest token, and the arc for that state and the
longest token it saw is the longest of that token's prefixes the state tolerates. That is emitted;
where the next state then has no arc, which the next lookahead shows, it is taken back for
the next shorter one. One path only can arrive.

Whether two tokens stay apart is told by undoing their last merges, the later one first: they do if
no pair that comes to face each other would have merged before. That is a few lookups, not a merge of all bytes.

Texts are split by a pattern first and each match is encoded by itself. Matches repeat, so
their ids are kept in a bounded table per task.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from edgelog.llm import shared

#: Entries of a generation of encoded matches, and of the tables of the machine; bytes of
#: a batch that are worked on at once.
MAX_MATCHES = 60_000
MAX_ARCS = 250_000
PART_BYTES = 1 << 20
#: Characters that are split at once; longer texts are cut where no match can cross.
SEGMENT = 1 << 20
#: Key of a trie node that is no byte.
LONGEST = -1


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens of a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int], below: int = 1 << 60) -> list[int]:
    """The definition: join the neighbours of lowest rank, leftmost first, until none is a token (``below`` that rank)."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if best >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Encodes one match at a time; see the module's text for the construction."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        #: Trie of byte to node; at LONGEST a node has the longest token on the way to it, else -1.
        self.trie: dict = {LONGEST: -1}
        #: The longest token that begins a token.
        self.shorter: dict[int, int] = {}
        for token in sorted(filter(None, ranks), key=len):
            node = self.trie
            for byte in token:
                above = node[LONGEST]
                if byte not in node:
                    node[byte] = {LONGEST: above}
                node = node[byte]
            self.shorter[ranks[token]] = above
            node[LONGEST] = ranks[token]
        self.base = max(self.tokens, default=0) + 2
        self.halves: dict[int, tuple[int, int]] = {}
        self.arcs: dict[int, int] = {}  # base * longest token seen + last token + 1: token to emit, else -1

    def _halves(self, token: int) -> tuple[int, int]:
        """The tokens whose merge makes ``token``: a byte twice for itself, -1 where merging makes it otherwise or not at all."""
        found = self.halves.get(token)
        if found is None:
            parts = merge(self.tokens[token], self.ranks, token)
            found = self.halves[token] = (parts[0], parts[-1]) if len(parts) < 3 else (-1, -1)
        return found

    def tolerates(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``; nothing (-1) tolerates everything."""
        if left < 0:
            return True
        rank, tokens, halves, a, b = self.ranks.get, self.tokens, self.halves.get, left, right
        limit = 1 << 60  # merges from here on come after what is undone
        while rank(tokens[a] + tokens[b], limit) >= limit:
            before, behind = (halves(a) or self._halves(a))[1], (halves(b) or self._halves(b))[0]
            if before < 0 or behind < 0:
                return merge(tokens[left] + tokens[right], self.ranks) == [left, right]
            if before == a and behind == b:
                return True
            # of equal merges the leftmost comes first
            if behind == b or a > b and before != a:
                limit, a = a, before
            else:
                limit, b = b + 1, behind
        return False

    def _next(self, left: int, token: int) -> int:
        """The longest beginning of ``token`` that the state ``left`` tolerates, else -1."""
        while token >= 0 and not self.tolerates(left, token):
            token = self.shorter[token]
        return token

    def _determinise(self, left: int, seen: int) -> int:
        """The token the state ``left`` emits where ``seen`` is the longest token ahead."""
        if len(self.arcs) > MAX_ARCS:
            self.arcs.clear()
        found = self.arcs[self.base * seen + left + 1] = self._next(left, seen)
        return found

    def encode(self, piece: bytes) -> list[int]:
        trie, arcs, base, size, tokens = self.trie, self.arcs.get, self.base, len(piece), self.tokens
        out: list[int] = []
        dead: set[tuple[int, int]] = set()
        at, left = 0, -1
        while at < size:
            node = trie
            for byte in islice(piece, at, None) if at else piece:
                to = node.get(byte)
                if to is None:
                    break
                node = to
            seen = node[LONGEST]
            token = arcs(base * seen + left + 1)
            if token is None:
                token = self._determinise(left, seen)
            # a dead end: the state before takes its next shorter token
            while token < 0 or dead and (at + len(tokens[token]), token) in dead:
                if token < 0:
                    if not out:  # a vocabulary that merging alone cannot produce
                        return merge(piece, self.ranks)
                    dead.add((at, left))
                    token = out.pop()
                    at -= len(tokens[token])
                    left = out[-1] if out else -1
                token = self._next(left, self.shorter[token])
            out.append(token)
            at, left = at + len(tokens[token]), token
        return out


class Matches(dict):
    """Match to its ids, packed. Two generations bound it: what is used again moves on."""

    def __init__(self, ranks: dict[bytes, int]):
        self.transducer = Transducer(ranks)
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.before.get(piece)
        if packed is None:
            packed = array("i", self.transducer.encode(piece.encode())).tobytes()
        if len(piece) <= 64:
            if len(self) >= MAX_MATCHES:
                self.before = dict(self)
                self.clear()
            self[piece] = packed
        return packed


_CUT = regex.compile(r"(?<=\p{L})(?= \p{L})")


def segments(text: str) -> Iterator[str]:
    """Parts of a long text, cut only before a space between letters, where a match starts."""
    at = 0
    while len(text) - at > SEGMENT:
        cut = _CUT.search(text, at + SEGMENT)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.split = regex.compile(pattern).findall
        self.matches = Matches(load_ranks(path))

    def encode(self, text: str) -> np.ndarray:
        look = self.matches.__getitem__
        return np.frombuffer(b"".join(b"".join(map(look, self.split(part))) for part in segments(text)), np.int32)


#: Lead bytes of UTF-8 and the continuation bytes that follow: first lead, last lead, number
#: of bytes to come, lowest and highest next byte. Fixed values of the encoding.
UTF8_LEADS = [
    (0x00, 0x7F, 0, 0x00, 0x00), (0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF),
    (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF1, 0xF3, 3, 0x80, 0xBF),
    (0xF4, 0xF4, 3, 0x80, 0x8F),
]
#: State of the machine between characters: nothing to come.
DONE = (0, 0, 0)


def utf8_step(state: tuple[int, int, int], byte: int) -> tuple[int, int, int] | None:
    """Next state (bytes to come, lowest and highest next byte); None if the byte cannot stand here."""
    left, low, high = state
    if left:
        return ((left - 1, 0x80, 0xBF) if left > 1 else DONE) if low <= byte <= high else None
    for first, last, more, low, high in UTF8_LEADS:
        if first <= byte <= last:
            return (more, low, high) if more else DONE
    return None


class Decoder:
    """Ids to bytes; the UTF-8 machine runs over ids that do not end between characters."""

    def __init__(self, path: str):
        tokens = {rank: token for token, rank in load_ranks(path).items()}
        self.table = [tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)]
        self.closed = np.array([self._run(DONE, t) == DONE for t in self.table], bool)
        self.steps: dict[tuple[tuple[int, int, int], int], tuple[int, int, int] | None] = {}

    @staticmethod
    def _run(state: tuple[int, int, int] | None, token: bytes) -> tuple[int, int, int] | None:
        for byte in token:
            if state is None:
                return None
            state = utf8_step(state, byte)
        return state

    def step(self, state: tuple[int, int, int], token: int) -> tuple[int, int, int] | None:
        if (state, token) not in self.steps:
            self.steps[state, token] = self._run(state, self.table[token])
        return self.steps[state, token]

    def stream(self, ids: Iterable[int]) -> Iterator[bytes]:
        """Bytes as soon as they end a character; malformed bytes pass as they are."""
        state, held = DONE, b""
        for token in ids:
            held += self.table[token]
            state = self.step(state, token)
            if state is None or state == DONE:
                yield held
                state, held = DONE, b""
        if held:
            yield held

    def decode(self, ids: np.ndarray) -> tuple[bytes, bool]:
        """All bytes, and whether they are well-formed UTF-8."""
        state: tuple[int, int, int] | None = DONE
        before = -1
        for at in np.flatnonzero(~self.closed[ids]).tolist():
            if state is None or (state != DONE and at != before + 1):
                state = None
                break
            state, before = self.step(state, int(ids[at])), at
        valid = state == DONE
        values = iter(ids.tolist())
        parts = []
        while part := list(islice(values, 1 << 16)):
            parts.append(b"".join(map(self.table.__getitem__, part)))
        return b"".join(parts), valid


_MADE: dict[tuple, object] = {}


def _own(kind: Callable, *args: str) -> object:
    """One machine per task; a worker lives on for tasks of other stages, so it goes with the task."""
    if (kind, args) not in _MADE:
        _MADE[kind, args] = kind(*args)
    return _MADE[kind, args]


def _forget() -> None:
    _MADE.clear()
    load_ranks.cache_clear()


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``PART_BYTES``, so that a worker holds the results of few rows."""
    rows = max(1, batch.num_rows * PART_BYTES // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _with_columns(df: DataFrame, new: dict[str, T.DataType], work: Callable, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without ``drop`` and with columns that ``work`` makes from each Arrow batch."""
    kept = [f for f in df.schema.fields if f.name not in new and f.name not in drop]
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t in new.items())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in (part for whole in batches for part in _parts(whole)):
                made = work(batch)
                columns = [made[f.name] if f.name in new else batch.column(f.name).cast(f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)
        finally:
            _forget()

    shared.bound_batches(df.sparkSession)
    return df.mapInArrow(shared.released(run), schema)


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None, drop: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with the token ids of each whole text in column ``ids`` (array of int).

    Null and empty texts have no ids. Rows, repeated ones too, and other columns stay as
    they are; a column already named ``ids`` is replaced. Special tokens are never made:
    their strings are ordinary text. ``path`` must exist on every executor. With ``decoded``
    the ids are decoded again, to bytes in that column; columns in ``drop`` go.
    """
    new: dict[str, T.DataType] = {ids: T.ArrayType(T.IntegerType())} | ({decoded: T.BinaryType()} if decoded else {})

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        encoder = _own(Encoder, path, pattern)
        rows = [encoder.encode(t) if t else np.zeros(0, np.int32) for t in batch.column(text).to_pylist()]
        ends = np.cumsum([0, *map(len, rows)])
        flat = pa.array(np.concatenate([*rows, np.zeros(0, np.int32)]))
        made = {ids: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)}
        if decoded:
            decoder = _own(Decoder, path)
            made[decoded] = pa.array([decoder.decode(row)[0] for row in rows], pa.binary())
        return made

    return _with_columns(docs, new, work, drop)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded", valid: str = "valid_utf8") -> DataFrame:
    """``df`` with the bytes of ``ids`` in ``out`` and whether they are UTF-8 in ``valid``; ``ids`` goes.

    Null ids decode to no bytes. An id outside the vocabulary is an error.
    """

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        decoder = _own(Decoder, path)
        column = batch.column(ids)
        ends = column.offsets.to_numpy(zero_copy_only=False)
        flat = column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        if len(flat) and (flat.min() < 0 or flat.max() >= len(decoder.table)):
            raise ValueError("a token id lies outside the vocabulary")
        made = [decoder.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        return {out: pa.array([b for b, _ in made], pa.binary()), valid: pa.array([v for _, v in made], pa.bool_())}

    return _with_columns(df, {out: T.BinaryType(), valid: T.BooleanType()}, work, (ids,))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of tokens and digests of its ids and of the bytes they decode to."""
    coded = encode(docs.select("doc_id", "text"), path, pattern, decoded="decoded", drop=("text",))
    told = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(told, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
