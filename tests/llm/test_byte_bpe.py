from __future__ import annotations

import hashlib
from random import Random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from edgelog.llm import byte_bpe as B

from .helpers import awkward, none

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=B.load_ranks(PATH), special_tokens={})


ENCODER, DECODER = B.Encoder(PATH, PATTERN), B.Decoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text("abcdefgilnorst '", max_size=60) | st.text("a= \n", max_size=200))
def test_ids_are_those_of_the_definition_and_decode_again(text):
    ids = ENCODER.encode(text)
    ranks = B.load_ranks(PATH)
    assert ids.tolist() == [i for piece in ENCODER.split(text) for i in B.merge(piece.encode("utf-8", "surrogatepass"), ranks)]
    assert DECODER.decode(ids) == (text.encode("utf-8", "surrogatepass"), True)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50255), max_size=30))
def test_streaming_yields_whole_characters(ids):
    parts = list(DECODER.stream(ids))
    whole = b"".join(DECODER.table[i] for i in ids)
    assert b"".join(parts) == whole
    if DECODER.decode(__import__("numpy").array(ids, "int64"))[1]:
        whole.decode()
        for part in parts:
            part.decode()
    else:
        with pytest.raises(UnicodeDecodeError):
            whole.decode()


def test_every_document_as_the_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(awkward(spark).select("doc_id", "text"))
    got = sorted((tuple(r) for r in B.round_trip(docs, PATH, PATTERN).collect()), key=repr)
    want = []
    for row in docs.collect():
        ids = library.encode_ordinary(row.text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (row.text or "").encode())]
        want.append((row.doc_id, len(ids), *sha))
    assert got == sorted(want, key=repr)


def test_long_texts_are_cut_where_no_match_crosses(library, monkeypatch):
    monkeypatch.setattr(B, "SEGMENT", 50)
    text = "ab  cd 12 ef  \n gh're " * 30 + "x" * 400 + " y z"
    assert ENCODER.encode(text).tolist() == library.encode_ordinary(text)


def test_columns_stay_and_clashing_ones_are_replaced(spark):
    docs = awkward(spark).withColumnRenamed("score", "ids")
    coded = B.encode(docs, PATH, PATTERN)
    assert sorted(coded.columns) == sorted(docs.columns)
    assert B.encode(none(spark), PATH, PATTERN).count() == 0
    assert [r.ids for r in coded.filter("doc_id = 3").collect()] == [[]]


def test_full_tables_start_anew(library, monkeypatch):
    monkeypatch.setattr(B, "MAX_MATCHES", 3)
    monkeypatch.setattr(B, "MAX_ARCS", 5)
    small = B.Encoder(PATH, PATTERN)
    text = "several different words that repeat: several different words, unlike others"
    assert small.encode(text).tolist() == library.encode_ordinary(text)


def test_vocabulary_that_merging_cannot_reach():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256}
    assert B.Transducer(ranks).encode(b"abcabc") == B.merge(b"abcabc", ranks)


def test_unknown_id_is_an_error(spark):
    with pytest.raises(Exception, match="outside the vocabulary"):
        B.decode(spark.createDataFrame([([60000],)], "ids array<int>"), PATH).collect()


def test_tokens_stay_apart_by_their_last_merges_without_merging_all_bytes(monkeypatch):
    ranks, calls = B.load_ranks(PATH), []
    machine = B.Transducer(ranks)
    short = [rank for token, rank in ranks.items() if len(token) < 5][::37]
    pairs = [(a, b) for a in short for b in short[::5]] + [(ranks[t[:2]], ranks[t[2:]]) for t in list(ranks)[::29] if t[:2] in ranks and t[2:] in ranks]
    want = [B.merge(machine.tokens[a] + machine.tokens[b], ranks) == [a, b] for a, b in pairs]
    monkeypatch.setattr(B, "merge", lambda *args, made=B.merge: calls.append(args) or made(*args))
    assert [machine.tolerates(a, b) for a, b in pairs] == want and len(set(want)) == 2
    assert len(calls) < len(pairs) / 4  # one for each token, not one for each pair


def test_small_vocabularies_as_the_definition():
    random = Random(3)
    for _ in range(100):
        ranks, pool = {bytes([b]): b for b in range(256)}, [b"a", b"b"]
        for _ in range(random.randint(1, 12)):
            new = random.choice(pool) + random.choice(pool)
            if new not in ranks:
                ranks[new] = len(ranks)
                pool.append(new)
        machine = B.Transducer(ranks)
        for _ in range(30):
            piece = bytes(random.choices(b"ab", k=random.randint(1, 14)))
            assert machine.encode(piece) == ([ranks[piece]] if piece in ranks else B.merge(piece, ranks))


def test_a_worker_keeps_no_machine_beyond_its_task(spark):
    def held(batches):
        from edgelog.llm import byte_bpe

        for batch in batches:
            yield batch.set_column(0, "n", pa.array([len(byte_bpe._MADE)] * batch.num_rows, pa.int64()))

    one = spark.range(1).coalesce(1)
    B.encode(one.withColumn("text", F.lit("several words")), PATH, PATTERN, decoded="decoded").collect()
    assert [r.n for r in one.mapInArrow(held, "n long").collect()] == [0]


def test_a_worker_keeps_no_ranks_beyond_its_task(spark):
    def held(batches):
        from edgelog.llm import byte_bpe

        for batch in batches:
            yield batch.set_column(0, "n", pa.array([byte_bpe.load_ranks.cache_info().currsize] * batch.num_rows, pa.int64()))

    one = spark.range(1).coalesce(1)
    B.encode(one.withColumn("text", F.lit("several words")), PATH, PATTERN).collect()
    assert [r.n for r in one.mapInArrow(held, "n long").collect()] == [0]
