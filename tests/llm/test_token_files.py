from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from edgelog.llm import shared, token_files as T

from .helpers import awkward, none

PATH = public_tokenizers.path("word_bpe_49k.json")
CODER = T.Coder(PATH)


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


def brute(rows, library, end=1):
    """Per row in order: id, ids before it, its ids."""
    out, start = [], 0
    for doc, text in rows:
        ids = library(text) + [end]
        out.append((doc, start, ids))
        start += len(ids)
    return out


def stored(spark, docs, **options):
    base = shared.scratch(spark, "test-tokens")
    T.write(docs, base, PATH, **options)
    return base


def rows(df):
    return [(r.doc_id, r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in df.collect()]


def test_words_encode_as_the_library_does_whole_texts(library):
    coder = T.Coder(PATH)
    odd = [
        "It's they'll WE'VE  don't", "ΣΑΣ ΟΔΟΣ σ", "é ́x a ̀", "İstanbul ǅ ß ẞ", "汉字 ひらがな 한국어", "a b c　d\u0085e",
        "a,b (c)d e_f 1.5m x,'s ,'s it's, l'été, été. ½% ²) Ⅷ! ªº; ä́, é̸<≠ x≮y ≠", "İ,ß.ſ;ŉ!ǰ?ΐ:ﬃ ﬀ.", "ａ，ｂ. 𝐀, 𝟙. 漢. 가, ㄱ.", "aǅb Ab,Cd A.B.C.",
        "x\x1cy\x1dz\x00w", "1234 5.6 ²³ ½", "😀👍🏽 e‍x", "<|endoftext|> <|startoftext|>x", "가 ᆨ", "Å Ω", "-- ...?!'s 's", "\t\n\v\f\r ", "",
    ]
    for text in odd + [" ".join(odd)]:
        assert np.frombuffer(coder.encode(text.encode()), "<u4").tolist() == library(text), text
    bodies = [t.encode() for t in odd]
    assert T.Coder(PATH).encode_all(bodies) == [coder.encode(b) for b in bodies]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from("aZ'.,_ éσ̸́<1½"), max_size=30))
def test_any_text_encodes_as_the_library_does(text):
    assert np.frombuffer(CODER.encode(text.encode()), "<u4").tolist() == CODER.tokenizer.encode(text, add_special_tokens=False).ids


def test_files_hold_every_text_in_order(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute(sorted((r.doc_id, r.text) for r in docs.collect()), library)
    base = stored(spark, docs, shard_bytes=20_000)
    assert sorted(rows(T.read(spark, base))) == want
    assert spark.read.parquet(f"{base}/shards").count() > 3
    told = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in T.report(docs, PATH).collect()}
    assert told == {d: (s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, s, i in want}


def test_a_short_document_is_read_by_its_byte_range(spark, sf, library, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    base = stored(spark, docs)
    want = {d: (s, i) for d, s, i in brute(sorted((r.doc_id, r.text) for r in docs.collect()), library)}
    assert {d: (s, i) for d, s, i in rows(T.read(spark, base, [3, 77, 10**9]))} == {d: want[d] for d in (3, 77)}
    plan = T.read(spark, base, [3])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [EqualTo(doc_id,3)" in plan or "In(doc_id" in plan or "EqualTo(doc_id" in plan


def test_the_dictionary_helps_and_is_checked(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    base = stored(spark, docs)
    size = lambda b: spark.read.parquet(f"{b}/index").agg(F.sum("length")).first()[0]
    plain = T.frames(docs, PATH, b"").agg(F.sum(F.octet_length("frame"))).first()[0]
    assert size(base) < 0.9 * plain
    other = stored(spark, docs.limit(40))
    spark.read.parquet(f"{other}/dictionary").write.mode("overwrite").parquet(f"{base}-x/dictionary")
    for name in ("index", "shards"):
        spark.read.parquet(f"{base}/{name}").write.parquet(f"{base}-x/{name}")
    system, folder = pafs.FileSystem.from_uri(base)
    system.create_dir(f"{folder}-x/data")
    pafs.copy_files(f"{folder}/data", f"{folder}-x/data", source_filesystem=system, destination_filesystem=system)
    with pytest.raises(Exception, match="not written under this dictionary"):
        T.read(spark, f"{base}-x").count()


def test_awkward_rows_hot_ids_and_empty_tables(spark, library):
    docs = awkward(spark).withColumnRenamed("score", "mark").withColumnRenamed("source", "frame").withColumnRenamed("n_chars", "n_tokens")
    found = sorted(rows(T.read(spark, stored(spark, docs))), key=lambda r: r[1])
    ids = [r[0] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert sorted(map(repr, ((r[0], r[2]) for r in found))) == sorted(repr((r.doc_id, library(r.text) + [1])) for r in docs.collect())
    at = 0
    for _, start, held in found:
        assert start == at
        at += len(held)
    base = stored(spark, none(spark))
    assert T.read(spark, base).collect() == [] and T.report(none(spark), PATH).collect() == []
    hot = spark.range(600).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    base = stored(spark, hot, shard_bytes=2000)
    assert spark.read.parquet(f"{base}/shards").count() > 2
    assert sorted(i for _, _, i in rows(T.read(spark, base))) == sorted(library(r.text) + [1] for r in hot.collect())


def test_without_an_end_id(spark, library):
    docs = spark.createDataFrame([(1, ""), (2, "a b"), (3, None)], "doc_id long, text string")
    assert sorted(rows(T.read(spark, stored(spark, docs, end=None)))) == [(1, 0, []), (2, 0, library("a b")), (3, 2, [])]


def test_a_full_table_of_words_is_emptied(monkeypatch, library):
    monkeypatch.setattr(T, "KNOWN_WORDS", 5)
    coder = T.Coder(PATH)
    for text in (" ".join(f"word{i}" for i in range(200)), "word3 word4 new", "x" * 5000, "word3"):
        assert np.frombuffer(coder.encode(text.encode()), "<u4").tolist() == library(text)
    assert len(coder.known) < 10 and len(coder.older) < 210
