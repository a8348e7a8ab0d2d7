from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from edgelog.llm import exact_dedup as X, shared

from .helpers import awkward, none


def brute(rows):
    groups: dict[str, list] = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def report(docs):
    return sorted((tuple(r) for r in X.report(docs).collect()), key=repr)


def test_documents_and_awkward_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(awkward(spark).selectExpr("doc_id + 100000", "text"))
    assert report(docs) == brute([tuple(r) for r in docs.collect()])
    assert report(none(spark)) == []


@pytest.mark.parametrize("weak", [lambda c: F.lit("same"), lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1)])
def test_full_bytes_decide_when_digests_collide(spark, weak):
    docs = awkward(spark)
    want = [(r[0], r[1], r[2], r[3]) for r in brute([(r.doc_id, r.text) for r in docs.collect()])]
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in X.groups(docs, weak).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_kept_rows_and_columns(spark):
    docs = awkward(spark).withColumnRenamed("score", "normal").withColumnRenamed("source", "digest")
    left = X.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect())) == [1, 3, 5, 6, 6, 7, 8]


def test_short_hashes_alone_drop_nothing(spark, monkeypatch):
    """Null-id texts whose 32-bit marks equal those of dropped rows stay."""
    from pyspark.sql import functions as real

    rows = [(1, "a b"), (None, "a b"), (None, "only here"), (2, "c"), (2, "d"), (0, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("hash", "xxhash64"):
        monkeypatch.setattr(real, name, (lambda kind: lambda *_: real.lit(1).cast(kind))("int" if name == "hash" else "long"))
    left = X.deduplicate(docs).collect()
    assert sorted(map(tuple, left), key=repr) == sorted([(1, "a b"), (None, "only here"), (2, "c"), (0, "d")], key=repr)


def test_state_goes_on_over_runs(spark):
    base = shared.scratch(spark, "state")
    rows = lambda pairs: spark.createDataFrame(pairs, "doc_id long, text string")
    slim = X.feed(rows([(5, "a b"), (7, "c")]))
    for part in (rows([(5, "a b"), (7, "c")]), rows([(3, "a  b"), (9, "a b")]), rows([(1, "d")])):
        X.feed(part).write.mode("append").parquet(f"{base}/feed")
        stream = spark.readStream.schema(slim.schema).parquet(f"{base}/feed")
        X.observe(stream, f"{base}/checkpoint", f"{base}/state")
    schema = "digest string, first struct<anonymous: boolean, doc_id: long, locator: string>, n long"
    found = X.latest(spark, f"{base}/state", schema).collect()
    assert sorted((r["first"].doc_id, r.n) for r in found) == [(1, 1), (3, 3), (7, 1)]
    assert len({r.batch for r in spark.read.parquet(f"{base}/state").select("batch").collect()}) == 3
