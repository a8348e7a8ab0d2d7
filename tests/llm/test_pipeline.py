from __future__ import annotations

import corpus_pipeline as P
from pyspark.sql import functions as F

from edgelog.llm import decontaminate, exact_dedup, queries, toxicity

from .test_minhash import one_of_each


def test_stages_take_effect_on_what_is_left(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        left = stage(spark, docs, sf)
        assert left.columns == docs.columns, name
        left = left.cache()
        ids, before = {r.doc_id for r in left.collect()}, {r.doc_id for r in docs.collect()}
        assert ids <= before and ids < before, name
        want = {
            "toxicity": lambda d: toxicity.report(d, spark.read.parquet(f"{sf}/labels.parquet")).filter("predicted = 0"),
            "exact_dedup": lambda d: exact_dedup.report(d).filter("kept"),
            "near_dedup": lambda d: d.filter(F.col("doc_id").isin(one_of_each([(r.doc_id, r.text) for r in d.collect()]))),
            "decontamination": lambda d: decontaminate.report(d, spark.read.parquet(f"{sf}/benchmark.parquet")).filter("not contaminated"),
        }[name](docs)
        assert {r.doc_id for r in want.collect()} == ids, name
        docs = left
    tokens = P.STAGES[-1][1](spark, docs, sf).collect()
    assert len(tokens) == docs.count() and all(r.exact and r.n_tokens == len(r.ids) for r in tokens)


def test_all_stages_in_a_row_and_all_queries_named(spark, sf):
    assert P.run(spark, sf).count() > 0
    assert sorted(int(q.split("_")[0][2:]) for q in queries.QUERIES) == list(range(1, 14))
