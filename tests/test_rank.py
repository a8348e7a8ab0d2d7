from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from edgelog.operators import rank
from tests.helpers import plan, rows


@pytest.fixture(scope="module")
def urls(spark):
    rng = random.Random(5)
    data = []
    for i in range(3000):
        # One domain holds a third of all rows.
        domain = "hot" if rng.random() < 0.34 else f"d{rng.randrange(8)}"
        errors = rng.choice([0, 0, 0, 1])
        data.append((f"{i:05d}", 0, domain, f"/r_{i}", float(rng.randrange(200)), float(rng.randrange(1, 3)), 0.0, float(errors)))
    df = spark.createDataFrame(
        data, "id string, time_unix bigint, domain string, request string, traffic double, req_count double, downloadnum double, req_error double"
    )
    counters = {f"req{s}": F.lit(0.0) for s in (401, 403, 404, 500, 501, 502, 503, 504)}
    return df.withColumns(counters).repartition(6).cache()


def brute_top(rows_, metric, n):
    out = []
    for d in {r.domain for r in rows_}:
        group = sorted((r for r in rows_ if r.domain == d), key=lambda r: (r[metric], r.id), reverse=True)
        out += [r.id for r in group[:n]]
    return sorted(out)


@pytest.mark.parametrize("salts", [None, 1, 7])
@pytest.mark.parametrize("n", [3, 250])
def test_top_matches_brute_force(urls, n, salts):
    data = urls.collect()
    for metric in rank.TOP_METRICS:
        got = sorted(r.id for r in rank.top_by(urls, metric, n, salts=salts).collect())
        assert got == brute_top(data, metric, n)


def test_union_has_every_top_once(urls):
    data = urls.collect()
    want = sorted({i for m in rank.TOP_METRICS for i in brute_top(data, m, 5)})
    assert sorted(r.id for r in rank.top_union(urls, 5).collect()) == want


def test_legacy_order_compares_text(spark):
    df = spark.createDataFrame([("a", "d", 9.0), ("b", "d", 10.0)], "id string, domain string, traffic double")
    assert rank.top_by(df, "traffic", 1).first().id == "b"
    assert rank.top_by(df, "traffic", 1, legacy_order=True).first().id == "a"


def test_prune_matches_brute_force(urls):
    n = 20
    want = []
    data = urls.collect()
    for d in {r.domain for r in data}:
        group = sorted((r for r in data if r.domain == d), key=lambda r: r.id)
        want += [r.id for i, r in enumerate(group) if i <= n or r.req_count > 1 or r.req_error > 0]
    assert sorted(r.id for r in rank.prune_rank(urls, n).collect()) == sorted(want)


def test_salted_sum_keeps_underscores(spark):
    df = spark.createDataFrame([("d", "/a_b", 1.0), ("d", "/a_c", 2.0), ("d", "/a_b", 4.0)], "domain string, request string, v double")
    assert rows(rank.url_sum_salted(df.repartition(3), ["domain", "request"], ["v"])) == [("d", "/a_b", 5.0), ("d", "/a_c", 2.0)]


def test_merge_of_parts_is_whole(log):
    whole = rank.url_hour(log)
    parts = rank.url_hour(log.where("line_num % 2 = 0")).unionByName(rank.url_hour(log.where("line_num % 2 = 1")))
    assert rows(rank.merge_url_hour(parts)) == rows(whole)


def test_counters_add_up(log):
    urls = rank.url_hour(log)
    total = urls.agg(F.sum("req_count"), F.sum("req_error")).first()
    assert total[0] == log.count()
    assert total[1] == log.where(F.col("http_status").isin("401", "403", "404", "500", "501", "502", "503", "504")).count()
    top = rank.top_by(urls, "traffic", 3)
    assert top.join(urls, urls.columns, "left_anti").count() == 0


def test_tops_are_cut_before_the_shuffle(urls):
    for df in (rank.top_by(urls, "traffic", 100), rank.top_by(urls, "traffic", 2000)):
        text = plan(df)
        assert "WindowGroupLimit" in text and "Partial" in text
    assert plan(rank.top_union(urls, 100)).count("Partial") >= 4
