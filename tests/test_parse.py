from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from edgelog import layouts as L
from edgelog.operators import archive, clean, parse, route
from tests.helpers import lines

S = L.FIELD_SEP


def java_split(text: str, sep: str = S) -> list[str]:
    """Fields as a split that drops empty fields at the end gives them."""
    if sep not in text:
        return [text]
    parts = text.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_layout_widths():
    assert {k: len(v) for k, v in L.LAYOUTS.items()} == {
        "common34": 34, "fusion_band37": 37, "fusion_detail39": 39, "jx_band45": 45, "jx_detail45": 45,
        "unified_band38": 38, "unified46": 46, "preagg7": 7,
    }
    assert (len(L.ARCHIVE_USER), len(L.ARCHIVE_REST["jx"]), len(L.ARCHIVE_REST["fusion"])) == (12, 31, 25)
    assert len(L.SQL42_SCHEMA) == 42


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["", "a", "-", "@", "#", "@#", "x y"]), max_size=6).map(S.join), min_size=1, max_size=30))
def test_split_matches_rule(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = {r.i: r.p for r in parse.split_lines(df, {"value": "p"}).select("i", "p").collect()}
    for i, text in enumerate(texts):
        want = java_split(text)
        assert (got[i] or []) == want, text


def test_short_line_and_trailing_empties(spark):
    names = L.LAYOUTS["fusion_detail39"]
    full = S.join(f"v{i}" for i in range(37)) + S + S
    inner = S.join(["f", "", "x"])
    good, bad = parse.parse_lines(lines(spark, full, inner), "fusion_detail39")
    by = {r.firm_name: r for r in good.collect()}
    assert by["v0"].line_num == "v36" and by["v0"].rawdata is None and by["v0"].except_desc is None
    assert by["f"].response_time == "" and by["f"].http_range == "x" and by["f"].time_local is None
    assert bad.count() == 0 and good.columns == names
    own, _ = parse.parse_lines(lines(spark, inner), "jx_detail45")
    assert own.first().response_time is None


def test_good_plus_quarantine_is_input(spark):
    texts = [S.join(["x"] * n) for n in (1, 29, 30, 34, 36, 37, 40)] + [None]
    good, bad = parse.parse_lines(lines(spark, *texts), "fusion_band37", on_short="quarantine")
    assert good.count() == 2 and bad.count() == 6
    assert {r.reason for r in bad.collect()} == {"too few fields", "no line"}
    with pytest.raises(ValueError):
        parse.parse_flagged(lines(spark, "x"), "common34", on_short="drop")


def test_rank_input_bounds(spark):
    def line(n, t="1704067200"):
        fields = ["x"] * n
        fields[5], fields[8], fields[9], fields[11], fields[12] = t, "d", "/r", "404", "-"
        return S.join(fields)

    good, bad = parse.rank_input(lines(spark, line(30), line(29), line(34, "oops")))
    assert [tuple(r) for r in good.collect()] == [(1704067200, "d", "/r", "404", 0.0)]
    assert sorted(r.reason for r in bad.collect()) == ["bad time_unix", "too few fields"]


def test_sql42_widths_and_quarantine(spark):
    base = [f"v{i}" for i in range(37)]
    base[0], base[12], base[35], base[36] = "WS", "10", "a_b_20170501120000_x", "7"
    plain, wide = S.join(base), S.join(base + ["skip", "raw", "err"])
    nodate = S.join(base[:35] + ["nodate", "7"])
    badsize = S.join(base[:12] + ["-"] + base[13:])
    good, bad = parse.parse_sql42(lines(spark, plain, wide, nodate, badsize, "x"), suffix_month="201705")
    assert good.columns == L.SQL42_SCHEMA.names
    assert {(r.filetime, r.lowfirmname, r.rawdata, r.except_desc) for r in good.collect()} == {
        ("20170501-1", "ws", "", ""), ("20170501-1", "ws", "raw", "err"),
    }
    assert sorted(r.reason for r in bad.collect()) == [
        "bad body_bytes_sent", "no day in file_name", "too few fields",
    ]


def test_archive_cells_lose_both_quotes(spark, log):
    packed = archive.to_archive(
        log.select("*", *[F.lit("-").alias(c) for c in L.VENDOR_37 if c not in log.columns])
    )
    flagged = parse.parse_archive_flagged(packed, "fusion")
    r = flagged.orderBy("line_num").first()
    assert '"' not in r.clientip + r.hit_status + r.firm_name + r.line_num
    wide = packed.limit(1).withColumn("info", F.concat("info", F.lit(' "more"')))
    good, bad = parse.parse_archive(wide, "fusion")
    assert good.count() == 0 and bad.first().reason == "too many fields"


def test_archive_lines_keeps_everything(spark):
    exact = ["x"] * 37
    exact[5], exact[35], exact[36] = "1704067200", "f", "12"
    broken = exact + ["raw", "why"]
    texts = [S.join(exact), S.join(broken), S.join(exact[:20]), S.join(exact[:36] + ["n"]), S.join(exact[:36] + ["12", "y"])]
    good, bad = archive.archive_lines(lines(spark, *texts), as_of=1704067200)
    assert {r.table_suffix for r in good.collect()} == {"20240101", "malformed"}
    odd = good.where("table_suffix = 'malformed'").first()
    assert odd.info is None and odd.info1 == '"raw" "why"' and odd.row_key.startswith("2#!199700000000#")
    assert good.count() + bad.count() == len(texts)


def test_clean_flags_bad_rows(spark):
    df = spark.createDataFrame(
        [("1.5", "10", "200", "-"), ("bad", "10", "200", "1"), ("2", "-", "200", "1"), ("2", "1", "abc", "1"),
         ("NaN", "1", "200", "1"), (None, None, None, None)],
        "time_unix string, body_bytes_sent string, http_status string, response_time string",
    )
    good, bad = clean.clean_detail(df, with_ingest_time=True)
    assert good.count() == 2 and "@timestamp" in good.columns
    first = good.orderBy(F.col("time_unix").desc()).first()
    assert (first.time_unix, first.time_mt, first.response_time, first.p_response_time) == (1.5, 0, 0.0, 0.0)
    assert sorted(r.reason for r in bad.collect()) == [
        "bad body_bytes_sent", "bad http_status", "bad time_unix", "bad time_unix",
    ]
    band_good, band_bad = clean.clean_band(df)
    assert band_good.count() == 3 and band_bad.count() == 3


def test_route_edges(spark):
    df = spark.createDataFrame(
        [("a_b_20240101000000_c", "WS"), ("a_b_20240101_c", "WS"), ("a_b_20240101000000", "WS"), (None, None)],
        "file_name string, firm_name string",
    )
    names = [r.index_name for r in route.route_detail(df, "fusion").collect()]
    assert names == ["vendor-ws-20240101", None, None, None]
    # A rollup is late when it is more than 30 days old, to the second.
    band = spark.createDataFrame([(1000,), (999,)], "from_time bigint")
    routed = route.route_band(band, "p_", "t", as_of=1000 + 2592000)
    assert [r.index_name for r in routed.collect()] == ["p_1970.01.01", "p_error"]


def test_table_suffix_boundary(spark):
    start = 1704067200 - 8 * 3600 + 86400  # a UTC+8 midnight
    df = spark.createDataFrame([(start,), (start - 1,)], "time_unix bigint")
    got = archive.with_table_suffix(df, as_of=start + 30 * 86400).collect()
    assert [r.table_suffix for r in got] == ["20240102", "202401"]


def test_archive_suffixes():
    assert archive.minute_suffixes("202401312300", "202402010100") == ["202401", "20240131", "202402", "20240201"]
    assert archive.minute_suffixes("202401010000", "202401020000") == ["202401", "20240101"]
