from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from edgelog.functions import scalars as sc
from edgelog.functions import times as tm

EAST = timezone(timedelta(hours=8))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_formats_ignore_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # New York clocks skip two o'clock on 1995-04-02, read as UTC and as UTC+8 text.
        skipped = 796788900
        moments = [0, 1704067199, 1499999999, *range(skipped - 36000, skipped + 36000, 1800)]
        df = spark.createDataFrame([(m,) for m in moments], "t bigint")
        got = df.select(
            "t", tm.fmt_epoch("t", "yyyyMMddHHmm").alias("m"), tm.iso_time("t").alias("iso"),
            tm.parse_epoch(tm.fmt_epoch("t", "yyyyMMddHHmmss"), "yyyyMMddHHmmss").alias("back"),
            tm.day_start_utc8("t").alias("day"),
        ).collect()
        for r in got:
            at = datetime.fromtimestamp(r.t, EAST)
            assert r.m == at.strftime("%Y%m%d%H%M")
            assert r.iso == at.strftime("%Y-%m-%dT%H:%M:%S.000+0800")
            assert r.back == r.t
            assert r.day == int(at.replace(hour=0, minute=0, second=0).timestamp())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_other_zone_and_fractions(spark):
    df = spark.createDataFrame([(1704067200.25,)], "t double")
    r = df.select(tm.iso_time("t", "America/New_York").alias("a"), tm.floor_to("t", 60).alias("b")).first()
    assert r.a == "2023-12-31T19:00:00.250-0500"
    assert r.b == 1704067200


def test_bad_times_are_null(spark):
    df = spark.createDataFrame([("2024x101",), ("20241301",), ("2024010",), (None,)], "s string")
    assert [r[0] for r in df.select(tm.parse_epoch("s", "yyyyMMdd")).collect()] == [None] * 4
    odd = spark.createDataFrame([(float("nan"),), (1e300,)], "t double")
    assert [r[0] for r in odd.select(tm.floor_to("t", 60)).collect()] == [None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=20))
def test_ip_round_trip(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    got = df.select(
        "n", sc.long_to_ip("n").alias("ip"), sc.ip_to_long(sc.long_to_ip("n")).alias("back"),
        sc.int_to_long(sc.ip_to_int(sc.long_to_ip("n"))).alias("signed_back"),
    ).collect()
    for r in got:
        assert r.ip == ".".join(str(b) for b in r.n.to_bytes(4, "big"))
        assert r.back == r.n == r.signed_back


def test_lenient_and_json(spark):
    df = spark.createDataFrame([("5", '{"a": 1}'), ("x", "{}"), (None, None)], "s string, j string")
    got = df.select(sc.lenient("s", "int", 9), sc.json_map("j", "int")["a"], sc.ip_to_long("s")).collect()
    assert [tuple(r) for r in got] == [(5, 1, None), (9, None, None), (9, None, None)]
    quoted = spark.createDataFrame([('"a"',), ('b"',), ('""',), ("",), (None,)], "s string")
    assert [r[0] for r in quoted.select(sc.drop_outer_quotes("s")).collect()] == ["a", "b", "", "", None]
    dashes = spark.createDataFrame([("-",), (None,), ("1.5",), ("bad",), ("NaN",)], "s string")
    assert [r[0] for r in dashes.select(sc.dash_to_zero("s")).collect()] == [0.0, 0.0, 1.5, None, None]
