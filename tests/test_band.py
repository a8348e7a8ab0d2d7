from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalog import fixture
from edgelog import layouts as L
from edgelog.operators import band, check, clean, events, filters, userlog
from edgelog.plans import jobs
from edgelog.sources import readers
from tests.helpers import plan, rows


@pytest.mark.parametrize("keys", [L.FUSION_KEYS, L.JX_KEYS])
def test_widths_agree(log, keys):
    good, bad = clean.clean_band(log)
    one, five = band.band(good, keys, 60), band.band(good, keys, 300)
    assert rows(band.reband(one, keys, 300)) == rows(five)
    counts = [df.agg(F.sum("req_count")).first()[0] for df in (one, five)]
    assert counts == [good.count()] * 2 and good.count() + bad.count() == log.count()


def test_missing_keys_become_zero(spark):
    df = spark.createDataFrame([(None, "d", 60, 1.0), ("0", "d", 61, 2.0)], "layer string, domain string, time_unix bigint, body_bytes_sent double")
    assert [(r.layer, r.req_count, r.traffic) for r in band.band(df, ["layer", "domain"]).collect()] == [("0", 2, 3.0)]


def test_lowest_tag_is_numeric(spark):
    df = spark.createDataFrame([("0-10",), ("0-9",), ("1-1",)], "tag string").withColumns(
        {"k": F.lit("a"), "time_unix": F.lit(0), "body_bytes_sent": F.lit(1.0)}
    )
    assert band.band(df, ["k"], tag="tag").first().tag == "0-9"


def test_keys_do_not_run_together(spark):
    df = spark.createDataFrame([("ab", "c", 0, 1.0), ("a", "bc", 0, 1.0)], "x string, y string, time_unix bigint, body_bytes_sent double")
    out = band.band(df, ["x", "y"])
    assert out.count() == 2 and out.select("id").distinct().count() == 2


def test_check_verdicts(spark, log, sf):
    archive = fixture.archive(spark, sf)
    full = band.band(log.withColumn("body_bytes_sent", F.lit(1)), L.FUSION_KEYS)
    assert {r.is_normal for r in check.band_check(archive, full).collect()} == {"Y"}
    some = full.where("hit_status = 'HIT'")
    assert "N" in {r.is_normal for r in check.band_check(archive, some).collect()}
    extra = full.limit(1).withColumn("file_name", F.lit("only_band"))
    both = check.band_check(archive, full.unionByName(extra), full=True)
    row = both.where("file_name = 'only_band'").first()
    assert row.archive_req_count is None and row.is_normal == "N"
    assert check.band_check(archive, full.unionByName(extra)).where("file_name = 'only_band'").count() == 0


def test_check_job_cuts_both_sides(spark, log, sf):
    full = band.band(log.withColumn("body_bytes_sent", F.lit(1)), L.FUSION_KEYS)
    got = jobs.check_band(fixture.archive(spark, sf), full, "202401010800", "202401010900")
    assert {r.is_normal for r in got.collect()} == {"Y"}
    assert {r.from_time for r in got.collect()} == {1704067200}


def test_rebuild_equals_direct(spark, log, sf):
    got = jobs.rebuild_band(fixture.archive(spark, sf), "202401010000", "202401020000", as_of=1704067200)
    good, _ = clean.clean_band(log)
    for width in (60, 300):
        want = band.band(good, L.FUSION_KEYS, width).drop("id")
        assert rows(got[width].drop("id", "index_name", "index_type")) == rows(want)


def test_rank_archive(spark, log, sf):
    from edgelog.operators import rank

    archive = fixture.archive(spark, sf)
    want = rows(rank.top_union(rank.url_hour(log), 2000))
    assert rows(jobs.rank_archive(archive, "202401010000", "202401020000")) == want
    few = rows(rank.top_union(rank.url_hour(log), 3))
    assert rows(jobs.rank_archive(archive, "202401010000", "202401020000", n=3)) == few


def test_user_log_fields(spark):
    cases = {
        None: "-", "/": "-", "//": "-", "": "", "/a/b": "", "a/b": "a", "x" * 41: "x" * 30, "x" * 40: "x" * 40,
        "Mozilla/5.0": "Mozilla",
    }
    df = spark.createDataFrame([(k, i) for i, k in enumerate(cases)], "v string, i int")
    got = [r[0] for r in df.orderBy("i").select(userlog.export_field("v")).collect()]
    assert got == list(cases.values())
    keys = {"a.com/x": "a.com", "a.com:80": "a.com", "a.com:80/x": "a.com", "/x": "/x", ":80": ":80", None: "-"}
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "domain string, i int")
    assert [r[0] for r in df.orderBy("i").select(userlog.export_key()).collect()] == list(keys.values())


def test_slices_end_short(spark):
    got = [tuple(r) for r in events.time_slices(spark, 0, 2500, 1200).orderBy("slice_from").collect()]
    assert got == [(0, 1200), (1200, 2400), (2400, 2500)]
    df = spark.createDataFrame([(0, 2400), (5, 5)], "a bigint, b bigint")
    assert rows(events.slices_of(df, "a", "b", 1200)) == [(0, 1200), (1200, 2400)]


def test_events_round_trip(spark):
    df = spark.createDataFrame([(7, "x", 1, 2.5, 3.0)], events.EVENT_SCHEMA)
    assert rows(events.read_events(events.serialise(df, "json"))) == rows(df)
    assert events.serialise(df, "nested").first().event == '{"ts":7,"data":{"foo":"x","bar":1},"geo":{"lat":2.5,"lon":3.0}}'
    assert events.serialise(df, "csv").first().event == "7,x,1,2.5,3.0"
    with pytest.raises(ValueError):
        events.serialise(df, "xml")
    record = spark.createDataFrame([("WS", "5", "d", 9, "now")], ", ".join(f"{c} string" if c != "body_bytes_sent" else f"{c} bigint" for c in events.LOG_EVENT_COLUMNS))
    flat = '{"firm_name":"WS","response_time":"5","domain":"d","body_bytes_sent":9,"time_local":"now"}'
    for form, want in (("json", flat), ("nested", flat), ("csv", "WS,5,d,9,now")):
        assert events.serialise(record, form, events.LOG_EVENT_COLUMNS).first().event == want


def test_filters(spark, log):
    kept = filters.keep_policy(log, domain_substr="media")
    gone = log.join(kept, "line_num", "left_anti").collect()
    assert gone and all(r.http_status in ("200", "206", "304") and r.layer == "2" and "media" not in r.domain for r in gone)
    routed = spark.createDataFrame([("a_b",), ("axb",)], "index_name string")
    assert [r[0] for r in readers.index_wildcard(routed, "a_*").collect()] == ["a_b"]


def test_rollup_reads_only_what_it_needs(spark, sf):
    good, _ = clean.clean_band(fixture.log(spark, sf))
    text = plan(band.band(good, L.JX_KEYS))
    assert "ts:" not in text.split("ReadSchema")[1] and "props" not in text.split("ReadSchema")[1]
    assert text.split("Physical Plan")[1].count("Exchange") == 1
    assert "SortAggregate" not in text
