"""Nothing that was stored is lost: identities of writers, rebuilds, rejects, bad values."""

from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from catalog import fixture
from edgelog import layouts as L
from edgelog.functions import scalars as sc, times as tm
from edgelog.operators import archive, band, filters, recommend
from edgelog.plans import jobs
from edgelog.plans.main import main
from edgelog.sinks import writers
from edgelog.sources import readers
from edgelog.streaming import runner
from tests.helpers import lines, plan, rows


@pytest.fixture(scope="module")
def vendor_text(log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keep") / "lines")
    log.selectExpr(f"{fixture.wire_sql(L.VENDOR_37)} AS value").coalesce(1).write.text(path)
    return path


def test_two_firm_rebuilds_at_one_moment_keep_both(spark, sf, tmp_path):
    base, good = str(tmp_path / "out"), "firm_name IN ('WS', 'BS') AND body_bytes_sent <> '-'"
    stored = fixture.archive(spark, sf)
    for firm in ("WS", "BS"):
        jobs.run_rebuild(spark, stored, base, "202401010800", "202401011200", firm=firm, run=7)
    got = runner.band_view(spark, base, L.INDEX_BAND_5M, L.FUSION_KEYS)
    assert got.agg(F.sum("req_count")).first()[0] == fixture.log(spark, sf).where(good).count()
    bad = writers.read_routed(spark, f"{base}/quarantine", ["layout"])
    assert bad.count() == fixture.log(spark, sf).where("firm_name IN ('WS', 'BS') AND body_bytes_sent = '-'").count()


def test_compaction_bounds_folders_and_keeps_totals(spark, log, vendor_text, tmp_path):
    base, target = str(tmp_path / "out"), str(tmp_path / "small")
    for part in range(3):
        stream = readers.source(spark, "text", L.RAW_LINE_SCHEMA, vendor_text)
        runner.run_stream(stream, runner.band_handler(base, as_of=1704067200), str(tmp_path / f"c{part}")).awaitTermination()
    main(["compact-band", base, target], spark)
    before, after = (runner.band_view(spark, b, L.INDEX_BAND_1M, L.FUSION_KEYS) for b in (base, target))
    assert rows(before) == rows(after)
    folders = lambda b: writers.read_routed(spark, f"{b}/band", ["index_name", "index_type"]).select("index_name", "writer", "run", "batch").distinct().count()
    assert folders(base) == 6 and folders(target) == 2


def test_snapshot_command_keeps_the_newest_rows(spark, tmp_path):
    base, target = str(tmp_path / "t"), str(tmp_path / "s")
    frame = lambda *r: spark.createDataFrame(list(r), "id string, v int, index_name string")
    writers.routed_upsert(frame(("a", 1, "007"), ("b", 1, "007")), base, 0, writer="w")
    writers.routed_upsert(frame(("a", 2, "007")), base, 1, writer="w")
    writers.routed_upsert(frame(("c", 9, "1")), base, 0, writer="other")
    assert {r.index_name for r in writers.read_routed(spark, base).collect()} == {"007", "1"}
    main(["snapshot", base, target], spark)
    assert rows(spark.read.parquet(target), ["id", "v"]) == [("a", 2), ("b", 1), ("c", 9)]


def test_range_reads_cut_rows_and_coverage(spark, sf, tmp_path):
    base, stored = str(tmp_path / "out"), fixture.archive(spark, sf)
    jobs.run_rebuild(spark, stored, base, "202401010800", "202401011200")
    eight = 1704067200
    got = writers.read_band(spark, base, L.INDEX_BAND_5M, start=eight, end=eight + 3600)
    want = band.band_totals(writers.read_band(spark, base, L.INDEX_BAND_5M), L.FUSION_KEYS).where(f"from_time < {eight + 3600}")
    assert rows(band.band_totals(got, L.FUSION_KEYS)) == rows(want)


def test_missing_hours_wait_unless_told(spark, log, tmp_path):
    logs, out, progress = (str(tmp_path / n) for n in ("logs", "out", "progress"))
    text = log.selectExpr(f"{fixture.wire_sql(L.VENDOR_34)} AS value", "'20240101' AS storage_day", "'2024010110' AS log_hour")
    text.write.partitionBy("storage_day", "log_hour").text(logs)
    eight, ten = 1704067200, 1704067200 + 7200
    run = lambda **o: jobs.rank_hours(spark, logs, out, progress, until=ten + 3600, first=eight, **o)
    assert run() == 0 and jobs.read_progress(spark, progress, "urlrank", eight) == eight
    assert run(skip_missing=True) == 3
    assert writers.read_routed(spark, out).agg(F.sum("req_count")).first()[0] == log.count()


def test_exports_of_part_slices_are_refused(log, tmp_path):
    with pytest.raises(ValueError):
        jobs.export_user_logs(log, 1704067200, 1704067320, str(tmp_path))


def test_every_line_is_good_or_in_quarantine(spark, log, vendor_text, tmp_path):
    good = log.where("body_bytes_sent <> '-'").count()
    for job, table in (("firm-day-stream", "detail"), ("raw-stream", "raw"), ("sql-stream", None), ("event-stream", "events")):
        out = str(tmp_path / job)
        more = ["--sql", "SELECT * FROM logs"] if job == "sql-stream" else []
        main([job, "--path", vendor_text, "--out", out, "--checkpoint", f"{out}-c", *more], spark)
        if job == "raw-stream":
            assert spark.read.parquet(f"{out}/raw").count() == log.count()
            continue
        quarantine = f"{out}-quarantine" if table is None else f"{out}/quarantine"
        assert spark.read.parquet(quarantine).count() == log.count() - good
        stored = spark.read.parquet(out if table is None else f"{out}/{table}")
        if job == "event-stream":
            size = F.sum("body_bytes_sent")
            assert stored.agg(size).first()[0] == log.where("body_bytes_sent <> '-'").agg(F.sum(F.col("body_bytes_sent").cast("bigint"))).first()[0]
        else:
            assert stored.count() == good


def test_rank_sql_over_files(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    lines(spark, "d /a 10 2 1 2 404", "d /a 5 1 0 1 200", "d /b 99 1 0 1 200", "short line").write.text(src)
    main(["rank-sql", src, out, "--top", "1"], spark)
    assert rows(spark.read.parquet(out), ["domain", "request", "traffic"]) == [("d", "/b", 99.0)]
    assert spark.read.parquet(f"{out}-quarantine").count() == 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=20))
def test_any_time_has_a_text_or_null(spark, times):
    df = spark.createDataFrame([(t,) for t in times], "t bigint")
    got = df.select(tm.fmt_epoch("t", "yyyy.MM.dd").alias("d"), tm.minute_text("t").alias("m"), tm.iso_time("t").alias("i"), sc.log_time("t").alias("k")).collect()
    for t, r in zip(times, got):
        assert r.d is None or len(r.d) == 10
        assert (r.k is None) == (not tm.EPOCH_RANGE[0] <= t < tm.EPOCH_RANGE[1])


def test_odd_addresses_and_points(spark):
    texts = ["1.2.3.4", "1.2.3.256", "1.2.3", "999999999999999999.1.1.1", "1.2.3.-1", "a.b.c.d", None, ""]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(sc.ip_to_long("t")).collect()]
    assert got == [16909060] + [None] * 7
    text = lines(spark, "1,2 3", "1", "", "x,1 2", "1,2 y")
    assert recommend.labeled_points(text).count() == 1
    assert {r.reason for r in recommend.unreadable_points(text).collect()} == {"bad label", "bad feature"}
    assert [tuple(r) for r in recommend.ratings_text(lines(spark, "1 2", "q")).collect()] == [(1, 2, None), (None, None, None)]


def test_unreadable_tags_never_win(spark):
    df = spark.createDataFrame([("k", 0, "1", t) for t in ("oops", "3-7", "3-9", "")], "layer string, time_unix bigint, body_bytes_sent string, t string")
    assert band.band(df, ["layer"], 60, tag="t").first().t == "3-7"


def test_no_job_runs_while_a_plan_is_built(spark, log):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        ratings = spark.createDataFrame([(1, 1, 1.0)], "user int, item int, rating double")
        filters.in_list(log, "host", log.select("host"))
        recommend.cosine_users(ratings, 1)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_scan_of_several_archive_tables(spark, sf, tmp_path):
    path = str(tmp_path / "a")
    fixture.archive(spark, sf).write.partitionBy("table_suffix").parquet(path)
    found = archive.archive_tables(spark.read.parquet(path), ["20240101", "202401"])
    assert plan(found).count("FileScan parquet") == 1
