from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog import fixture
from edgelog import layouts as L
from edgelog.operators import band, clean, rank, recommend, userlog
from edgelog.plans import jobs
from edgelog.session import shared_dir
from edgelog.sinks import writers
from edgelog.sources import readers
from edgelog.streaming import runner
from tests.helpers import lines, plan, rows


def test_newest_row_of_an_id_wins(spark, tmp_path):
    base = str(tmp_path / "t")
    frame = lambda *r: spark.createDataFrame(list(r), "id string, v int, index_name string, skip int")
    writers.routed_upsert(frame(("a", 1, "x", 0), ("b", 1, "y", 0)), base, 0, exclude=["skip"])
    writers.routed_upsert(frame(("a", 2, "x", 0), ("c", 2, "x", 0)), base, 1, exclude=["skip"])
    table = writers.latest(writers.read_routed(spark, base))
    assert "skip" not in table.columns
    assert rows(table, ["id", "v"]) == [("a", 2), ("b", 1), ("c", 2)]
    # The same batch again, with less in it, replaces only itself.
    writers.routed_upsert(frame(("a", 3, "x", 0)), base, 1, exclude=["skip"])
    assert rows(writers.latest(writers.read_routed(spark, base)), ["id", "v"]) == [("a", 3), ("b", 1)]
    writers.snapshot(spark, base, str(tmp_path / "s"))
    assert rows(spark.read.parquet(str(tmp_path / "s")), ["id", "v"]) == [("a", 3), ("b", 1)]
    assert "WindowGroupLimit" in plan(table)


def test_rebuild_replaces_what_streams_wrote(spark, log, sf, tmp_path):
    base = str(tmp_path / "out")
    good, _ = clean.clean_band(log)
    as_of = 1704067200

    def partial(rows_, batch):
        from edgelog.operators import route

        one = band.band(rows_, L.FUSION_KEYS)
        frames = [
            route.route_band(f, p, L.TYPE_BAND_FUSION, as_of)
            for f, p in ((one, L.INDEX_BAND_1M), (band.reband(one, L.FUSION_KEYS), L.INDEX_BAND_5M))
        ]
        writers.routed_upsert(frames[0].unionByName(frames[1]), f"{base}/band", batch, part=["index_name", "index_type"])

    # The streams lost every record of one firm and doubled the others.
    partial(good.where("firm_name <> 'WS'"), 0)
    partial(good.where("firm_name <> 'WS'"), 1)
    archive = fixture.archive(spark, sf)
    first, last = "202401010800", "202401010900"
    jobs.run_rebuild(spark, archive, base, first, last, firm="WS", run=5, as_of=as_of)
    jobs.run_rebuild(spark, archive, base, "202401010900", "202401011000", run=6, as_of=as_of)
    jobs.run_rebuild(spark, archive, base, "202401010900", "202401011000", run=7, as_of=as_of)
    for prefix, width in ((L.INDEX_BAND_1M, 60), (L.INDEX_BAND_5M, 300)):
        got = runner.band_view(spark, base, prefix, L.FUSION_KEYS)
        direct = band.band(good, L.FUSION_KEYS, width).select(*got.columns)
        hour = F.col("from_time") - F.col("from_time") % 3600
        eight, nine = 1704067200, 1704070800
        want = (
            direct.where((hour == nine) | ((hour == eight) & (F.col("firm_name") == "WS")))
            .unionByName(
                direct.where((hour != nine) & (F.col("firm_name") != "WS")).withColumns(
                    {"req_count": F.col("req_count") * 2, "traffic": F.col("traffic") * 2}
                )
            )
        )
        assert rows(got) == rows(want)


def test_rebuild_needs_whole_buckets(spark, sf, tmp_path):
    with pytest.raises(ValueError):
        jobs.run_rebuild(spark, fixture.archive(spark, sf), str(tmp_path), "202401010800", "202401010903")


def test_unpublished_rebuild_is_not_seen(spark, tmp_path):
    rows_ = spark.createDataFrame([(0, "a", 0, 1), (0, "a", 9, 5)], "from_time bigint, firm_name string, run bigint, v int")
    none = spark.createDataFrame([], writers.COVERAGE_SCHEMA)
    assert [r.v for r in writers.effective_band(rows_, none).collect()] == [1]
    done = spark.createDataFrame([(0, 60, None, 9)], writers.COVERAGE_SCHEMA)
    assert [r.v for r in writers.effective_band(rows_, done).collect()] == [5]


def test_rank_hours_goes_on_and_skips_missing_days(spark, log, tmp_path):
    logs, out, progress = (str(tmp_path / n) for n in ("logs", "out", "progress"))
    text = log.selectExpr(
        f"{fixture.wire_sql(L.VENDOR_34)} AS value",
        "CASE WHEN line_num % 2 = 0 THEN '20240101' ELSE '20240103' END AS storage_day",
        "'20240101' || lpad(8 + line_num % 4, 2, '0') AS log_hour",
    )
    text.write.partitionBy("storage_day", "log_hour").text(logs)
    start = 1704067200
    assert jobs.rank_hours(spark, logs, out, progress, until=start + 7200, first=start, n=2000) == 2
    assert jobs.rank_hours(spark, logs, out, progress, until=start + 4 * 3600 + 10, first=start, n=2000) == 2
    assert jobs.read_progress(spark, progress, "urlrank", 0) == start + 4 * 3600
    assert jobs.read_progress(spark, progress, "other", 7) == 7
    table = writers.read_routed(spark, out)
    cols = ["id", "domain", "request", *L.RANK_MEASURES]
    assert rows(table, cols) == rows(rank.url_hour(log), cols)
    scan = readers.log_dir_scan(spark, logs, "2024010109")
    assert "log_hour" in plan(scan).split("PartitionFilters: [")[1].split("]")[0]
    assert scan.count() == log.where("line_num % 4 = 1").count()
    assert readers.log_dir_scan(spark, logs, "2024020109").count() == 0


def test_export_packages(spark, log, tmp_path):
    out = str(tmp_path / "pkg")
    start, end = 1704067200, 1704067200 + 4 * 3600
    for _ in range(2):
        jobs.export_user_logs(log, start, end, out)
    want = userlog.user_log_lines(log)
    read = spark.read.text(out)
    assert rows(read, ["value"]) == rows(want, ["value"])
    assert sorted(read.columns) == ["day", "domain", "hour", "minute", "value"]
    files = list(Path(out).rglob("*.gz"))
    assert files and all(gzip.open(f).read(1) == b'"' for f in files)
    times = spark.createDataFrame([(1704103200 + s,) for s in (0, 299, 300, 359, 360)], "time_unix bigint")
    got = [(r.hour, r.minute) for r in times.select(*[c.alias(n) for n, c in writers.slice_columns().items()]).collect()]
    assert got == [("18", "00"), ("18", "00"), ("18", "05"), ("18", "05"), ("18", "06")]


def test_backfill(spark, log, tmp_path):
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    log.selectExpr(f"{fixture.wire_sql(L.VENDOR_37)} AS value").write.text(src)
    for _ in range(2):
        jobs.backfill(spark, src, base)
    table = writers.read_routed(spark, f"{base}/detail")
    assert table.count() == log.where("body_bytes_sent <> '-'").count()
    assert "backfill-ws-20240101" in {r[0] for r in table.select("index_name").distinct().collect()}
    assert spark.read.parquet(f"{base}/quarantine").count() == log.where("body_bytes_sent = '-'").count()
    quoted = str(tmp_path / "q")
    log.selectExpr(f"{fixture.quoted_sql(L.ARCHIVE_REST['jx'])} || '<<>>' || {fixture.quoted_sql(L.ARCHIVE_USER)} AS value").write.text(quoted)
    jobs.backfill(spark, quoted, base, "package")
    assert spark.read.parquet(f"{base}/package").count() == log.count()
    with pytest.raises(ValueError):
        jobs.backfill(spark, src, base, "other")


def test_raw_lines_have_unique_keys(spark, log, tmp_path):
    base = str(tmp_path / "raw")
    writers.raw_lines_archive(log.selectExpr("file_name AS value"), base, 0)
    table = spark.read.parquet(base)
    assert table.count() == log.count() == table.select("row_key").distinct().count()


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_cosine_matches_brute_force(spark):
    data = [(u, i, float((u * 7 + i * 3) % 5)) for u in range(6) for i in range(5) if (u + i) % 4]
    df = spark.createDataFrame(data, "user int, item int, rating double")
    vec = {u: {i: r for x, i, r in data if x == u} for u in range(6)}
    norm = lambda v: sum(x * x for x in v.values()) ** 0.5
    want = {
        u: round(sum(r * vec[1].get(i, 0) for i, r in vec[u].items()) / (norm(vec[u]) * norm(vec[1])), 6) for u in vec
    }
    got = recommend.cosine_users(df, 1)
    assert {r.user: r.similarity for r in got.collect()} == want
    assert "CartesianProduct" not in plan(got) and "BroadcastNestedLoopJoin" not in plan(got)


def test_models(spark, tmp_path):
    points = recommend.labeled_points(lines(spark, "1,2 3", "0,0 1", "1,4 4", "0,1 0"))
    assert points.first().features.toArray().tolist() == [2.0, 3.0]
    piped = recommend.labeled_points(lines(spark, "1|2 3"), sep="|")
    assert (piped.first().label, piped.first().features.toArray().tolist()) == (1.0, [2.0, 3.0])
    ratings = recommend.ratings_text(lines(spark, "1 2 3.5"))
    assert tuple(ratings.first()) == (1, 2, 3.5)
    for train in (recommend.naive_bayes, recommend.logistic_regression, recommend.linear_svc):
        predicted = train(points).transform(points)
        from pyspark.ml.evaluation import MulticlassClassificationEvaluator

        score = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(predicted)
        assert recommend.accuracy(predicted).first().accuracy == pytest.approx(score)
    path = tmp_path / "p.libsvm"
    path.write_text("1 1:2 2:3\n0 2:1\n")
    assert recommend.libsvm(spark, str(path), 2).count() == 2
    parts = recommend.split_points(spark.range(1000))
    assert sum(p.count() for p in parts) == 1000


def test_als_ranks_what_similar_users_like(spark):
    # Two groups of users, each fond of its own items; user 0 has not rated item 1.
    data = [(u, i, 5.0 if u % 2 == i % 2 else 1.0) for u in range(10) for i in range(6) if (u, i) != (0, 1)]
    ratings = spark.createDataFrame(data, "user int, item int, rating double")
    top = recommend.als_top(ratings, spark.createDataFrame([(0,), (1,)], "user int"), n=3, iterations=10)
    for r in top.collect():
        assert r.item % 2 == r.user % 2
    assert top.count() == 6


def test_regression_recovers_the_line(spark):
    points = recommend.labeled_points(lines(spark, *[f"{3 * a + 2 * b + 1},{a} {b}" for a in range(4) for b in range(4)]))
    model = recommend.linear_regression(points)
    assert model.coefficients.toArray().tolist() == pytest.approx([3.0, 2.0])
    assert model.intercept == pytest.approx(1.0)


def test_stop_ends_a_stream_between_batches(spark, tmp_path):
    path = str(tmp_path / "in")
    lines(spark, "a", "b").write.parquet(path)
    seen = []
    stream = readers.source(spark, "parquet", "value string", path)
    query = runner.run_stream(stream, lambda df, b: seen.append(df.count()), str(tmp_path / "c"), interval="1 second", name="held")
    query.processAllAvailable()
    query.stop()
    assert seen == [2] and not query.isActive
    again = runner.run_stream(stream, lambda df, b: seen.append(df.count()), str(tmp_path / "c"))
    again.awaitTermination()
    assert seen == [2]


def test_text_sources(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text('"a" "b"\n"c"\n')
    df = readers.quoted_fields(readers.text_lines(spark, str(path)))
    assert [r.fields for r in df.collect()] == [['"a', 'b"'], ['"c"']]
