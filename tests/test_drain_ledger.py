"""Ending streams between batches, what they read, and windows that close."""

from __future__ import annotations

import hashlib
import threading
import time

import pytest
from pyspark.sql import functions as F

from catalog import fixture
from edgelog import layouts as L
from edgelog.operators import band, clean, rank
from edgelog.plans.main import main
from edgelog.sinks import writers
from edgelog.sources import readers
from edgelog.streaming import drain, hour_rank, ledger, runner, windows
from tests.helpers import rows

PLACED = "value string, topic string, partition int, offset bigint"


def _append(frame, path):
    frame.coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)


def _source(spark, path, schema="value string"):
    return readers.source(spark, "parquet", schema, path, maxFilesPerTrigger=1)


def _ended(query):
    assert query.awaitTermination(120)
    assert query.exception() is None


def _numbers(spark, path, files=3):
    for i in range(files):
        _append(spark.createDataFrame([(f"{i}-{k}",) for k in range(5)], "value string"), path)
    return path


# ---- drain -------------------------------------------------------------------------

def test_a_stop_inside_a_slow_batch_lets_it_finish(spark, tmp_path):
    """The engine's stop() cuts the batch off; a drain waits for it and its commit."""
    source, out = _numbers(spark, str(tmp_path / "in")), str(tmp_path / "out")
    inside, done = threading.Event(), []

    def slow(df, batch):
        inside.set()
        time.sleep(1.5)
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")
        done.append(batch)

    for how in ("stop", "drain"):
        checkpoint = str(tmp_path / how)
        inside.clear()
        done.clear()
        query = runner.run_stream(_source(spark, source), slow, checkpoint)
        assert inside.wait(60)
        if how == "stop":
            query.stop()
            assert not writers.found(spark, f"{checkpoint}/commits/0")
            continue
        assert drain.drain(spark, query, checkpoint) and done == [0]
        assert not query.isActive and query.exception() is None
        assert writers.found(spark, f"{checkpoint}/commits/0") and not writers.found(spark, f"{checkpoint}/commits/1")
        _ended(runner.run_stream(_source(spark, source), slow, checkpoint))
        assert done == [0, 1, 2]
        assert spark.read.parquet(out).count() == 15


def test_a_drain_that_gives_up_lets_the_stream_go_on(spark, tmp_path):
    source, done, inside = _numbers(spark, str(tmp_path / "in"), 2), [], threading.Event()

    def slow(df, batch):
        inside.set()
        time.sleep(2)
        done.append(batch)

    checkpoint = str(tmp_path / "c")
    query = runner.run_stream(_source(spark, source), slow, checkpoint)
    assert inside.wait(60)
    assert not drain.drain(spark, query, checkpoint, timeout=0.3)
    _ended(query)
    assert done == [0, 1] and not drain.stop_requested(spark, checkpoint)


def test_a_marker_of_another_process_ends_a_running_stream(spark, tmp_path):
    source, checkpoint, seen = _numbers(spark, str(tmp_path / "in")), str(tmp_path / "c"), []
    query = runner.run_stream(_source(spark, source), lambda df, b: seen.append(b), checkpoint, interval="200 milliseconds")
    while len(seen) < 3:
        time.sleep(0.1)
    main(["stop-stream", checkpoint], spark)
    drain.supervise(spark, query, checkpoint, poll=0.1)
    assert not query.isActive and not drain.stop_requested(spark, checkpoint)


def test_a_stream_without_input_ends_after_a_pause(spark, tmp_path):
    source, checkpoint, seen = _numbers(spark, str(tmp_path / "in")), str(tmp_path / "c"), []
    before = spark.conf.get("spark.sql.streaming.noDataProgressEventInterval", None)
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "300")
    try:
        query = runner.run_stream(_source(spark, source), lambda df, b: seen.append(b), checkpoint, interval="100 milliseconds")
    finally:
        spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", before or "10000")
    drain.supervise(spark, query, checkpoint, poll=0.1, idle=0.5)
    assert seen == [0, 1, 2] and not query.isActive


def test_errors_of_a_stream_are_raised(spark, tmp_path):
    def broken(df, batch):
        raise RuntimeError("no disk")

    query = runner.run_stream(_source(spark, _numbers(spark, str(tmp_path / "in"))), broken, str(tmp_path / "c"))
    with pytest.raises(Exception, match="no disk"):
        drain.supervise(spark, query, str(tmp_path / "c"), poll=0.1)


# ---- ledger ------------------------------------------------------------------------

def _placed(spark, path, batches):
    for offsets in batches:
        _append(spark.createDataFrame([(f"x{o}", "t", 0, o) for o in offsets], PLACED), path)
    return path


def test_gaps_between_and_inside_batches(spark, tmp_path):
    path = _placed(spark, str(tmp_path / "in"), [range(0, 10), [20, 21, 24, 24], range(25, 30)])
    base = str(tmp_path / "out")
    handler = ledger.recorded(lambda df, batch: None, base, "s")
    for run in ("c1", "c2"):  # the second run replaces the rows of the first
        _ended(runner.run_stream(_source(spark, path, PLACED), handler, str(tmp_path / run), writer="w"))
    kept = ledger.ledger(spark, base)
    assert rows(kept, ["batch", "rows", "first_offset", "last_offset", "distinct_rows"]) == [(0, 10, 0, 9, 10), (1, 3, 20, 24, 4), (2, 5, 25, 29, 5)]  # by column name
    assert rows(ledger.gaps(kept), ["place", "from_offset", "to_offset", "lost"]) == [(10, 10, "between", 19), (20, 2, "inside", 24)]
    there = spark.createDataFrame([("t", 0, 40)], "topic string, partition int, earliest bigint")
    assert [(r.next_offset, r.lost) for r in ledger.stale(kept, there).collect()] == [(30, 10)]
    assert ledger.stale(kept, there.withColumn("earliest", F.lit(30))).count() == 0


def test_inputs_without_offsets_are_counted(spark, tmp_path):
    base = str(tmp_path / "out")
    handler = ledger.recorded(lambda df, batch: None, base, "s")
    runner.run_stream(_source(spark, _numbers(spark, str(tmp_path / "in"))), handler, str(tmp_path / "c")).awaitTermination(120)
    kept = ledger.ledger(spark, base)
    assert kept.agg(F.sum("rows")).first()[0] == 15 and ledger.gaps(kept).count() == 0


def test_the_engine_reports_every_batch(spark, tmp_path):
    base, source = str(tmp_path / "out"), _numbers(spark, str(tmp_path / "in"))
    main(["raw-stream", "--format", "parquet", "--path", source, "--max-per-trigger", "1", "--out", base, "--checkpoint", str(tmp_path / "c"), "--ledger"], spark)
    for _ in range(100):
        if writers.found(spark, f"{base}/progress") and ledger.progress(spark, base).count() == 3:
            break
        time.sleep(0.1)
    told = ledger.progress(spark, base)
    assert [r.batch for r in told.orderBy("batch").collect()] == [0, 1, 2]
    assert ledger.progress_gaps(told).count() == 0
    lost = told.where("batch <> 1")
    assert [(r.batch, r.after_batch) for r in ledger.progress_gaps(lost).collect()] == [(2, 0)]
    assert ledger.ledger(spark, base).agg(F.sum("rows")).first()[0] == 15
    main(["gaps", base, str(tmp_path / "gaps")], spark)
    assert spark.read.parquet(str(tmp_path / "gaps")).count() == 0


# ---- ranks of whole hours ----------------------------------------------------------

def _log_files(log, names, path, wheres):
    for where in wheres:
        _append(log.where(where).selectExpr(f"{fixture.wire_sql(names)} AS value"), path)
    return path


def test_a_url_below_the_cut_of_every_batch_is_found(spark, tmp_path):
    """Each batch has a top of its own; one URL is second in all of them and first in the hour."""
    at = {n: i for i, n in enumerate(L.VENDOR_34)}

    def text(url):
        fields = ["-"] * len(L.VENDOR_34)
        fields[at["time_unix"]], fields[at["domain"]], fields[at["request"]] = "1704067200", "d", url
        fields[at["http_status"]], fields[at["body_bytes_sent"]] = "200", "1"
        return fixture.SEP.join(fields)

    path = str(tmp_path / "in")
    # metrics that tie are won by the highest id: this URL has the lowest
    steady = min((f"/steady{i}" for i in range(200)), key=lambda u: hashlib.md5(f"d{u}1704067200".encode()).hexdigest())
    for batch in range(3):
        urls = [f"/top{batch}"] * 4 + [steady] * 3 + [f"/other{batch}"]
        _append(spark.createDataFrame([(text(u),) for u in urls], "value string"), path)
    out = {}
    for name, run in (
        ("batch", lambda base, c: [runner.run_stream(_source(spark, path), runner.rank_handler(base, n=1), c)]),
        ("hour", lambda base, c: hour_rank.run_hour_rank(_source(spark, path), base, c, n=1)),
    ):
        base = str(tmp_path / name)
        for query in run(base, str(tmp_path / f"c-{name}")):
            _ended(query)
        out[name] = base
    assert steady not in {r.request for r in writers.read_routed(spark, f"{out['batch']}/rank").collect()}
    tops = hour_rank.hour_tops(spark, out["hour"]).collect()
    assert (steady, 9.0) in {(r.request, r.req_count) for r in tops}


def test_hour_lists_survive_a_restart_and_keep_rejects(spark, log, tmp_path):
    path = _log_files(log, L.VENDOR_34, str(tmp_path / "in"), [f"line_num div 4 % 3 = {b}" for b in range(3)])
    wild = spark.createDataFrame([(fixture.SEP.join(["no number"] * len(L.VENDOR_34)),)], "value string")
    _append(wild, path)
    base, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    for files in (1, 6):  # the second start goes on from the state of the first
        source = readers.source(spark, "parquet", "value string", path, maxFilesPerTrigger=files)
        ranks, rejects = hour_rank.run_hour_rank(source, base, checkpoint, n=4)
        if files == 1:
            drain.drain(spark, ranks, f"{checkpoint}/ranks")
            drain.drain(spark, rejects, f"{checkpoint}/rejects")
        for query in (ranks, rejects):
            _ended(query)
    want = rank.top_union(rank.url_hour(log), 4, by=["domain", "time_unix"])
    cols = ["id", "domain", "request", "time_unix", *L.RANK_MEASURES]
    assert rows(hour_rank.hour_tops(spark, base), cols) == rows(want, cols)
    assert spark.read.parquet(f"{base}/quarantine").count() == 1


# ---- windows -----------------------------------------------------------------------

def test_closed_windows_and_late_rows_are_the_input(spark, log, tmp_path):
    good, _ = clean.clean_band(log)
    start = 1704067200
    hours = [f"(time_unix - {start}) div 3600 = {h}" for h in (2, 0, 3, 1)]
    path = _log_files(log, L.VENDOR_37, str(tmp_path / "in"), hours)
    base = str(tmp_path / "out")
    handler = windows.late_band_handler(base, delay=300)
    for run in ("c1", "c2"):  # a replay finds the same times
        _ended(runner.run_stream(_source(spark, path), handler, str(tmp_path / run), writer="w"))
    cols = [*L.FUSION_KEYS, "from_time", "req_count", "traffic"]
    sides = (windows.window_rows(spark, base, L.FUSION_KEYS), windows.late_rows(spark, base, L.FUSION_KEYS))
    want = band.band(good, L.FUSION_KEYS, 60)
    for side, which in zip(sides, ((2, 3), (0, 1))):
        hour = F.floor((F.col("from_time") - start) / 3600)
        assert rows(side, cols) == rows(want.where(hour.isin(*which)), cols)
    assert spark.read.parquet(f"{base}/quarantine").count() == log.count() - good.count()


def test_an_empty_batch_keeps_the_time(spark, tmp_path):
    base = str(tmp_path / "out")
    token = writers.CURRENT_WRITER.set("w")
    try:
        assert windows._newest(spark, base, 3) is None
        for batch, newest in ((0, 100), (4, 200)):
            spark.createDataFrame([(newest,)], "newest bigint").coalesce(1).write.parquet(f"{base}/watermark/w/{batch}")
        assert [windows._newest(spark, base, b) for b in (0, 1, 4, 5, 9)] == [None, 100, 100, 200, 200]
    finally:
        writers.CURRENT_WRITER.reset(token)
