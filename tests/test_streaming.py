from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalog import fixture
from edgelog import layouts as L
from edgelog.operators import archive, band, clean, filters, parse, rank
from edgelog.sinks import writers
from edgelog.sources import readers
from edgelog.streaming import runner
from tests.helpers import rows

FILES = 3


def _replay(log, names, path, extra=()):
    """Lines of the log in files of rising time."""
    text = log.selectExpr("time_unix", "line_num", f"{fixture.wire_sql(names)} AS value", *extra)
    ordered = text.repartitionByRange(FILES, "time_unix").sortWithinPartitions("time_unix")
    ordered.drop("time_unix", "line_num").write.parquet(path)
    return path


def _source(spark, path, schema="value string"):
    return readers.source(spark, "parquet", schema, path, maxFilesPerTrigger=1)


def _run(stream, handler, checkpoint, writer="replayed"):
    query = runner.run_stream(stream, handler, checkpoint=checkpoint, writer=writer)
    query.awaitTermination()
    assert query.exception() is None
    return query


@pytest.fixture(scope="module")
def vendor(log, tmp_path_factory):
    return _replay(log, L.VENDOR_37, str(tmp_path_factory.mktemp("in") / "vendor"))


@pytest.fixture(scope="module")
def own(log, tmp_path_factory):
    return _replay(log, L.OWN_45, str(tmp_path_factory.mktemp("in") / "own"))


def test_band_stream_equals_batch_and_survives_replay(spark, log, vendor, tmp_path):
    base = str(tmp_path / "out")
    handler = runner.band_handler(base, "fusion", as_of=1704067200)
    _run(_source(spark, vendor), handler, str(tmp_path / "c1"))
    good, _ = clean.clean_band(log)
    cols = [*L.FUSION_KEYS, "from_time", "req_count", "traffic"]
    stored = spark.read.parquet(f"{base}/band").count()
    for prefix, width in ((L.INDEX_BAND_1M, 60), (L.INDEX_BAND_5M, 300)):
        got = runner.band_view(spark, base, prefix, L.FUSION_KEYS)
        assert rows(got, cols) == rows(band.band(good, L.FUSION_KEYS, width), cols)
    assert spark.read.parquet(f"{base}/band").select("batch").distinct().count() == FILES
    assert spark.read.parquet(f"{base}/quarantine").count() == log.count() - good.count()
    # The same batches once more, as after a lost checkpoint.
    _run(_source(spark, vendor), handler, str(tmp_path / "c2"))
    assert spark.read.parquet(f"{base}/band").count() == stored
    # Nothing new: the old checkpoint has no work left.
    query = _run(_source(spark, vendor), handler, str(tmp_path / "c1"))
    assert sum(p["numInputRows"] for p in query.recentProgress) == 0


def test_band_ids_differ_between_batches(spark, vendor, tmp_path):
    base = str(tmp_path / "out")
    _run(_source(spark, vendor), runner.band_handler(base, as_of=1704067200), str(tmp_path / "c"))
    table = spark.read.parquet(f"{base}/band")
    assert table.select("id").distinct().count() == table.count()


def test_own_band_counts_hosts(spark, log, own, tmp_path):
    base = str(tmp_path / "out")
    _run(_source(spark, own), runner.band_handler(base, "jx", as_of=1704067200), str(tmp_path / "c"))
    good, _ = clean.clean_band(log)
    cols = [*L.JX_KEYS, "from_time", "req_count", "traffic"]
    assert rows(runner.band_view(spark, base, L.INDEX_BAND_5M, L.JX_KEYS), cols) == rows(band.band(good, L.JX_KEYS, 300), cols)
    hosts = spark.read.parquet(f"{base}/host").groupBy(*L.HOST_KEYS, "log_date").agg(F.sum("req_count").alias("req_count"))
    cols = [*L.HOST_KEYS, "log_date", "req_count"]
    assert rows(hosts, cols) == rows(band.host_status(good), cols)


def test_broker_offsets_tag_the_batch(spark, log, tmp_path):
    path = _replay(log, L.VENDOR_37, str(tmp_path / "in"), ("CAST(line_num % 3 AS INT) AS partition", "line_num AS offset"))
    base, seen = str(tmp_path / "out"), []
    stream = _source(spark, path, "value string, partition int, offset bigint")

    def note(df, batch):
        seen.append(runner._tags(df, batch))

    _run(stream, runner.fan_out(note, runner.band_handler(base, as_of=1704067200)), str(tmp_path / "c"))
    assert len(seen) == FILES and all(t.startswith("0-") and len(a.split(";")) == 4 for t, a in seen)
    table = spark.read.parquet(f"{base}/band")
    assert table.select("id").distinct().count() == table.count()


def test_detail_stream(spark, log, own, vendor, tmp_path):
    base = str(tmp_path / "own")
    _run(_source(spark, own), runner.detail_handler(base, "jx"), str(tmp_path / "c1"))
    kept = filters.keep_policy(log).where("body_bytes_sent <> '-'")
    table = writers.latest(writers.read_routed(spark, f"{base}/detail"))
    assert rows(table, ["id"]) == rows(kept.select(F.concat_ws("-", "X_Info_request_id", "layer").alias("id")))
    assert {r[0] for r in table.select("index_name").distinct().collect()} == {f"nginx-{f}-2024.01" for f in ("bs", "ws", "vc", "up")}
    base = str(tmp_path / "vendor")
    for run in ("c2", "c3"):
        _run(_source(spark, vendor), runner.detail_handler(base, "fusion"), str(tmp_path / run))
    table = writers.read_routed(spark, f"{base}/detail")
    assert table.count() == log.where("body_bytes_sent <> '-'").count()
    assert table.select("index_name").distinct().count() == 4
    bad = spark.read.parquet(f"{base}/quarantine")
    assert bad.count() == log.where("body_bytes_sent = '-'").count()
    assert {r[0] for r in bad.select("reason").distinct().collect()} == {"bad body_bytes_sent"}


def test_rank_stream(spark, log, vendor, tmp_path):
    base = str(tmp_path / "out")
    _run(_source(spark, vendor), runner.rank_handler(base, n=100), str(tmp_path / "c"))
    table = writers.read_routed(spark, f"{base}/rank")
    assert {r[0] for r in table.select("index_name").distinct().collect()} == {"urlstats-2024.01"}
    # With n above the number of URLs the batches hold everything, so their sum is the rollup.
    cols = ["domain", "request", "time_unix", *L.RANK_MEASURES]
    assert rows(rank.merge_url_hour(table), cols) == rows(rank.url_hour(log), cols)


def test_archive_stream_and_pruned_scan(spark, log, vendor, tmp_path):
    base = str(tmp_path / "out")
    for run in ("c1", "c2"):
        _run(_source(spark, vendor), runner.archive_handler(base, as_of=1704067200), str(tmp_path / run))
    table = writers.read_routed(spark, f"{base}/archive", ["table_suffix"])
    assert table.count() == log.count()
    scan = archive.archive_scan(spark.read.schema(table.schema).parquet(f"{base}/archive"), "202401010800", "202401010802", "WS")
    text = scan._jdf.queryExecution().toString()
    filters_ = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "table_suffix" in filters_
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "log_minute" in pushed and "firm_name" in pushed
    assert scan.count() == log.where("firm_name = 'WS' AND time_unix < 1704067200 + 120").count()


def test_sql_stream(spark, log, vendor, tmp_path):
    out = str(tmp_path / "out")
    query = "SELECT lowfirmname, filetime, count(*) AS n, sum(body_bytes_sent) AS size FROM batch GROUP BY ALL"

    def sink(df, batch):
        df.withColumn("batch", F.lit(batch)).write.mode("append").parquet(out)

    _run(_source(spark, vendor), runner.sql_handler("batch", query, sink, str(tmp_path / "bad")), str(tmp_path / "c"))
    got = spark.read.parquet(out).groupBy("lowfirmname", "filetime").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    want = log.where("body_bytes_sent <> '-'").groupBy(F.lower("firm_name").alias("lowfirmname"), F.lit("20240101").alias("filetime")).agg(
        F.count("*").alias("n"), F.sum(F.col("body_bytes_sent").cast("bigint")).alias("size")
    )
    assert rows(got) == rows(want)


def test_empty_batches_are_skipped():
    calls = []

    class Frame:
        def __init__(self, empty):
            self.empty = empty

        def isEmpty(self):
            return self.empty

    handler = runner._skip_empty(lambda df, batch: calls.append(batch))
    handler(Frame(True), 1)
    handler(Frame(False), 2)
    assert calls == [2]


def test_watermark_closes_buckets_in_time_order(spark, log, tmp_path):
    good, _ = clean.clean_band(log)
    cols = ["layer", "time_unix", "body_bytes_sent"]
    path = str(tmp_path / "in")
    # Hour after hour, then one record far ahead that closes every bucket before it.
    for hour in range(4):
        start = 1704067200 + hour * 3600
        good.select(*cols).where((F.col("time_unix") >= start) & (F.col("time_unix") < start + 3600)).coalesce(1).write.mode(
            "append"
        ).parquet(path)
    end = spark.createDataFrame([("end", 1704067200.0 + 10 * 86400, 0.0)], good.select(*cols).schema)
    end.coalesce(1).write.mode("append").parquet(path)
    stream = _source(spark, path, end.schema)
    out = runner.watermarked_band(stream, ["layer"], "10 minutes")
    query = (
        out.writeStream.format("memory").queryName("closed").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    want = band.band(good, ["layer"]).select("layer", "from_time", "req_count", "traffic")
    assert rows(spark.table("closed")) == rows(want)


def test_rollup_stream_with_late_window(spark, log, vendor, tmp_path):
    events, _ = parse.druid_events(_source(spark, vendor))
    out = str(tmp_path / "out")
    query = (
        runner.watermarked_rollup(events, "2280 minutes").writeStream.outputMode("update")
        .foreachBatch(lambda df, b: writers.write_event_store(df, out, b))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    table = writers.latest(writers.read_routed(spark, out, ["day"]), ["time_local", "domain"])
    got = table.select(F.unix_seconds("time_local").alias("t"), "domain", "body_bytes_sent", "day")
    want = log.where("body_bytes_sent <> '-'").groupBy(F.col("time_unix").alias("t"), "domain").agg(
        F.sum(F.col("body_bytes_sent").cast("bigint")).alias("body_bytes_sent")
    ).withColumn("day", F.lit("20240101"))
    assert rows(got) == rows(want)


def test_kafka_options():
    got = readers.kafka_options("b:1", ["x", "y"], "earliest", 500)
    assert got == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "x,y", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "500",
    }
