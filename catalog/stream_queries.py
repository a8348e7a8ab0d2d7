"""Streams whose state, order or end matter, as checked queries: each replays the log as files
of a set order, and what its tables hold must equal SQL over the same log."""

from __future__ import annotations

import threading
import time
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixture as fx
from catalog.job_queries import _BAND_SQL, _TOTALS, _folder, _lines, _run, _stored
from catalog.queries import GOOD, MINUTE, TOTAL, URLS, band_sql, query
from edgelog import layouts as L
from edgelog.operators import archive, clean, parse, rank
from edgelog.sinks import archive_layout, snapshots, writers
from edgelog.sources import readers
from edgelog.streaming import drain, hour_rank, ledger, runner, windows

_START = 1704067200


#: Rows of a file; a batch is read by as many tasks as it has files.
_FILE_ROWS = 50_000


class Batches(NamedTuple):
    """Files of a folder, ``width`` of them a batch, in the order they were written."""

    path: str
    width: int


def _files(frames: list[DataFrame], path: str, width: int | None = None) -> Batches:
    """A batch per frame, its rows dealt among ``width`` files, by default as many as the largest frame needs.

    Where a frame has fewer rows than files, empty files make up the number, by which the file source tells batches.
    """
    width = width or max(1, *(-(-frame.count() // _FILE_ROWS) for frame in frames))
    spark = frames[0].sparkSession
    for frame in frames:
        whole = _written(spark, path) + width
        frame.repartition(width).write.mode("append").parquet(path)
        while _written(spark, path) < whole:
            spark.createDataFrame([], frame.schema).write.mode("append").parquet(path)
        time.sleep(0.05)
    return Batches(path, width)


def _written(spark: SparkSession, path: str) -> int:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*.parquet")
    return len(where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or ())


def _hours(spark: SparkSession, sf: str, hours: list[str], path: str) -> Batches:
    return _files([_lines(spark, sf, L.VENDOR_37, f"(time_unix - {_START}) div 3600 IN ({h})") for h in hours], path)


def _source(spark: SparkSession, files: Batches, schema=L.RAW_LINE_SCHEMA) -> DataFrame:
    return readers.source(spark, "parquet", schema, files.path, maxFilesPerTrigger=files.width)


# ---- ending a stream ---------------------------------------------------------------

@query("stream_drained", _BAND_SQL)
def _(spark, sf):
    """A stop asked for inside the second of four batches lets it finish; the next run does the rest."""
    base = _folder(spark, "drained")
    source, checkpoint = _hours(spark, sf, ["0", "1", "2", "3"], f"{base}/in"), f"{base}/c"
    write, asked, started = runner.band_handler(f"{base}/out"), [], []

    def slow(df: DataFrame, batch: int) -> None:
        if batch == 1 and not asked:
            while not started:
                time.sleep(0.05)
            asked.append(threading.Thread(target=drain.drain, args=(spark, started[0], checkpoint)))
            asked[0].start()
            while not drain.stop_requested(spark, checkpoint):
                time.sleep(0.05)
        write(df, batch)

    for _ in range(2):
        started.append(runner.run_stream(_source(spark, source), slow, checkpoint))
        started[-1].awaitTermination()
    asked[0].join()
    return runner.band_view(spark, f"{base}/out", L.INDEX_BAND_5M, L.FUSION_KEYS)


# ---- what was read -----------------------------------------------------------------

_TOPIC = "'t' || CAST(line_num % 2 AS STRING) AS topic, CAST(line_num % 3 AS INT) AS partition"
# Two planted losses: a range between two batches of one partition, and single offsets inside batches.
_LOST = "(o >= 50 AND o < 60 AND line_num % 6 = 1) OR (o = 20 AND line_num % 6 = 4) OR (o = 131 AND line_num % 6 = 2)"
_BATCHES = ["o < 50", "o >= 50 AND o < 120", "o >= 120"]
_PLACED = (
    f"SELECT topic, partition, o, CASE WHEN {_BATCHES[0]} THEN 0 WHEN {_BATCHES[1]} THEN 1 ELSE 2 END AS batch FROM "
    f"(SELECT {_TOPIC}, line_num, line_num // 6 AS o FROM log) WHERE NOT ({_LOST})"
)


@query(
    "stream_ledger",
    fx.with_log(
        "SELECT 'rows' AS kind, topic, partition, min(o) AS from_offset, max(o) AS to_offset, count(*) AS n FROM p GROUP BY ALL UNION ALL "
        "SELECT 'between', topic, partition, b + 1, a - 1, a - b - 1 FROM "
        "(SELECT *, lag(e) OVER (PARTITION BY topic, partition ORDER BY a) AS b FROM s) WHERE a > b + 1 UNION ALL "
        "SELECT 'inside', topic, partition, a, e, e - a + 1 - n FROM s WHERE e - a + 1 > n",
        p=_PLACED, s="SELECT topic, partition, batch, min(o) AS a, max(o) AS e, count(*) AS n FROM p GROUP BY ALL",
    ),
)
def _(spark, sf):
    """Offsets per topic and partition, and the planted losses, from the table the stream keeps."""
    base = _folder(spark, "ledger")
    line = fx.wire_sql(L.VENDOR_37)
    placed = fx.log(spark, sf).selectExpr("*", "line_num div 6 AS o").where(f"NOT ({_LOST})")
    part = lambda which: placed.where(which).selectExpr(f"{line} AS value", *_TOPIC.split(", "), "o AS offset")
    files = _files([part(b) for b in _BATCHES], f"{base}/in")
    handler = ledger.recorded(runner.raw_handler(f"{base}/out"), f"{base}/out", "raw")
    runner.run_stream(_source(spark, files, "value string, topic string, partition int, offset bigint"), handler, f"{base}/c").awaitTermination()
    kept = ledger.ledger(spark, f"{base}/out")
    place = ["topic", "partition"]
    rows = kept.groupBy(*place).agg(F.lit("rows").alias("kind"), F.min("first_offset").alias("from_offset"), F.max("last_offset").alias("to_offset"), F.sum("rows").alias("n"))
    lost = ledger.gaps(kept).select(*place, F.col("place").alias("kind"), "from_offset", "to_offset", F.col("lost").alias("n"))
    return rows.unionByName(lost)


@query(
    "stream_balance",
    fx.with_log(
        f"SELECT CAST((time_unix - {_START}) // 3600 AS BIGINT) AS batch, count(*) AS rows, count(*) FILTER ({GOOD}) AS good, "
        f"count(*) FILTER (NOT ({GOOD})) AS bad FROM log GROUP BY 1"
    ),
)
def _(spark, sf):
    """Rows read, kept and rejected per batch."""
    base = _folder(spark, "balance")
    files = _hours(spark, sf, ["0", "1", "2", "3"], f"{base}/in")
    handler = ledger.recorded(runner.detail_handler(f"{base}/out"), f"{base}/out", "detail")
    runner.run_stream(_source(spark, files), handler, f"{base}/c").awaitTermination()
    return ledger.balance(spark, f"{base}/out").select("batch", "rows", "good", "bad")


# ---- state -------------------------------------------------------------------------

def _hour_top(metric: str, n: int) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY domain, time_unix ORDER BY {metric} DESC, id DESC) AS rn "
        f"FROM urls) WHERE rn <= {n}"
    )


@query("stream_hour_rank", fx.with_log(" UNION ".join(f"({_hour_top(m, 3)})" for m in rank.TOP_METRICS), urls=URLS))
def _(spark, sf):
    """Five batches that each hold a part of every hour: the lists are those of the whole hours."""
    base = _folder(spark, "hour-rank")
    files = _files([_lines(spark, sf, L.VENDOR_34, f"line_num div 4 % 5 = {b}") for b in range(5)], f"{base}/in")
    for query_ in hour_rank.run_hour_rank(_source(spark, files), f"{base}/out", f"{base}/c", n=3):
        query_.awaitTermination()
    columns = ["id", "time_unix", "domain", "request", *L.RANK_MEASURES]
    return hour_rank.hour_tops(spark, f"{base}/out").select(*columns)


def _chained(spark: SparkSession, sf: str, widths: tuple[str, ...]) -> DataFrame:
    """The hours in order, then a line of a later day, which closes every window before it."""
    base = _folder(spark, "chained")
    files = _hours(spark, sf, ["0", "1", "2", "3"], f"{base}/in")
    later = fx.log(spark, sf).limit(1).withColumn("time_unix", F.col("time_unix") + 30 * 86400).withColumn("body_bytes_sent", F.lit("0"))
    _files([later.selectExpr(f"{fx.wire_sql(L.VENDOR_37)} AS value")], *files)
    good, _ = clean.clean_band(parse.parse_lines(_source(spark, files), "fusion_band37")[0])
    closed = windows.chained_band(good, L.FUSION_KEYS, "10 minutes", widths)
    out = f"{base}/out"
    stream = runner.run_stream(closed, lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/batch={batch}"), f"{base}/c")
    stream.awaitTermination()
    return spark.read.parquet(out).select(*_TOTALS)


@query("stream_chained_1m", fx.with_log(f"SELECT {', '.join(_TOTALS)} FROM b", b=band_sql(L.FUSION_KEYS, MINUTE, "m1")))
def _(spark, sf):
    return _chained(spark, sf, ("60 seconds",))


@query("stream_chained_5m", _BAND_SQL)
def _(spark, sf):
    """Five minutes from the closed minutes, both in one query."""
    return _chained(spark, sf, ("60 seconds", "300 seconds"))


@query(
    "stream_late_rows",
    fx.with_log(
        f"SELECT CASE WHEN (time_unix - {_START}) // 3600 IN (1, 3) THEN 'window' ELSE 'late' END AS kind, {', '.join(L.FUSION_KEYS)}, "
        f"{MINUTE} AS from_time, count(*) AS req_count, {TOTAL} AS traffic FROM log WHERE {GOOD} GROUP BY ALL"
    ),
)
def _(spark, sf):
    """Hours 1 and 3 come in order, hours 0 and 2 after the close of their windows: nothing is lost."""
    base = _folder(spark, "late")
    files = _hours(spark, sf, ["1", "3", "0, 2"], f"{base}/in")
    handler = windows.late_band_handler(f"{base}/out", delay=600)
    runner.run_stream(_source(spark, files), handler, f"{base}/c").awaitTermination()
    sides = (("window", windows.window_rows), ("late", windows.late_rows))
    parts = [side(spark, f"{base}/out", L.FUSION_KEYS).withColumn("kind", F.lit(name)) for name, side in sides]
    return parts[0].unionByName(parts[1])


# ---- tables ------------------------------------------------------------------------

@query(
    "snapshot_newest",
    fx.with_log(
        "SELECT index_name, id, line_num, traffic FROM (SELECT firm_name AS index_name, CAST(line_num // 5 % 97 AS STRING) AS id, line_num, "
        "coalesce(TRY_CAST(body_bytes_sent AS DOUBLE), 0) AS traffic, "
        "row_number() OVER (PARTITION BY firm_name, line_num // 5 % 97 ORDER BY line_num % 5 DESC, line_num DESC) AS rn FROM log "
        "WHERE NOT (firm_name = 'VC' AND line_num % 5 > 1)) WHERE rn = 1"
    ),
)
def _(spark, sf):
    """Five batches and a snapshot brought up to date twice among them; one index gets no rows after the second."""
    base = _folder(spark, "snapshot")
    log = fx.log(spark, sf).where("NOT (firm_name = 'VC' AND line_num % 5 > 1)").selectExpr(
        "firm_name AS index_name", "CAST(line_num div 5 % 97 AS STRING) AS id", "line_num", "coalesce(try_cast(body_bytes_sent AS DOUBLE), 0D) AS traffic",
    )
    for batch in range(5):
        rows = log.where(f"line_num % 5 = {batch}").groupBy("index_name", "id").agg(F.max("line_num").alias("line_num"), F.max_by("traffic", "line_num").alias("traffic"))
        writers.routed_upsert(rows, f"{base}/t", batch, writer="w")
        if batch in (1, 2):
            snapshots.refresh(spark, f"{base}/t", f"{base}/s")
    return snapshots.newest_rows(spark, f"{base}/t", f"{base}/s").select("index_name", "id", "line_num", "traffic")


_COVER = [
    "CASE WHEN o_custkey % 3 > 0 THEN 'f' || CAST(o_custkey % 3 AS STRING) END AS firm_name",
    "CAST(o_orderkey * 37 % 1000 AS BIGINT) * 300 AS a", "CAST(o_orderkey * 37 % 1000 + o_orderkey % 50 AS BIGINT) * 300 AS e", "CAST(o_orderkey AS BIGINT) AS run",
]


@query(
    "coverage_intervals",
    f"WITH r AS (SELECT {", ".join(_COVER)} FROM orders WHERE o_orderkey % 40 = 3), "
    "steps AS (SELECT firm_name, t, max(run) AS run FROM (SELECT firm_name, run, unnest(range(a, e, 300)) AS t FROM r) GROUP BY firm_name, t), "
    "marks AS (SELECT *, CASE WHEN lag(run) OVER w = run AND lag(t) OVER w = t - 300 THEN 0 ELSE 1 END AS fresh FROM steps WINDOW w AS (PARTITION BY firm_name ORDER BY t)), "
    "parts AS (SELECT *, sum(fresh) OVER (PARTITION BY firm_name ORDER BY t) AS part FROM marks) "
    'SELECT firm_name, min(t) AS "start", max(t) + 300 AS "end", max(run) AS run FROM parts GROUP BY firm_name, part',
)
def _(spark, sf):
    """Rebuilt ranges, overlapping and of some firms or all, as intervals with their newest run."""
    orders = spark.read.parquet(f"{sf}/orders.parquet").where("o_orderkey % 40 = 3").selectExpr(*_COVER)
    return writers.coverage_intervals(orders.withColumnsRenamed({"a": "start", "e": "end"}))


# ---- streams that had no SQL beside them -------------------------------------------

@query(
    "stream_sql",
    fx.with_log(
        "SELECT lower(firm_name) AS lowfirmname, '20240101' AS filetime, count(*) AS n, CAST(sum(CAST(body_bytes_sent AS BIGINT)) AS BIGINT) AS size "
        f"FROM log WHERE {GOOD} GROUP BY ALL"
    ),
)
def _(spark, sf):
    """User SQL over each of four batches; its partial rows add up."""
    base = _folder(spark, "sql")
    files = _hours(spark, sf, ["0", "1", "2", "3"], f"{base}/in")
    sink = lambda df, batch: writers.routed_upsert(df, f"{base}/out", batch)
    text = "SELECT 'sums' AS index_name, lowfirmname, filetime, count(*) AS n, sum(body_bytes_sent) AS size FROM batch GROUP BY ALL"
    runner.run_stream(_source(spark, files), runner.sql_handler("batch", text, sink, f"{base}/bad"), f"{base}/c").awaitTermination()
    sums = writers.read_routed(spark, f"{base}/out").groupBy("lowfirmname", "filetime")
    return sums.agg(F.sum("n").alias("n"), F.sum("size").cast("bigint").alias("size"))


@query(
    "stream_fan_out",
    fx.with_log(
        f"SELECT 'band' AS output, count(*) AS n FROM log WHERE {GOOD} UNION ALL SELECT 'archive', count(*) FROM log UNION ALL "
        "SELECT 'raw', count(*) FROM log"
    ),
)
def _(spark, sf):
    """Three outputs of each batch, read once."""
    base = _folder(spark, "fan-out")
    out = f"{base}/out"
    handler = runner.fan_out(runner.band_handler(out), runner.archive_handler(out, as_of=_START), runner.raw_handler(out))
    _run(spark, _stored(spark, sf, base, "in", L.VENDOR_37), handler, f"{base}/c")
    rows = runner.band_view(spark, out, L.INDEX_BAND_1M, L.FUSION_KEYS).agg(F.sum("req_count").alias("n")).select(F.lit("band").alias("output"), "n")
    for name in ("archive", "raw"):
        table = writers.read_routed(spark, f"{out}/{name}", ["table_suffix"])
        rows = rows.unionByName(table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("output"), "n"))
    return rows


@query(
    "stream_detail",
    fx.with_log(
        "SELECT 'nginx-' || lower(firm_name) || '-2024.01' AS index_name, X_Info_request_id || '-' || layer AS id, http_status AS status, "
        f"CAST(body_bytes_sent AS DOUBLE) AS size FROM log WHERE {GOOD} AND (http_status NOT IN ('200', '206', '304') OR layer IN ('0', '1'))"
    ),
)
def _(spark, sf):
    """Own detail records: retention, cleaning, ids and indices, over two batches run twice."""
    base = _folder(spark, "detail")
    files = _files([_lines(spark, sf, L.OWN_45, f"line_num % 2 = {b}") for b in (0, 1)], f"{base}/in")
    for run in (0, 1):
        runner.run_stream(_source(spark, files), runner.detail_handler(f"{base}/out", "jx"), f"{base}/c{run}", writer="detail").awaitTermination()
    table = writers.read_routed(spark, f"{base}/out/detail")
    return table.select("index_name", "id", F.col("http_status").cast("string").alias("status"), F.col("body_bytes_sent").cast("double").alias("size"))


@query(
    "stream_events",
    fx.with_log(
        "SELECT '20240101' AS day, time_unix AS at, domain, CAST(sum(CAST(body_bytes_sent AS BIGINT)) AS BIGINT) AS size "
        f"FROM log WHERE {GOOD} GROUP BY ALL"
    ),
)
def _(spark, sf):
    """Bytes per event time and domain, by day; partial rows of four batches add up."""
    base = _folder(spark, "events")
    files = _files([_lines(spark, sf, L.VENDOR_37, f"line_num div 4 % 4 = {b}") for b in range(4)], f"{base}/in")
    runner.run_stream(_source(spark, files), runner.event_handler(f"{base}/out"), f"{base}/c").awaitTermination()
    table = writers.read_routed(spark, f"{base}/out/events", ["day"])
    return table.groupBy("day", F.unix_seconds("time_local").alias("at"), "domain").agg(F.sum("body_bytes_sent").alias("size"))


# ---- how the archive lies ----------------------------------------------------------

def _archive_on_disk(spark: SparkSession, sf: str, base: str) -> str:
    """The archive of the log in eight batches."""
    rows = fx.archive(spark, sf)
    for batch in range(8):
        writers.write_archive(rows.where(f"CAST(line_num AS BIGINT) % 8 = {batch}"), f"{base}/archive", batch, writer="w")
    return f"{base}/archive"


_WS = "firm_name = 'WS' AND log_minute >= '202401010801' AND log_minute < '202401011003'"


@query("archive_firm_clustered", fx.with_log(f"SELECT * FROM a WHERE {_WS}", a=fx.archive_sql()))
def _(spark, sf):
    """A firm's minutes from an archive in Morton order."""
    base = _folder(spark, "clustered")
    archive_layout.cluster(spark, _archive_on_disk(spark, sf, base), f"{base}/z", file_rows=500)
    stored = writers.read_routed(spark, f"{base}/z", ["table_suffix"])
    return archive.archive_scan(stored, "202401010801", "202401011003", firm="WS").drop("writer", "run", "batch")


@query("archive_substring_indexed", fx.with_log("SELECT * FROM a WHERE row_key LIKE '%0#!BS#%'", a=fx.archive_sql()))
def _(spark, sf):
    """Rows by a part of their key; the index knows the clustered files, but not those of a later batch."""
    base = _folder(spark, "keys")
    early, late = (fx.archive(spark, sf).where(f"CAST(line_num AS BIGINT) % 5 {op} 4") for op in ("<", "="))
    writers.write_archive(early, f"{base}/in", 0, writer="w")
    archive_layout.cluster(spark, f"{base}/in", f"{base}/z", file_rows=500)
    archive_layout.index_keys(spark, f"{base}/z", f"{base}/index")
    writers.write_archive(late, f"{base}/z", 1, writer="w")
    return archive_layout.scan_containing(spark, f"{base}/z", f"{base}/index", "0#!BS#").drop("writer", "run", "batch")
