"""Jobs and streams as checked queries: each writes to a folder of its own in the shared
folder, reads back what the tables hold, and must equal SQL over the same log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixture as fx
from catalog.queries import FIVE, GOOD, URLS, _LINE_SQL, band_sql, query
from edgelog import layouts as L
from edgelog.plans import jobs
from edgelog.session import shared_dir
from edgelog.sinks import writers
from edgelog.sources import readers
from edgelog.streaming import runner

_DAY = ("202401010000", "202401020000")
_TOTALS = [*L.FUSION_KEYS, "from_time", "req_count", "traffic"]


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/edgelog-{name}-{uuid.uuid4().hex}"


def _lines(spark, sf, names, where: str = "true") -> DataFrame:
    return fx.log(spark, sf).where(where).selectExpr(f"{fx.wire_sql(names)} AS value")


def _stored(spark, sf, base: str, name: str, names, where: str = "true") -> str:
    path = f"{base}/{name}"
    _lines(spark, sf, names, where).write.text(path)
    return path


def _run(spark, path: str, handler: runner.Handler, checkpoint: str, writer: str | None = None) -> None:
    stream = readers.source(spark, "text", L.RAW_LINE_SCHEMA, path)
    runner.run_stream(stream, handler, checkpoint, writer=writer).awaitTermination()


@query(
    "backfill_two_files",
    fx.with_log(f"SELECT 'backfill-' || lower(firm_name) || '-20240101' AS index_name, count(*) AS n FROM log WHERE {GOOD} GROUP BY 1"),
)
def _(spark, sf):
    base = _folder(spark, "backfill")
    for part in (0, 1):
        jobs.backfill(spark, _stored(spark, sf, base, f"in{part}", L.VENDOR_37, f"line_num % 2 = {part}"), f"{base}/out")
    return writers.read_routed(spark, f"{base}/out/detail").groupBy("index_name").agg(F.count(F.lit(1)).alias("n"))


_BAND_SQL = fx.with_log(f"SELECT {', '.join(_TOTALS)} FROM b", b=band_sql(L.FUSION_KEYS, FIVE, "m5"))


@query("stream_two_checkpoints", _BAND_SQL)
def _(spark, sf):
    base = _folder(spark, "streams")
    for part in (0, 1):
        path = _stored(spark, sf, base, f"in{part}", L.VENDOR_37, f"line_num % 2 = {part}")
        _run(spark, path, runner.band_handler(f"{base}/out"), f"{base}/c{part}")
    return runner.band_view(spark, f"{base}/out", L.INDEX_BAND_5M, L.FUSION_KEYS)


@query(
    "band_both_kinds",
    fx.with_log(
        "SELECT index_type, CAST(sum(req_count) AS BIGINT) AS req_count, sum(traffic) AS traffic FROM ("
        "SELECT 'bandwidth' AS index_type, req_count, traffic FROM f UNION ALL SELECT 'bandself', req_count, traffic FROM j) GROUP BY 1",
        f=band_sql(L.FUSION_KEYS, FIVE, "m5"), j=band_sql(L.JX_KEYS, FIVE, "m5"),
    ),
)
def _(spark, sf):
    base = _folder(spark, "kinds")
    for kind, names in (("fusion", L.VENDOR_37), ("jx", L.OWN_45)):
        _run(spark, _stored(spark, sf, base, kind, names), runner.band_handler(f"{base}/out", kind), f"{base}/c-{kind}")
    rows = writers.read_band(spark, f"{base}/out", L.INDEX_BAND_5M)
    return rows.groupBy("index_type").agg(F.sum("req_count").alias("req_count"), F.sum("traffic").alias("traffic"))


@query("band_after_rebuild", _BAND_SQL)
def _(spark, sf):
    base = _folder(spark, "rebuild")
    path = _stored(spark, sf, base, "in", L.VENDOR_37)
    _run(spark, path, runner.band_handler(f"{base}/out"), f"{base}/c")
    archive = fx.archive(spark, sf)
    for firm in ("WS", "BS", None):
        jobs.run_rebuild(spark, archive, f"{base}/out", *_DAY, firm=firm)
    return runner.band_view(spark, f"{base}/out", L.INDEX_BAND_5M, L.FUSION_KEYS)


@query("archive_replay_late", fx.with_log("SELECT table_suffix, count(*) AS n FROM (SELECT '20240101' AS table_suffix FROM log) GROUP BY 1"))
def _(spark, sf):
    """The first run stores the time it takes for "now"; the second, long after, finds it."""
    base = _folder(spark, "replay")
    path = _stored(spark, sf, base, "in", L.VENDOR_37)
    then = spark.range(1).select(F.lit(1704067200 + 86400).cast("bigint").alias("now"))
    then.coalesce(1).write.parquet(f"{base}/out/clock/archive/0")
    for run in (0, 1):
        _run(spark, path, runner.archive_handler(f"{base}/out"), f"{base}/c{run}", writer="archive")
    table = writers.read_routed(spark, f"{base}/out/archive", ["table_suffix"])
    return table.groupBy("table_suffix").agg(F.count(F.lit(1)).alias("n"))


@query(
    "wild_times",
    fx.with_log(
        "SELECT 'good' AS part, count(*) AS n FROM log WHERE line_num % 13 > 4 AND body_bytes_sent <> '-' UNION ALL "
        "SELECT 'bad time_unix', count(*) FROM log WHERE line_num % 13 <= 4 UNION ALL "
        "SELECT 'bad body_bytes_sent', count(*) FROM log WHERE line_num % 13 > 4 AND body_bytes_sent = '-'"
    ),
)
def _(spark, sf):
    """Times beyond any calendar, in milliseconds, negative or no number never stop a stream."""
    base = _folder(spark, "wild")
    wild = ", ".join(f"WHEN {k} THEN '{t}'" for k, t in enumerate(("9000000000000000", "1704067200000", "99999999999999999", "-5", "1e400")))
    at = L.VENDOR_37.index("time_unix")
    parts = [f"CASE line_num % 13 {wild.replace(', ', ' ')} ELSE CAST(time_unix AS STRING) END" if i == at else fx._wire_field(n) for i, n in enumerate(L.VENDOR_37)]
    fx.log(spark, sf).selectExpr(f"concat_ws('{fx.SEP}', {', '.join(parts)}) AS value").write.text(f"{base}/in")
    _run(spark, f"{base}/in", runner.band_handler(f"{base}/out"), f"{base}/c")
    good = runner.band_view(spark, f"{base}/out", L.INDEX_BAND_5M, L.FUSION_KEYS).agg(F.lit("good").alias("part"), F.sum("req_count").alias("n"))
    bad = writers.read_routed(spark, f"{base}/out/quarantine", ["layout"]).groupBy(F.col("reason").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(bad)


@query("rank_hours_job", fx.with_log("SELECT id, time_unix, domain, request, traffic, req_count, req_error FROM u", u=URLS))
def _(spark, sf):
    """Every line lies in the folder of the hour after its own: all are ranked under their own."""
    base = _folder(spark, "hours")
    placed = fx.log(spark, sf).selectExpr(
        f"{fx.wire_sql(L.VENDOR_34)} AS value", "'20240101' AS storage_day", "'20240101' || lpad(CAST(9 + line_num % 4 AS STRING), 2, '0') AS log_hour",
    )
    placed.write.partitionBy("storage_day", "log_hour").text(f"{base}/logs")
    first = 1704067200 + 3600
    jobs.rank_hours(spark, f"{base}/logs", f"{base}/out", f"{base}/progress", until=first + 24 * 3600, first=first, n=1_000_000)
    return writers.read_routed(spark, f"{base}/out").select("id", "time_unix", "domain", "request", "traffic", "req_count", "req_error")


@query("export_job", fx.with_log(f"SELECT value, count(*) AS n FROM (SELECT {_LINE_SQL} AS value FROM log) GROUP BY 1"))
def _(spark, sf):
    """A range exported in two parts, each twice, gives every line once."""
    base = _folder(spark, "export")
    start = 1704067200
    for a, b in ((start, start + 7200), (start + 7200, start + 4 * 3600)) * 2:
        jobs.export_user_logs(fx.log(spark, sf), a, b, f"{base}/out")
    return spark.read.text(f"{base}/out").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
