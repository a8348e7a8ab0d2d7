"""Command line: ``python -m edgelog.plans.main <job> ...``.

Every end point, table path and time zone is an argument.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from edgelog import layouts as L
from edgelog.functions.times import DEFAULT_TZ
from edgelog.plans import jobs
from edgelog.session import build_session
from edgelog.sinks import snapshots, writers
from edgelog.sources import readers
from edgelog.streaming import drain, hour_rank, ledger, runner, windows


def _stream_source(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.brokers:
        options = readers.kafka_options(a.brokers, a.topics, a.start, a.max_per_trigger, not a.allow_data_loss)
        return readers.source(spark, "kafka", **options)
    options = {"maxFilesPerTrigger": a.max_per_trigger} if a.max_per_trigger else {}
    return readers.source(spark, a.format, L.RAW_LINE_SCHEMA, a.path, **options)


def _sql_sink(out: str):
    def sink(df: DataFrame, batch: int) -> None:
        if "index_name" in df.columns:
            writers.routed_upsert(df, out, batch)
        else:
            writers.routed_upsert(df.selectExpr("*", "'result' AS index_name"), out, batch)

    return sink


def _handler(a: argparse.Namespace) -> runner.Handler:
    if a.job == "band-stream":
        return runner.band_handler(a.out, a.kind, tz=a.tz)
    if a.job == "detail-stream":
        return runner.detail_handler(a.out, a.kind, tz=a.tz, keep_domain=a.keep_domain, index=a.index)
    if a.job == "firm-day-stream":
        return runner.firm_day_handler(a.out, tz=a.tz, keep=a.keep, keep_domain=a.keep_domain)
    if a.job == "event-stream":
        return runner.event_handler(a.out, tz=a.tz)
    if a.job == "raw-stream":
        return runner.raw_handler(a.out)
    if a.job == "rank-stream":
        return runner.rank_handler(a.out, a.top, tz=a.tz)
    if a.job == "late-band-stream":
        return windows.late_band_handler(a.out, a.delay, a.kind, tz=a.tz)
    if a.job == "archive-stream":
        return runner.archive_handler(a.out, salts=a.salts, hot_days=a.hot_days, tz=a.tz)
    return runner.sql_handler(a.view, a.sql, _sql_sink(a.out), f"{a.out}-quarantine")


def _stream(spark: SparkSession, a: argparse.Namespace) -> None:
    """Run a stream until its input ends, an error, a request to stop or a pause of ``--idle``."""
    source = _stream_source(spark, a)
    reports = ledger.ProgressLedger(spark, a.out) if a.ledger else None
    if reports:
        spark.streams.addListener(reports)
    try:
        if a.job == "hour-rank-stream":
            started = hour_rank.run_hour_rank(source, a.out, a.checkpoint, a.top, delay=a.expire, tz=a.tz, interval=a.interval, writer=a.writer)
            drain.supervise_all(spark, dict(zip(hour_rank.checkpoints(a.checkpoint), started)), a.checkpoint, idle=a.idle)
        else:
            handler = _handler(a)
            handler = ledger.recorded(handler, a.out, a.job) if a.ledger else handler
            query = runner.run_stream(source, handler, a.checkpoint, a.interval, a.job, a.writer)
            drain.supervise(spark, query, a.checkpoint, idle=a.idle)
    finally:
        if reports:
            spark.streams.removeListener(reports)


def _archive(spark: SparkSession, path: str) -> DataFrame:
    return writers.read_routed(spark, path, ["table_suffix"])


STREAMS = (
    "band-stream", "detail-stream", "rank-stream", "archive-stream", "sql-stream", "firm-day-stream", "event-stream", "raw-stream",
    "late-band-stream", "hour-rank-stream",
)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="edgelog")
    top.add_argument("--tz", default=DEFAULT_TZ)
    jobs_ = top.add_subparsers(dest="job", required=True)

    for name in STREAMS:
        p = jobs_.add_parser(name)
        p.add_argument("--brokers")
        p.add_argument("--topics")
        p.add_argument("--start", default="latest", choices=["earliest", "latest"])
        p.add_argument("--format", default="text")
        p.add_argument("--path")
        p.add_argument("--max-per-trigger", type=int)
        p.add_argument("--interval", help="for example '60 seconds'; without it, work off what is there")
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--writer", help="mark of what this stream writes; by default an id its checkpoint keeps")
        p.add_argument("--out", required=True)
        p.add_argument("--kind", default="fusion", choices=["fusion", "jx"])
        p.add_argument("--top", type=int, default=100)
        p.add_argument("--salts", type=int, default=10)
        p.add_argument("--hot-days", type=int, default=30)
        p.add_argument("--view", default="logs")
        p.add_argument("--sql")
        p.add_argument("--keep", action="store_true", help="apply the retention policy")
        p.add_argument("--index", help="what the names of detail indices start with")
        p.add_argument("--keep-domain", help="text of domains whose successes are kept on any layer")
        p.add_argument("--delay", type=int, default=3600, help="seconds after which a window of late-band-stream closes")
        p.add_argument("--expire", help="for example '2 days': when hour-rank-stream forgets an hour; never by default")
        p.add_argument("--ledger", action="store_true", help="keep the offsets of each batch and the engine's reports next to the tables")
        p.add_argument("--idle", type=float, help="end after so many seconds without input")
        p.add_argument("--allow-data-loss", action="store_true", help="go on where the broker no longer has saved offsets")

    p = jobs_.add_parser("rebuild-band")
    for name in ("archive", "out", "from_min", "to_min"):
        p.add_argument(name)
    p.add_argument("--firm")
    p.add_argument("--kind", default="fusion", choices=["fusion", "jx"])

    p = jobs_.add_parser("check-band")
    for name in ("archive", "band", "out", "from_min", "to_min"):
        p.add_argument(name)
    p.add_argument("--full", action="store_true")

    p = jobs_.add_parser("rank-hours")
    for name in ("logs", "out", "progress"):
        p.add_argument(name)
    p.add_argument("first", type=int)
    p.add_argument("until", type=int)
    p.add_argument("--top", type=int, default=2000)
    p.add_argument("--skip-missing", action="store_true", help="pass over hours without files")

    p = jobs_.add_parser("rank-sql")
    for name in ("path", "out"):
        p.add_argument(name)
    p.add_argument("--top", type=int, default=2)
    p.add_argument("--metric", default="traffic")

    p = jobs_.add_parser("compact-band")
    for name in ("base", "target"):
        p.add_argument(name)
    p.add_argument("--kind", default="fusion", choices=["fusion", "jx"])

    p = jobs_.add_parser("stop-stream", help="let the stream of a checkpoint finish its batch and end")
    p.add_argument("checkpoint")

    p = jobs_.add_parser("gaps", help="offset ranges no batch of the streams has read")
    for name in ("base", "out"):
        p.add_argument(name)

    p = jobs_.add_parser("refresh-snapshot", help="bring a snapshot of newest rows up to date, reading only new batches")
    for name in ("base", "target"):
        p.add_argument(name)
    p.add_argument("--part", default="index_name", help="folder columns, parted by commas")
    p.add_argument("--keys", default="id", help="columns of the key, parted by commas")

    p = jobs_.add_parser("snapshot", help="the newest row of each key, as a table of its own")
    for name in ("base", "target"):
        p.add_argument(name)
    p.add_argument("--part", default="index_name", help="folder columns, parted by commas")
    p.add_argument("--keys", default="id", help="columns of the key, parted by commas")

    p = jobs_.add_parser("rank-archive")
    for name in ("archive", "out", "from_min", "to_min"):
        p.add_argument(name)
    p.add_argument("--kind", default="fusion", choices=["fusion", "jx"])
    p.add_argument("--top", type=int, default=2000)

    p = jobs_.add_parser("export-logs")
    for name in ("detail", "out"):
        p.add_argument(name)
    p.add_argument("first", type=int)
    p.add_argument("until", type=int)
    p.add_argument("--indices", default="*", help="index names, parted by commas; * matches any text")

    p = jobs_.add_parser("backfill")
    for name in ("path", "out"):
        p.add_argument(name)
    p.add_argument("--layout", default="fusion_sql42", choices=["fusion_sql42", "package"])
    p.add_argument("--index", default="backfill-")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or build_session(f"edgelog-{a.job}")
    if a.job == "stop-stream":
        drain.request_stop(spark, a.checkpoint)
    elif a.job.endswith("-stream"):
        _stream(spark, a)
    elif a.job == "gaps":
        ledger.gaps(ledger.ledger(spark, a.base)).write.mode("overwrite").parquet(a.out)
    elif a.job == "refresh-snapshot":
        snapshots.refresh(spark, a.base, a.target, a.keys.split(","), a.part.split(","))
    elif a.job == "rebuild-band":
        archive = _archive(spark, a.archive)
        jobs.run_rebuild(spark, archive, a.out, a.from_min, a.to_min, a.firm, a.kind, tz=a.tz)
    elif a.job == "check-band":
        band = writers.read_band(spark, a.band, L.INDEX_BAND_5M)
        report = jobs.check_band(_archive(spark, a.archive), band, a.from_min, a.to_min, a.full, a.tz)
        report.write.mode("overwrite").parquet(a.out)
    elif a.job == "rank-hours":
        jobs.rank_hours(spark, a.logs, a.out, a.progress, a.until, a.first, a.top, a.tz, skip_missing=a.skip_missing)
    elif a.job == "rank-sql":
        jobs.rank_sql_files(spark, a.path, a.out, a.top, a.metric)
    elif a.job == "compact-band":
        writers.compact_band(spark, a.base, a.target, {"fusion": L.FUSION_KEYS, "jx": L.JX_KEYS}[a.kind])
    elif a.job == "snapshot":
        writers.snapshot(spark, a.base, a.target, a.keys.split(","), a.part.split(","))
    elif a.job == "rank-archive":
        top = jobs.rank_archive(
            _archive(spark, a.archive), a.from_min, a.to_min, a.kind, a.top, quarantine=f"{a.out}-quarantine"
        )
        top.write.mode("overwrite").parquet(a.out)
    elif a.job == "export-logs":
        detail = readers.index_wildcard(writers.read_routed(spark, a.detail), a.indices.split(","))
        jobs.export_user_logs(detail, a.first, a.until, a.out, a.tz)
    elif a.job == "backfill":
        jobs.backfill(spark, a.path, a.out, a.layout, index=a.index)


if __name__ == "__main__":
    main()
