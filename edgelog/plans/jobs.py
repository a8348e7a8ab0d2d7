"""Batch jobs."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelog import layouts as L
from edgelog.functions.times import DEFAULT_TZ, fmt_epoch, parse_epoch
from edgelog.operators import archive as arc
from edgelog.operators import band, check, clean, parse, rank, route
from edgelog.sinks import writers
from edgelog.sources.readers import hour_folders, log_dir_scan, user_log_source

_KEYS = {"fusion": L.FUSION_KEYS, "jx": L.JX_KEYS}
_TYPES = {"fusion": L.TYPE_BAND_FUSION, "jx": L.TYPE_BAND_JX}


def rebuild_band(
    archive: DataFrame, from_min: str, to_min: str, firm: str | None = None, kind: str = "fusion", as_of=None,
    tz: str = DEFAULT_TZ, seconds: tuple[int, ...] = (60, 300), suffixes: list[str] | None = None,
) -> dict[int, DataFrame]:
    """Rollups of an archived minute range, by bucket width.

    One scan over the whole range: slicing it would only shorten each scan. What cannot
    be read is given by :func:`rebuild_rejects`.
    """
    flagged = _archived_flagged(archive, from_min, to_min, firm, kind, suffixes)
    good, _ = parse.part_flagged(flagged, f"archive_{kind}")
    prefix = {60: L.INDEX_BAND_1M, 300: L.INDEX_BAND_5M}
    out = {}
    for width in seconds:
        frame = band.band(good, _KEYS[kind], width)
        routed = route.route_band(frame, prefix[width], _TYPES[kind], as_of, tz)
        out[width] = route.with_doc_id(routed, F.lit("0"))
    return out


def _archived_flagged(archive: DataFrame, from_min: str, to_min: str, firm: str | None, kind: str, suffixes: list[str] | None) -> DataFrame:
    return clean.clean_band_flagged(parse.parse_archive_flagged(arc.archive_scan(archive, from_min, to_min, firm, suffixes), kind))


def rebuild_rejects(
    archive: DataFrame, from_min: str, to_min: str, firm: str | None = None, kind: str = "fusion", suffixes: list[str] | None = None,
) -> DataFrame:
    """Archived rows of the range that a rebuild cannot count, with the reason."""
    return parse.part_flagged(_archived_flagged(archive, from_min, to_min, firm, kind, suffixes), f"archive_{kind}")[1]


def _minute_epoch(spark: SparkSession, minute: str, tz: str) -> int:
    return spark.range(1).select(parse_epoch(F.lit(minute), "yyyyMMddHHmm", tz)).first()[0]


def run_rebuild(
    spark: SparkSession, archive: DataFrame, base: str, from_min: str, to_min: str,
    firm: str | None = None, kind: str = "fusion", run: int | None = None, tz: str = DEFAULT_TZ, **options,
) -> int:
    """Rebuild a range into a band table and publish it.

    Its rows replace every partial row of the buckets they cover, once the coverage row
    is written; a run that dies earlier changes nothing. The range must hold whole
    five-minute buckets. Rejected rows go to the table's quarantine. Each kind of log has
    a ``base`` of its own. ``run`` orders rebuilds, the newest counts; by default the time in
    microseconds.
    """
    if any(int(m[-2:]) % 5 for m in (from_min, to_min)):
        raise ValueError("the range must start and end on a multiple of five minutes")
    run = run or time.time_ns() // 1000
    options = {"as_of": int(time.time()), **options}
    frames = rebuild_band(archive, from_min, to_min, firm, kind, tz=tz, **options)
    rows = frames[60].unionByName(frames[300])
    writer = writers.source_id("rebuild", kind, firm, from_min, to_min)
    writers.routed_upsert(rows, f"{base}/band", batch=0, run=run, part=["index_name", "index_type"], writer=writer)
    bad = rebuild_rejects(archive, from_min, to_min, firm, kind, options.get("suffixes"))
    writers.routed_upsert(bad, f"{base}/quarantine", batch=0, run=run, part=["layout"], writer=writer)
    start, end = (_minute_epoch(spark, m, tz) for m in (from_min, to_min))
    writers.add_coverage(spark, writers.coverage_path(base), start, end, run, firm)
    return run


def check_band(
    archive: DataFrame, band_rows: DataFrame, from_min: str, to_min: str, full: bool = False,
    tz: str = DEFAULT_TZ, suffixes: list[str] | None = None,
) -> DataFrame:
    """Reconcile a minute range in one plan. Both sides are cut to the range first."""
    spark = archive.sparkSession
    start, end = (_minute_epoch(spark, m, tz) for m in (from_min, to_min))
    lines = arc.archive_scan(archive, from_min, to_min, suffixes=suffixes)
    sums = band_rows.where((F.col("from_time") >= start) & (F.col("from_time") < end))
    return check.band_check(lines, sums, full, tz)


PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("begin", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


def read_progress(spark: SparkSession, path: str, job: str, default: int) -> int:
    """End of the last range the job finished."""
    try:
        table = spark.read.schema(PROGRESS_SCHEMA).parquet(path)
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(error):
            return default
        raise
    row = table.where(F.col("job") == job).agg(F.max("end")).first()
    return default if row[0] is None else row[0]


def write_progress(spark: SparkSession, path: str, job: str, begin: int, end: int) -> None:
    row = spark.createDataFrame([(job, begin, end)], PROGRESS_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)


def rank_hours(
    spark: SparkSession, logs: str, out: str, progress: str, until: int, first: int, n: int = 2000,
    tz: str = DEFAULT_TZ, job: str = "urlrank", lag_days: int = 2, fmt: str = "text", skip_missing: bool = False,
) -> int:
    """Rank hour after hour up to ``until``, going on where the last run ended.

    Every line of an hour's folders is ranked, under the hour of its own time. Lines that
    cannot be read go to ``<out>-quarantine``. An hour without folders ends the run where it
    is, to be tried again, unless ``skip_missing`` says that none will come.
    """
    begin = read_progress(spark, progress, job, first)
    done = 0
    while begin + 3600 <= until:
        hour = spark.range(1).select(fmt_epoch(F.lit(begin), "yyyyMMddHH", tz)).first()[0]
        if hour_folders(spark, logs, hour, lag_days):
            rows, bad = parse.rank_input(log_dir_scan(spark, logs, hour, lag_days, fmt))
            top = route.route_rank(rank.top_union(rank.url_hour(rows), n), tz)
            writer = writers.source_id(job, logs)
            writers.routed_upsert(top, out, batch=begin, writer=writer)
            writers.routed_upsert(bad, f"{out}-quarantine", batch=begin, part=["layout"], writer=writer)
        elif not skip_missing:
            return done
        write_progress(spark, progress, job, begin, begin + 3600)
        begin += 3600
        done += 1
    return done


def rank_archive(
    archive: DataFrame, from_min: str, to_min: str, kind: str = "fusion", n: int = 2000, prune: bool = False,
    suffixes: list[str] | None = None, quarantine: str | None = None, **options,
) -> DataFrame:
    """Top lists over an archived minute range; rejected rows go to the table ``quarantine``."""
    rows, bad = parse.part_flagged(
        parse.parse_archive_flagged(arc.archive_scan(archive, from_min, to_min, suffixes=suffixes), kind), kind
    )
    if quarantine:
        writers.routed_upsert(bad, quarantine, 0, part=["layout"], writer=writers.source_id("rank", kind, from_min, to_min))
    urls = rank.url_hour(rows)
    return rank.top_union(rank.prune_rank(urls, n) if prune else urls, n, **options)


def rank_sql_files(spark: SparkSession, path: str, out: str, n: int = 2, metric: str = "traffic") -> None:
    """Rank SQL over files of pre-aggregated lines; what cannot be read goes to ``<out>-quarantine``."""
    rows, bad = parse.parse_lines(spark.read.text(path), "preagg7", sep=" ", on_short="quarantine")
    writer = writers.source_id("rank-sql", path.rstrip("/"))
    ranked = rank.rank_sql(spark, rank.preagg_sum(rows), n, metric).withColumn("index_name", F.lit("rank"))
    writers.routed_upsert(ranked, out, 0, writer=writer)
    writers.routed_upsert(bad, f"{out}-quarantine", 0, part=["layout"], writer=writer)


def export_user_logs(df: DataFrame, start: int, end: int, out: str, tz: str = DEFAULT_TZ) -> None:
    """Log packages of a time range in one write.

    A package is a whole slice, so the range must start and end on five minutes: part of
    a slice would replace the whole of it.
    """
    if start % 300 or end % 300:
        raise ValueError("the range must start and end on a multiple of five minutes")
    writers.export_text(user_log_source(df, start, end), out, order=["time_unix"], tz=tz)


def backfill(
    spark: SparkSession, path: str, base: str, layout: str = "fusion_sql42", batch: int = 0, index: str = "backfill-",
) -> None:
    """Text files to an index: vendor lines by firm and file day, quoted lines whole.

    The path names the writer: the same path again replaces its rows, another adds to them.
    """
    writer = writers.source_id("backfill", path.rstrip("/"))
    lines = spark.read.text(path)
    if layout == "fusion_sql42":
        flagged = parse.parse_sql42_flagged(lines).persist()
        try:
            good, bad = parse.part_flagged(flagged, layout)
            name = F.concat(F.lit(index), "lowfirmname", F.lit("-"), "filetime")
            writers.routed_upsert(good.withColumn("index_name", name), f"{base}/detail", batch, writer=writer)
            writers.routed_upsert(bad, f"{base}/quarantine", batch, part=["layout"], writer=writer)
        finally:
            flagged.unpersist()
    elif layout == "package":
        writers.routed_upsert(parse.package_lines(lines, index_name=index), f"{base}/package", batch, writer=writer)
    else:
        raise ValueError(f"unknown layout {layout!r}")
