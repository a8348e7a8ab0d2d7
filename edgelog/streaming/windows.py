"""Event-time windows of streams: chained widths, and a place for what comes too late."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgelog import layouts as L
from edgelog.functions.times import DEFAULT_TZ
from edgelog.operators import band, clean, parse, route
from edgelog.sinks.writers import found, read_routed, routed_upsert, stream_id

Handler = Callable[[DataFrame, int], None]


def chained_band(df: DataFrame, keys: list[str], delay: str, widths: tuple[str, ...] = ("60 seconds", "300 seconds")) -> DataFrame:
    """Windows of the last width, made from those of the widths before, in one query.

    Each width is a stateful operator of its own and takes the closed windows of the one
    before, by their ``window_time``; only the first meets the records. A width must be a
    multiple of the one before. A window comes out once (append mode) when the newest record is ``delay``
    past its end; later records are dropped, :func:`late_band_handler` keeps them.
    """
    rows = df.select(
        *[F.coalesce(F.col(k).cast("string"), F.lit("0")).alias(k) for k in keys],
        F.timestamp_seconds(F.col("time_unix")).alias("_at"), F.lit(1).cast("bigint").alias("req_count"),
        F.col("body_bytes_sent").try_cast("double").alias("traffic"),
    ).withWatermark("_at", delay)
    time = F.col("_at")
    for width in widths:
        sums = [F.sum(m).alias(m) for m in ("req_count", "traffic")]
        rows = rows.groupBy(F.window(time, width), *keys).agg(*sums)
        time = F.window_time("window")
    return rows.select(*keys, F.unix_seconds("window.start").alias("from_time"), "req_count", "traffic")


_MARK = "newest bigint"


def _marks(spark: SparkSession, base: str) -> str:
    return f"{base}/watermark/{stream_id(spark)}"


def _newest(spark: SparkSession, base: str, batch: int) -> int | None:
    """The newest event time of all batches before ``batch``, as the last of them stored it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_marks(spark, base))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    done = [int(f.getPath().getName()) for f in files.listStatus(folder) if found(spark, f"{f.getPath()}/_SUCCESS")]
    last = max((n for n in done if n < batch), default=None)
    return None if last is None else spark.read.schema(_MARK).parquet(f"{_marks(spark, base)}/{last}").first()[0]


def late_band_handler(base: str, delay: int, kind: str = "fusion", width: int = 60, value: str = "value", tz: str = DEFAULT_TZ) -> Handler:
    """Windows that close, and a side output of what comes after their close.

    A window is closed for a batch when the newest record of the batches before is at least
    ``delay`` seconds past its end. Records of open windows become partial rows of the band
    table; those of closed ones go, as partial rows too, to its error index, whole in count
    and bytes. So the closed windows never change, and windows, late rows and quarantine
    together are the input.

    The newest time is stored per batch and carried on, so a batch that runs again finds what
    it found before, and numbers of empty batches may be missing.
    """
    layout, keys, index_type = {
        "fusion": ("fusion_band37", L.FUSION_KEYS, L.TYPE_BAND_FUSION), "jx": ("jx_band45", L.JX_KEYS, L.TYPE_BAND_JX),
    }[kind]
    prefix = {60: L.INDEX_BAND_1M, 300: L.INDEX_BAND_5M}[width]

    def run(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        flagged = clean.clean_band_flagged(parse.parse_flagged(df, layout, value=value))
        raw = F.when(F.col("_reason").isNotNull(), F.col("_raw")).alias("_raw")
        held = flagged.select(*keys, "time_unix", "body_bytes_sent", raw, "_reason").persist()
        try:
            good, bad = parse.part_flagged(held, layout)
            before = _newest(spark, base, batch)
            sums = band.band(good, keys, width)
            closed = F.lit(False) if before is None else F.col("from_time") + width + delay <= F.lit(before)
            day = route.route_band(sums, prefix, index_type, F.col("from_time"), tz)
            routed = day.withColumn("index_name", F.when(closed, F.lit(f"{prefix}error")).otherwise(F.col("index_name")))
            tagged = route.with_doc_id(routed, F.lit(f"0-{batch}"))
            routed_upsert(tagged, f"{base}/band", batch, part=["index_name", "index_type"])
            routed_upsert(bad, f"{base}/quarantine", batch, part=["layout"])
            newest = good.agg(F.greatest(F.max(F.col("time_unix").cast("bigint")), F.lit(before).cast("bigint")).alias("newest"))
            newest.coalesce(1).write.mode("overwrite").parquet(f"{_marks(spark, base)}/{batch}")
        finally:
            held.unpersist()

    return run


def window_rows(spark: SparkSession, base: str, keys: list[str], width: int = 60) -> DataFrame:
    """Windows of :func:`late_band_handler`: summed on-time rows, and whether each is closed by now."""
    prefix = {60: L.INDEX_BAND_1M, 300: L.INDEX_BAND_5M}[width]
    rows = read_routed(spark, f"{base}/band", ["index_name", "index_type"]).where(
        F.col("index_name").startswith(prefix) & (F.col("index_name") != f"{prefix}error")
    )
    return band.band_totals(rows, keys)


def late_rows(spark: SparkSession, base: str, keys: list[str], width: int = 60) -> DataFrame:
    """What came after the close of its window, summed per window."""
    prefix = {60: L.INDEX_BAND_1M, 300: L.INDEX_BAND_5M}[width]
    rows = read_routed(spark, f"{base}/band", ["index_name", "index_type"]).where(F.col("index_name") == f"{prefix}error")
    return band.band_totals(rows, keys)
