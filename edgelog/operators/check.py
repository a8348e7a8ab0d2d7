"""Reconciliation of the archive with the rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgelog.functions.times import DEFAULT_TZ, floor_to, parse_epoch
from edgelog.operators.parse import parse_row_key

_KEY = ["file_md5", "from_time"]


def archive_file_counts(archive: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Archived lines per file and five minutes.

    Reads the short columns ``file_md5`` and ``log_minute`` where the archive has them,
    else takes the row keys apart. The bucket is cut as text and turned into a time once
    per group; zones differ by whole quarter hours, so the buckets are the same.
    """
    count = F.count(F.lit(1)).alias("archive_req_count")
    if not {"file_md5", "log_minute"} <= set(archive.columns):
        return parse_row_key(archive, tz=tz).groupBy(*_KEY).agg(count)
    minute = F.substring("log_minute", 11, 2).try_cast("int")
    five = F.lpad((minute - minute % 5).cast("string"), 2, "0")
    rows = archive.select("file_md5", F.concat(F.substring("log_minute", 1, 10), five).alias("_five"))
    counts = rows.groupBy("file_md5", "_five").agg(count)
    return counts.select(
        "file_md5", parse_epoch("_five", "yyyyMMddHHmm", tz).alias("from_time"), "archive_req_count"
    )


def band_file_counts(band: DataFrame) -> DataFrame:
    """Requests the rollups hold per file and five minutes, over all other keys."""
    per_file = band.select(
        "file_name", floor_to("from_time", 300).alias("from_time"), "req_count"
    )
    counts = per_file.groupBy("file_name", "from_time").agg(F.sum("req_count").alias("band_req_count"))
    return counts.withColumn("file_md5", F.md5("file_name"))


def band_check(archive: DataFrame, band: DataFrame, full: bool = False, tz: str = DEFAULT_TZ) -> DataFrame:
    """Per file and five minutes: both counts, and ``Y`` where they agree.

    Both sides are grouped first, so the join has one row per file and bucket on each
    side and no hot key. ``full`` also reports files only the rollups know.
    """
    joined = archive_file_counts(archive, tz).join(
        band_file_counts(band), _KEY, "full" if full else "left"
    )
    agree = F.col("archive_req_count").eqNullSafe(F.col("band_req_count"))
    return joined.select(
        F.coalesce("file_name", "file_md5").alias("file_name"),
        "from_time",
        (F.col("from_time") * 1000).alias("log_date"),
        "archive_req_count",
        "band_req_count",
        F.when(agree, "Y").otherwise("N").alias("is_normal"),
    )
