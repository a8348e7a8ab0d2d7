"""Bandwidth rollups.

Grouping is by columns, so the engine pre-aggregates on the map side and a hot key costs
one row per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgelog import layouts as L
from edgelog.functions.scalars import lenient, text_or_zero
from edgelog.functions.times import floor_to

# What the ids of each rollup start with.
ID_PREFIX = {60: "m1", 300: "m5"}
HOST_PREFIX = "hst_sts"


# Room for any offset below the partition in one ordered number.
_OFFSETS = "10000000000000000000"


def _numeric_tag(tag: str) -> Column:
    """A ``p-offset`` tag as one number, which a hash aggregate can take the least of.

    A tag that cannot be read is null and so never the least.
    """
    parts = F.split(tag, "-")
    number = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("decimal(19,0)")
    big = F.lit(_OFFSETS).cast("decimal(20,0)")
    return (number(1).try_cast("decimal(10,0)") * big + number(2)).try_cast("decimal(38,0)")


def _tag_text(number: Column) -> Column:
    text = F.lpad(number.cast("string"), 38, "0")
    plain = lambda start, n: F.substring(text, start, n).cast("decimal(19,0)").cast("string")
    return F.concat_ws("-", plain(1, 19), plain(20, 19))


def _measures(tag: str | None, count: Column, size: Column) -> list[Column]:
    out = [count.alias("req_count"), size.alias("traffic")]
    if tag:
        out.append(F.min(_numeric_tag(tag)).alias("_tag"))
    return out


def _finish(df: DataFrame, keys: list[str], prefix: str, tag: str | None) -> DataFrame:
    row_key = F.concat_ws("|", F.lit(prefix), *keys, F.col("from_time").cast("string"))
    tail = [_tag_text(F.col("_tag")).alias(tag)] if tag else []
    return df.select(
        *keys, "from_time", (F.col("from_time") * 1000).alias("log_date"), "req_count",
        "traffic", F.col("traffic").alias("traffic_pm"), row_key.alias("id"), *tail,
    )


def band(df: DataFrame, keys: list[str], seconds: int = 60, tag: str | None = None) -> DataFrame:
    """Requests and bytes per key and bucket. ``tag`` names a column of ``p-offset``
    batch tags, of which the lowest is kept."""
    rows = df.select(
        *[text_or_zero(k).alias(k) for k in keys],
        floor_to("time_unix", seconds).alias("from_time"),
        lenient("body_bytes_sent").alias("_size"),
        *([tag] if tag else []),
    )
    grouped = rows.groupBy(*keys, "from_time").agg(*_measures(tag, F.count(F.lit(1)), F.sum("_size")))
    return _finish(grouped, keys, ID_PREFIX.get(seconds, f"s{seconds}"), tag)


def reband(band_df: DataFrame, keys: list[str], seconds: int = 300, tag: str | None = None) -> DataFrame:
    """Coarser buckets from finer ones."""
    rows = band_df.withColumn("from_time", floor_to("from_time", seconds))
    grouped = rows.groupBy(*keys, "from_time").agg(*_measures(tag, F.sum("req_count"), F.sum("traffic")))
    return _finish(grouped, keys, ID_PREFIX.get(seconds, f"s{seconds}"), tag)


def band_totals(partials: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key and bucket from the partial rows that micro-batches wrote."""
    return partials.groupBy(*keys, "from_time").agg(
        F.sum("req_count").alias("req_count"), F.sum("traffic").alias("traffic")
    )


def host_status(df: DataFrame, keys: list[str] = L.HOST_KEYS) -> DataFrame:
    """Requests per host, status, domain and minute; bytes are not counted here."""
    rows = df.select(
        *[text_or_zero(k).alias(k) for k in keys], floor_to("time_unix", 60).alias("_minute")
    )
    grouped = rows.groupBy(*keys, "_minute").agg(F.count(F.lit(1)).alias("req_count"))
    row_key = F.concat_ws("|", F.lit(HOST_PREFIX), *keys, F.col("_minute").cast("string"))
    return grouped.select(
        *keys, (F.col("_minute") * 1000).alias("log_date"), "req_count",
        F.lit(0.0).alias("traffic"), F.lit(0.0).alias("traffic_pm"), row_key.alias("id"),
    )


def domain_rollup(df: DataFrame, time_col: str = "time_local") -> DataFrame:
    """Bytes per event time and domain, without rounding the time."""
    return df.groupBy(time_col, "domain").agg(
        F.sum(F.col("body_bytes_sent").try_cast("bigint")).alias("body_bytes_sent")
    )


def firm_day_count(df: DataFrame, day: Column) -> DataFrame:
    return df.groupBy(day.alias("day"), F.lower("firm_name").alias("firm_name")).agg(
        F.count("firm_name").alias("req_count")
    )


def word_count(df: DataFrame, value: str = "value", sep: str = " ") -> DataFrame:
    words = df.select(F.explode(F.split(value, sep)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))
