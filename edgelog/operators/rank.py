"""URL ranks: hourly rollup per URL and top lists per domain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgelog import layouts as L
from edgelog.functions.scalars import lenient
from edgelog.functions.times import DEFAULT_TZ, floor_to, iso_time

TOP_METRICS = ["req_count", "traffic", "downloadnum", "req_error"]
_URL = ["domain", "request", "time_unix"]
# Up to this many rows per key, one ranking step leaves at most n rows per map task and
# key for the last task; above it the rows of a key meet in two steps.
_ONE_STEP_ROWS = 200
_SALTS = 32


def _or_dash(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("-"))


def _url_id() -> Column:
    return F.md5(F.concat("domain", "request", F.col("time_unix").cast("string")))


def _url_columns(df: DataFrame) -> DataFrame:
    return df.select(
        floor_to("time_unix", 3600).alias("time_unix"),
        _or_dash("domain").alias("domain"),
        _or_dash("request").alias("request"),
        lenient("body_bytes_sent").alias("traffic"),
        F.col("http_status").cast("string").alias("_status"),
    )


def rank_keyed(df: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Each record as a URL-hour record of one request."""
    rows = _url_columns(df)
    one = lambda cond: F.coalesce(cond.cast("double"), F.lit(0.0))
    status = F.col("_status")
    return rows.select(
        _url_id().alias("id"),
        iso_time("time_unix", tz).alias("time_local"),
        *["time_unix", "domain", "request", "traffic"],
        F.lit(1.0).alias("req_count"),
        F.lit(0.0).alias("downloadnum"),
        one(status.isin(*L.ERROR_STATUSES)).alias("req_error"),
        *[one(status == s).alias(f"req{s}") for s in L.ERROR_STATUSES],
    )


def url_hour(df: DataFrame) -> DataFrame:
    """Requests, bytes and error counts per URL and hour.

    The id is hashed after grouping, once per group.
    """
    status = F.col("_status")
    grouped = _url_columns(df).groupBy(*_URL).agg(
        F.sum("traffic").alias("traffic"),
        F.count(F.lit(1)).cast("double").alias("req_count"),
        *[F.count_if(status == s).cast("double").alias(f"req{s}") for s in L.ERROR_STATUSES],
    )
    return _ranked_shape(grouped.withColumn("downloadnum", F.lit(0.0)))


def url_hour_totals(df: DataFrame, delay: str | None = None) -> DataFrame:
    """:func:`url_hour` of a stream, whose state holds the counters of every URL and hour.

    In update mode a batch gives the new totals of the URLs it touched. Counters only grow:
    a size that cannot be read or is negative adds no bytes. Without ``delay`` the state
    keeps all hours; with it an hour that began ``delay`` before the newest one is closed, and
    its later records are dropped.
    """
    status = F.col("_status")
    timed = _url_columns(df).withColumn("_hour", F.timestamp_seconds("time_unix"))
    if delay:
        timed = timed.withWatermark("_hour", delay)
    grouped = timed.groupBy("domain", "request", "_hour").agg(
        F.sum(F.greatest("traffic", F.lit(0.0))).alias("traffic"),
        F.count(F.lit(1)).cast("double").alias("req_count"),
        *[F.count_if(status == s).cast("double").alias(f"req{s}") for s in L.ERROR_STATUSES],
    )
    return _ranked_shape(grouped.withColumns({"time_unix": F.unix_seconds("_hour"), "downloadnum": F.lit(0.0)}))


def _ranked_shape(df: DataFrame) -> DataFrame:
    errors = reduce(lambda a, b: a + b, [F.col(f"req{s}") for s in L.ERROR_STATUSES])
    return df.withColumns({"req_error": errors, "id": _url_id()}).select(
        "id", "time_unix", "domain", "request", *L.RANK_MEASURES
    )


def merge_url_hour(df: DataFrame) -> DataFrame:
    """Sum URL-hour records that stem from several batches."""
    sums = [F.sum(m).alias(m) for m in L.RANK_MEASURES if m != "req_error"]
    return _ranked_shape(df.groupBy(*_URL).agg(*sums))


def url_sum_salted(df: DataFrame, keys: list[str], measures: list[str], salts: int = 10) -> DataFrame:
    """Sum per key in two steps over a salt held in a column of its own.

    Plain sums pre-aggregate on the map side anyway; use this where a key has so many
    map tasks that even their partial rows weigh on one reducer.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt")
    sums = [F.sum(m).alias(m) for m in measures]
    first = df.select(*keys, *measures, salt).groupBy(*keys, "_salt").agg(*sums)
    return first.groupBy(*keys).agg(*sums)


def preagg_sum(df: DataFrame) -> DataFrame:
    """Sums per URL over ``preagg7`` records, a status count going to its own counter."""
    number = {m: lenient(m) for m in ("traffic", "req_count", "downloadnum", "status_count")}
    counters = [
        F.sum(F.when(F.col("status") == s, F.col("status_count")).otherwise(0.0)).alias(f"req{s}")
        for s in L.ERROR_STATUSES
    ]
    sums = [F.sum(m).alias(m) for m in ("traffic", "req_count", "downloadnum")]
    grouped = df.withColumns(number).groupBy("domain", "request").agg(*sums, *counters)
    errors = reduce(lambda a, b: a + b, [F.col(f"req{s}") for s in L.ERROR_STATUSES])
    return grouped.withColumn("req_error", errors).select("domain", "request", *L.RANK_MEASURES)


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int, salts: int | None = None) -> DataFrame:
    """The first ``n`` rows of each key; ``order`` must leave no ties.

    Every map task cuts its keys to ``n`` rows before the shuffle. For a large ``n`` the
    survivors of a hot key first meet in ``salts`` groups by map task, each cut to ``n``
    again, so that the last task sees at most ``n * salts`` rows of a key.
    """
    steps = salts if salts is not None else (1 if n <= _ONE_STEP_ROWS else _SALTS)
    if steps > 1:
        salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(steps)))
        df = _cut(salted, [*by, "_salt"], order, n).drop("_salt")
    return _cut(df, by, order, n)


def _cut(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def metric_order(metric: str, legacy_order: bool = False) -> list[Column]:
    """Highest metric first, then highest id. ``legacy_order`` compares as text."""
    if legacy_order:
        return [F.concat(F.col(metric).cast("string"), F.col("id")).desc()]
    return [F.col(metric).desc(), F.col("id").desc()]


def top_by(
    df: DataFrame, metric: str, n: int, legacy_order: bool = False, salts: int | None = None, by: list[str] | None = None,
) -> DataFrame:
    return top_n(df, by or ["domain"], metric_order(metric, legacy_order), n, salts)


def top_union(
    df: DataFrame, n: int, metrics: list[str] = TOP_METRICS, legacy_order: bool = False, salts: int | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Rows in the top ``n`` of any metric, once each; ``by`` names the key, the domain by default.

    One plan per metric keeps the early cut in each; they read one shared rollup shuffle.
    """
    tops = [top_by(df, m, n, legacy_order, salts, by) for m in metrics]
    return reduce(DataFrame.unionByName, tops).dropDuplicates(["id", *_URL])


def rank_sql(spark: SparkSession, df: DataFrame, n: int = 2, metric: str = "traffic") -> DataFrame:
    """The rank as SQL text over a rollup of URLs."""
    measures = ", ".join(L.RANK_MEASURES)
    return spark.sql(
        f"""
        SELECT * FROM (
          SELECT domain, request, {measures},
                 row_number() OVER (PARTITION BY domain ORDER BY {metric} DESC, request DESC) AS rowid
          FROM {{rankdata}}) ranked
        WHERE rowid <= {int(n)}
        """,
        rankdata=df,
    )


def prune_rank(df: DataFrame, n: int) -> DataFrame:
    """Drop single, error-free requests of a domain beyond its first ``n + 1`` ids.

    Rows that count pass straight through; only the first ids of a domain are ranked.
    """
    counts = (F.col("req_count") > 1) | (F.col("req_error") > 0)
    first = top_n(df, ["domain"], [F.col("id").asc(), F.col("request").asc()], n + 1)
    return df.where(counts).unionByName(first.where(~counts))
