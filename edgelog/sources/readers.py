"""Inputs: streams, dated folders, text, indices and JDBC."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelog import layouts as L


def source(spark: SparkSession, fmt: str, schema=None, path: str | None = None, **options) -> DataFrame:
    """A stream of any format. Tests replay files; production names a broker.

    Start position and rate limits are options of the format, for example
    ``startingOffsets`` and ``maxOffsetsPerTrigger``, or ``maxFilesPerTrigger``.
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load(path) if path else reader.load()


def kafka_options(
    brokers: str, topics, start: str = "latest", max_per_trigger: int | None = None, fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Options for :func:`source` with the ``kafka`` format.

    Offsets are kept in the stream's checkpoint; ``start`` only counts on first use. A
    saved offset the broker no longer has ends the stream; with ``fail_on_data_loss`` off
    it moves on, and the broker source logs the range that is lost.
    """
    out = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": start,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return out


def union_topics(topics: dict[str, DataFrame]) -> DataFrame:
    """Several inputs as one, each row naming the topic it came from."""
    named = [df.withColumn("topic", F.lit(name)) for name, df in topics.items()]
    return reduce(DataFrame.unionByName, named)


def lag_days(hour: str, days: int = 2) -> list[str]:
    """Storage days that can hold records of log hour ``yyyyMMddHH``."""
    first = datetime.strptime(hour[:8], "%Y%m%d")
    return [(first + timedelta(days=d)).strftime("%Y%m%d") for d in range(days + 1)]


def lagged(df: DataFrame, hour: str, days: int = 2) -> DataFrame:
    """Records of one log hour, stored on its day or up to ``days`` later."""
    return df.where(
        F.col("storage_day").cast("string").isin(*lag_days(hour, days))
        & (F.col("log_hour").cast("string") == hour)
    )


def log_dir_scan(spark: SparkSession, base: str, hour: str, days: int = 2, fmt: str = "text") -> DataFrame:
    """Read ``storage_day=/log_hour=`` folders of one log hour.

    Only the few folders that can hold records of the hour are looked at; a missing day
    gives no rows.
    """
    value = [T.StructField("value", T.StringType())]
    parts = [T.StructField(p, T.StringType()) for p in ("storage_day", "log_hour")]
    schema = T.StructType(value + parts) if fmt == "text" else None
    there = hour_folders(spark, base, hour, days)
    if not there:
        return spark.createDataFrame([], schema or T.StructType(parts))
    reader = spark.read.format(fmt).option("basePath", base)
    if schema:
        reader = reader.schema(schema)
    return lagged(reader.load(there), hour, days)


def hour_folders(spark: SparkSession, base: str, hour: str, days: int = 2) -> list[str]:
    """Folders of one log hour that exist, of the ``days + 1`` that may."""
    wanted = [f"{base}/storage_day={day}/log_hour={hour}" for day in lag_days(hour, days)]
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    return [w for w in wanted if path(w).getFileSystem(conf).exists(path(w))]


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def quoted_fields(df: DataFrame, value: str = "value") -> DataFrame:
    """Fields of quoted lines, as an array next to the line."""
    return df.select(value, F.split(value, f"\\Q{L.CELL_SEP}\\E").alias("fields"))


def index_range(df: DataFrame, start: int, end: int, time_col: str = "time_unix") -> DataFrame:
    """Records with ``start <= time < end``."""
    return df.where((F.col(time_col) >= start) & (F.col(time_col) < end))


def user_log_source(df: DataFrame, start: int, end: int) -> DataFrame:
    """Records of a time range, just the fields a log package needs."""
    return index_range(df, start, end).select(*L.USER_LOG_COLUMNS)


def index_wildcard(df: DataFrame, names) -> DataFrame:
    """Rows of the indices listed; a name may hold ``*``, every other character stands for itself."""
    listed = [names] if isinstance(names, str) else list(names)
    plain = lambda n: re.sub(r"([\\%_])", r"\\\1", n).replace("*", "%")
    tests = [F.col("index_name").like(plain(n)) for n in listed]
    return df.where(reduce(lambda a, b: a | b, tests))


def jdbc_rows(
    spark: SparkSession, url: str, table: str, column: str | None = None, lower=1, upper=10,
    partitions: int = 1, **properties,
) -> DataFrame:
    """A table or a bracketed query over JDBC, read in ranges of ``column``."""
    options = {"url": url, "dbtable": table, **properties}
    if column and partitions > 1:
        options |= {
            "partitionColumn": column, "lowerBound": lower, "upperBound": upper,
            "numPartitions": partitions,
        }
    return spark.read.format("jdbc").options(**{k: str(v) for k, v in options.items()}).load()


def text_records(df: DataFrame, value: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The lines of texts that were read whole, numbered from 1."""
    lines = F.posexplode(F.split(value, "\n")).alias("_pos", "value")
    return df.select(*(keep or []), lines).select(
        *(keep or []), (F.col("_pos") + 1).cast("bigint").alias("line_no"), "value"
    )
