"""Outputs: routed tables, text packages and pass-through sinks.

A routed table is partitioned by where a row belongs and by what wrote it: the writer (a
stream's id, kept in its checkpoint, or the name of a job's input), its run and its
batch. A batch only ever replaces its own partitions, so a repeated batch leaves the
table as it was, and nothing that another writer stored is read, rewritten or removed. Readers take the newest row
of an id (:func:`latest`) or sum partial rows.
"""

from __future__ import annotations

from contextvars import ContextVar
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelog.functions.times import DEFAULT_TZ, fmt_epoch
from edgelog.operators.userlog import user_log_lines


def _spread(df: DataFrame, parts: list[str]) -> DataFrame:
    """Gather rows by target folder; large folders are split and small ones merged at
    run time, so that neither a hot folder nor thousands of tiny files result."""
    return df.hint("rebalance", *[F.col(p) for p in parts])


def _replace_own(df: DataFrame, parts: list[str]):
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)


def routed_upsert(
    df: DataFrame, base: str, batch: int, part: list[str] | None = None, exclude: list[str] | None = None,
    sort: list[str] | None = None, run: int = 0, writer: str | None = None,
) -> None:
    """Write the rows of one batch to the folders their ``part`` columns name.

    ``sort`` orders rows inside a file, which lets later range scans skip row groups.
    ``run`` is 0 for streams and the number of the run for a rebuild. ``writer`` must differ
    between any two sources whose batches have nothing to do with each other; inside a
    stream it is the stream's own id unless named.
    """
    parts = part or ["index_name"]
    rows = _spread(df.drop(*(exclude or [])), parts)
    marked = rows.withColumns(
        {"writer": F.lit(writer or stream_id(df.sparkSession)), "run": F.lit(run).cast("bigint"), "batch": F.lit(batch).cast("bigint")}
    )
    folders = [*parts, "writer", "run", "batch"]
    if sort:
        marked = marked.sortWithinPartitions(*folders, *sort)
    _replace_own(marked, folders).parquet(base)


#: Writer of the batch that is being handled, set by the stream runner.
CURRENT_WRITER: ContextVar[str | None] = ContextVar("current_writer", default=None)


def stream_id(spark: SparkSession) -> str:
    """Writer of the stream whose batch is being handled: its name, else the id its checkpoint keeps."""
    return CURRENT_WRITER.get() or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def source_id(*parts: str | None) -> str:
    """Writer name of a job that reads what ``parts`` name."""
    return md5("\n".join(p or "" for p in parts).encode(), usedforsecurity=False).hexdigest()


def found(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_routed(spark: SparkSession, base: str, part: list[str] | None = None) -> DataFrame:
    """Every row of every batch, folder names read as text."""
    parts = part or ["index_name"]
    plain = spark.read.option("recursiveFileLookup", "true").parquet(base).schema
    folders = [T.StructField(p, T.StringType()) for p in (*parts, "writer")] + [T.StructField(p, T.LongType()) for p in ("run", "batch")]
    return spark.read.schema(T.StructType([*plain.fields, *folders])).parquet(base)


def latest(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The newest row of each key. Each task first cuts its keys to one row."""
    ids = keys or ["id"]
    rest = [c for c in df.columns if c not in ("writer", "run", "batch")]
    order = [F.col("run").desc(), F.col("batch").desc(), F.xxhash64(*rest).desc()]
    rank = F.row_number().over(Window.partitionBy(*ids).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") == 1).drop("_rn")


def snapshot(spark: SparkSession, base: str, target: str, keys: list[str] | None = None, part: list[str] | None = None) -> None:
    """Write the newest rows of a routed table to a table of its own."""
    parts = part or ["index_name"]
    rows = latest(read_routed(spark, base, parts), keys).drop("writer", "run", "batch")
    _replace_own(_spread(rows, parts), parts).parquet(target)


COVERAGE_SCHEMA = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("firm_name", T.StringType()),
        T.StructField("run", T.LongType()),
    ]
)


def coverage_path(base: str) -> str:
    """Where a band table keeps what rebuilds cover; part of the table."""
    return f"{base}/coverage"


def add_coverage(spark: SparkSession, path: str, start: int, end: int, run: int, firm: str | None = None) -> None:
    """Record that ``run`` has rebuilt the buckets of ``[start, end)``; this publishes it."""
    row = spark.createDataFrame([(start, end, firm, run)], COVERAGE_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)


def coverage_intervals(coverage: DataFrame) -> DataFrame:
    """Coverage as disjoint intervals per firm (null: all) with the newest run: ``firm_name, start, end, run``.

    Neighbours of one run are one interval. There are at most two per rebuild and firm, however long
    the ranges are. Null or empty ranges cover nothing.
    """
    ranges = coverage.where("start < end").groupBy("firm_name", "start", "end").agg(F.max("run").alias("run"))
    points = ranges.select("firm_name", F.explode(F.array("start", "end")).alias("start")).distinct()
    firm = Window.partitionBy("firm_name").orderBy("start")
    pieces = points.withColumn("end", F.lead("start").over(firm)).where("end IS NOT NULL").alias("p")
    over = F.col("p.firm_name").eqNullSafe(F.col("r.firm_name")) & (F.col("r.start") <= F.col("p.start")) & (F.col("r.end") >= F.col("p.end"))
    newest = pieces.join(ranges.alias("r"), over).groupBy("p.firm_name", "p.start", "p.end").agg(F.max("r.run").alias("run"))
    breaks = ~(F.lag("run").over(firm).eqNullSafe(F.col("run")) & F.lag("end").over(firm).eqNullSafe(F.col("start")))
    runs = newest.withColumn("_new", breaks.cast("int")).withColumn("_part", F.sum("_new").over(firm))
    return runs.groupBy("firm_name", "_part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("run").alias("run")).drop("_part")


def effective_band(rows: DataFrame, coverage: DataFrame, step: int = 60) -> DataFrame:
    """Rollup rows that count: for a rebuilt bucket those of its newest rebuild, for any
    other bucket those the streams wrote.

    ``rows`` may hold buckets of several widths as long as each is a multiple of ``step``.
    Coverage stays intervals; both sides are dealt into bins of the mean length of an interval, so an
    interval lies in three bins on average and the join is an equi-join with a range check.
    """
    intervals = coverage_intervals(coverage)
    mean = F.ceil(F.sum(F.col("end") - F.col("start")) / F.count(F.lit(1)) / step).cast("bigint") * step
    bin_of = lambda at, width: F.expr(f"{at} div {width}")
    sized = intervals.crossJoin(F.broadcast(intervals.agg(F.coalesce(mean, F.lit(step)).alias("_width"))))
    binned = sized.withColumn("_bin", F.explode(F.sequence(bin_of("start", "_width"), bin_of("(end - 1)", "_width"))))
    width = intervals.agg(F.coalesce(mean, F.lit(step))).scalar()
    timed = rows.withColumn("_width", width).withColumn("_bin", bin_of("from_time", "_width")).alias("t")
    side = lambda which, name: binned.where(which).select(
        "_bin", "start", "end", F.col("firm_name").alias("_firm"), F.col("run").alias(name)
    )
    inside = lambda x: (F.col("t._bin") == F.col(f"{x}._bin")) & (F.col("t.from_time") >= F.col(f"{x}.start")) & (F.col("t.from_time") < F.col(f"{x}.end"))
    joined = timed.join(side("firm_name IS NULL", "_all").alias("a"), inside("a"), "left")
    joined = joined.join(side("firm_name IS NOT NULL", "_own").alias("f"), inside("f") & (F.col("t.firm_name") == F.col("f._firm")), "left")
    wanted = F.greatest(F.coalesce("_all", F.lit(0)), F.coalesce("_own", F.lit(0)))
    return joined.where(F.col("t.run") == wanted).select(*[F.col(f"t.{c}") for c in rows.columns])


def read_band(spark: SparkSession, base: str, prefix: str, index_type: str | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """Rows of a band table that count, of indices that start with ``prefix``.

    The one way to read a band table: rebuilds replace what they cover. With ``start``
    and ``end`` only buckets of that range are read, and coverage is cut to it first.
    """
    rows = read_routed(spark, f"{base}/band", ["index_name", "index_type"]).where(F.col("index_name").startswith(prefix))
    if index_type:
        rows = rows.where(F.col("index_type") == index_type)
    low, high = (F.lit(x).cast("bigint") for x in (start, end))
    if start is not None:
        rows = rows.where(F.col("from_time") >= low)
    if end is not None:
        rows = rows.where(F.col("from_time") < high)
    if not found(spark, coverage_path(base)):
        return rows.where("run = 0")
    coverage = spark.read.schema(COVERAGE_SCHEMA).parquet(coverage_path(base))
    cut = coverage.withColumns({"start": F.greatest("start", low), "end": F.least("end", high)}).where("start < end")
    return effective_band(rows, cut)


def compact_band(spark: SparkSession, base: str, target: str, keys: list[str]) -> None:
    """Write a band table anew: one row per key and bucket, few files per index.

    What counts is summed, so partial rows and replaced rebuilds go. ``target`` is a band
    table of its own, to be put in place of the old one between runs of its streams.
    """
    rows = read_band(spark, base, "")
    whole = rows.groupBy(*keys, "from_time", "index_name", "index_type").agg(
        F.sum("req_count").alias("req_count"), F.sum("traffic").alias("traffic"), F.sum("traffic_pm").alias("traffic_pm"),
        F.first("log_date").alias("log_date"), F.min("id").alias("id"),
    )
    routed_upsert(whole, f"{target}/band", 0, part=["index_name", "index_type"], writer="compacted")


def write_archive(df: DataFrame, base: str, batch: int, writer: str | None = None) -> None:
    """Archive rows by table, several tables in one pass, ordered by minute in each file."""
    routed_upsert(df, base, batch, part=["table_suffix"], sort=["log_minute"], writer=writer)


def raw_lines_archive(df: DataFrame, base: str, batch: int, value: str = "value", suffix: str = "raw") -> None:
    """Unparsed lines under random keys."""
    rows = df.select(
        F.expr("uuid()").alias("row_key"), F.col(value).alias("info"), F.lit(suffix).alias("table_suffix")
    )
    routed_upsert(rows, base, batch, part=["table_suffix"])


def write_event_store(
    df: DataFrame, base: str, batch: int, time_col: str = "time_local", tz: str = DEFAULT_TZ
) -> None:
    """Rolled-up events in one folder per day."""
    days = df.withColumn("day", fmt_epoch(F.unix_seconds(time_col), "yyyyMMdd", tz))
    routed_upsert(days, base, batch, part=["day"])


def slice_columns(time_col: str = "time_unix", tz: str = DEFAULT_TZ) -> dict[str, Column]:
    """Folders of a log package: five minutes wide, one minute wide from 18:05 on."""
    t = F.col(time_col).try_cast("bigint")
    clock = fmt_epoch(t, "HHmm", tz)
    start = F.when(clock >= "1805", t - t % 60).otherwise(t - t % 300)
    return {
        "day": fmt_epoch(start, "yyyyMMdd", tz),
        "hour": fmt_epoch(start, "HH", tz),
        "minute": fmt_epoch(start, "mm", tz),
    }


def export_text(df: DataFrame, out: str, order: list[str] | None = None, tz: str = DEFAULT_TZ) -> None:
    """Gzip text, one folder per day, hour, minute and domain."""
    folders = ["day", "hour", "minute", "domain"]
    lines = user_log_lines(df.withColumns(slice_columns(tz=tz)), keep=["day", "hour", "minute", *(order or [])])
    rows = _spread(lines, folders)
    if order:
        rows = rows.sortWithinPartitions(*folders, *order)
    _replace_own(rows.select("value", *folders), folders).option("compression", "gzip").text(out)


def to_kafka(df: DataFrame, brokers: str, topic: str, value: str = "value") -> None:
    """Send lines to a topic; the connector is the user's to supply."""
    (
        df.select(F.col(value).cast("string").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )


def to_console(df: DataFrame, rows: int = 20) -> None:
    df.show(rows, truncate=False)
