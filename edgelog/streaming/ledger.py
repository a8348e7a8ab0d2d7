"""What streams have read, as tables: offsets and rows per batch, and what is missing between.

Two records are kept. :func:`recorded` writes, inside the batch and replaced with it, the
first and last offset and the rows of every topic and partition; it costs a pass over the
offset columns. :class:`ProgressLedger` writes what the engine reports after each batch, the
start and end of every source, rows and time. The first is exact and survives a replay, the
second also tells of sources without offsets in their rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from edgelog.sinks.writers import found, read_routed, routed_upsert

Handler = Callable[[DataFrame, int], None]
_PLACE = ["topic", "partition"]


def batch_offsets(df: DataFrame, stream: str) -> DataFrame:
    """Per topic and partition of a batch: rows, first and last offset, and rows without a value.

    Inputs without a topic or partition count as one; a row without an offset is only counted.
    Rows read twice are told by ``distinct_rows``.
    """
    has = lambda name, kind, other: (F.col(name) if name in df.columns else F.lit(other)).cast(kind)
    slim = df.select(
        F.coalesce(has("topic", "string", ""), F.lit("")).alias("topic"), F.coalesce(has("partition", "int", 0), F.lit(0)).alias("partition"),
        has("offset", "bigint", None).alias("offset"), F.col("value").isNull().cast("int").alias("_empty"),
    )
    # a repeated offset is found by grouping on it first, which also shares out a hot partition
    once = slim.groupBy(*_PLACE, "offset").agg(F.count(F.lit(1)).alias("n"), F.sum("_empty").alias("_empty"))
    return once.groupBy(*_PLACE).agg(
        F.sum("n").alias("rows"), F.sum("_empty").alias("null_values"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"), F.count("offset").alias("distinct_rows"),
    ).withColumn("stream", F.lit(stream))


def recorded(handler: Handler, base: str, stream: str) -> Handler:
    """``handler``, with the offsets of each batch in ``<base>/ledger`` before it runs."""

    def run(df: DataFrame, batch: int) -> None:
        routed_upsert(batch_offsets(df, stream), f"{base}/ledger", batch, part=["stream"])
        handler(df, batch)

    return run


def ledger(spark: SparkSession, base: str) -> DataFrame:
    """Offsets of every batch: ``stream, writer, batch, topic, partition, first_offset, last_offset, rows, ...``."""
    return read_routed(spark, f"{base}/ledger", ["stream"]).drop("run")


def gaps(kept: DataFrame) -> DataFrame:
    """Offset ranges that no batch of a stream has read, a row each: ``from_offset``, ``to_offset``, ``lost``.

    A range between two batches is told exactly. What is missing inside a batch is known by
    number only (``from_offset`` to ``to_offset`` is then the batch's own range); a source that
    compacts its topics has such gaps without a loss. What lies before the first batch or after
    the last is not a gap, a range read by two batches is none either.
    """
    line = Window.partitionBy("stream", "writer", *_PLACE).orderBy("first_offset", "last_offset").rowsBetween(Window.unboundedPreceding, -1)
    seen = kept.where("first_offset IS NOT NULL").withColumn("_before", F.max("last_offset").over(line))
    between = seen.where("first_offset > _before + 1").select(
        "stream", "writer", "batch", *_PLACE, F.lit("between").alias("place"), (F.col("_before") + 1).alias("from_offset"),
        (F.col("first_offset") - 1).alias("to_offset"), (F.col("first_offset") - F.col("_before") - 1).alias("lost"),
    )
    missing = F.col("last_offset") - F.col("first_offset") + 1 - F.col("distinct_rows")
    inside = seen.where(missing > 0).select(
        "stream", "writer", "batch", *_PLACE, F.lit("inside").alias("place"), F.col("first_offset").alias("from_offset"),
        F.col("last_offset").alias("to_offset"), missing.alias("lost"),
    )
    return between.unionByName(inside)


def stale(kept: DataFrame, available: DataFrame) -> DataFrame:
    """Where a source no longer has what a stream would read next.

    ``available`` has ``topic, partition, earliest``, the first offset the source still has. Per
    partition behind that: ``next_offset``, ``earliest`` and how many rows are ``lost``.
    """
    ends = kept.groupBy("stream", "writer", *_PLACE).agg((F.max("last_offset") + 1).alias("next_offset"))
    both = ends.join(available.select(*_PLACE, "earliest"), _PLACE)
    return both.where("next_offset < earliest").withColumn("lost", F.col("earliest") - F.col("next_offset"))


def balance(spark: SparkSession, base: str) -> DataFrame:
    """Per batch of a stream: rows read, of them good, and bad ones in the quarantine."""
    read = ledger(spark, base).groupBy("stream", "writer", "batch").agg(F.sum("rows").alias("rows"))
    if not found(spark, f"{base}/quarantine"):
        return read.select("*", F.col("rows").alias("good"), F.lit(0).cast("bigint").alias("bad"))
    bad = read_routed(spark, f"{base}/quarantine", ["layout"]).groupBy("writer", "batch").agg(F.count(F.lit(1)).alias("bad"))
    joined = read.join(bad, ["writer", "batch"], "left").withColumn("bad", F.coalesce("bad", F.lit(0).cast("bigint")))
    return joined.select("stream", "writer", "batch", "rows", (F.col("rows") - F.col("bad")).alias("good"), "bad")


PROGRESS = "stream string, query string, run string, batch bigint, source string, start_offset string, end_offset string, latest_offset string, rows bigint, millis bigint"


def _text(offset) -> str | None:
    return None if offset is None else offset if isinstance(offset, str) else json.dumps(offset)


class ProgressLedger(StreamingQueryListener):
    """Writes a row per source and batch to ``<base>/progress`` when the engine reports it.

    A batch that is reported again replaces its rows. A report lost with the driver leaves a
    gap, which :func:`progress_gaps` shows; the offsets themselves are in the checkpoint.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        rows = [
            (p.name, str(p.id), str(p.runId), p.batchId, s.description, _text(s.startOffset), _text(s.endOffset), _text(s.latestOffset),
             s.numInputRows, p.batchDuration)
            for s in p.sources
        ]
        out = f"{self.base}/progress/query_id={p.id}/batch_id={p.batchId}"
        self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("overwrite").parquet(out)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(PROGRESS).parquet(f"{base}/progress").select(*[c.split()[0] for c in PROGRESS.split(", ")])


def progress_gaps(reported: DataFrame) -> DataFrame:
    """Sources whose batch does not start where the one before it ended, or whose report is missing."""
    line = Window.partitionBy("query", "source").orderBy("batch")
    seen = reported.withColumns({"_end": F.lag("end_offset").over(line), "_batch": F.lag("batch").over(line)})
    return seen.where("_batch IS NOT NULL AND NOT (start_offset <=> _end)").select(
        "stream", "query", "source", "batch", F.col("_batch").alias("after_batch"), F.col("_end").alias("ended_at"), "start_offset",
    )
