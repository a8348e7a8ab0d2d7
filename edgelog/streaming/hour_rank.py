"""Top lists of whole hours from a stream.

The state of the stream holds the counters of every URL and hour (RocksDB, changed rows
only). A batch gives the new totals of the URLs it touched; the lists of the hours they
lie in are remade from those and the lists so far. That is exact: counters only grow, so a
URL the batch did not touch and that was in no list cannot enter one. A URL that is below
the cut in every batch but in the hour's top is found, which ranks per batch miss.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from edgelog import layouts as L
from edgelog.functions.times import DEFAULT_TZ
from edgelog.operators import clean, parse, rank, route
from edgelog.sinks.writers import found, read_routed, routed_upsert, stream_id
from edgelog.streaming import runner

Handler = Callable[[DataFrame, int], None]
_LIST = ["domain", "time_unix"]
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state on disk; the session's settings come back after."""
    before = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _flagged(lines: DataFrame, value: str) -> DataFrame:
    return clean.clean_band_flagged(runner.lenient_size(parse.parse_flagged(lines, "common34", value=value)))


def totals(lines: DataFrame, value: str = "value", delay: str | None = None) -> DataFrame:
    """Changed totals per URL and hour of a stream of lines."""
    good, _ = parse.part_flagged(_flagged(lines, value), "common34")
    return rank.url_hour_totals(good, delay)


def hour_tops(spark: SparkSession, base: str, before: int | None = None, hours: tuple[int, int] | None = None) -> DataFrame:
    """The lists as they are: per domain and hour the rows of the newest batch that remade them.

    ``before`` leaves out a batch and later ones, ``hours`` reads a range of hours only.
    """
    rows = read_routed(spark, f"{base}/rank").where("run = 0")
    if before is not None:
        rows = rows.where((F.col("batch") < before) & (F.col("writer") == stream_id(spark)))
    if hours is not None:
        rows = rows.where(F.col("time_unix").between(*hours))
    newest = F.max("batch").over(Window.partitionBy("writer", *_LIST))
    return rows.withColumn("_newest", newest).where("batch = _newest").drop("_newest")


def tops_handler(base: str, n: int = 100, tz: str = DEFAULT_TZ) -> Handler:
    """Remake the lists of the hours a batch of :func:`totals` touches."""
    columns = ["id", "time_unix", "domain", "request", *L.RANK_MEASURES]

    def run(changed: DataFrame, batch: int) -> None:
        spark = changed.sparkSession
        held = changed.select(*columns).persist()
        try:
            low, high = held.agg(F.min("time_unix"), F.max("time_unix")).first()
            pool = held
            if found(spark, f"{base}/rank"):
                listed = hour_tops(spark, base, batch, (low, high)).select(*columns)
                old = listed.join(held.select(*_LIST).distinct(), _LIST, "left_semi")
                pool = held.unionByName(old.join(held.select("id", *_LIST, "request"), ["id", *_LIST, "request"], "left_anti").select(*columns))
            top = rank.top_union(pool, n, by=_LIST)
            routed_upsert(route.route_rank(top, tz), f"{base}/rank", batch)
        finally:
            held.unpersist()

    return run


def rejects_handler(base: str, value: str = "value") -> Handler:
    """Lines that no rank can count, to the quarantine."""

    def run(df: DataFrame, batch: int) -> None:
        _, bad = parse.part_flagged(_flagged(df, value), "common34")
        routed_upsert(bad, f"{base}/quarantine", batch, part=["layout"])

    return run


def checkpoints(base: str) -> list[str]:
    """Checkpoints of the two queries of :func:`run_hour_rank`."""
    return [f"{base}/ranks", f"{base}/rejects"]


def run_hour_rank(
    lines: DataFrame, base: str, checkpoint: str, n: int = 100, value: str = "value", delay: str | None = None, tz: str = DEFAULT_TZ,
    interval: str | None = None, writer: str | None = None,
) -> list[StreamingQuery]:
    """Start the stream of top lists and the one that keeps its rejects.

    Two queries, as the rows that reach a stateful one are counters, no lines. Each has a
    folder of its own in ``checkpoint``.
    """
    own, other = checkpoints(checkpoint)
    with disk_state(lines.sparkSession):
        ranks = runner.run_stream(totals(lines, value, delay), tops_handler(base, n, tz), own, interval, writer=writer, mode="update")
    return [ranks, runner.run_stream(lines, rejects_handler(base, value), other, interval, writer=writer)]
