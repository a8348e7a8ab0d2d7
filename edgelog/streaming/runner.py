"""Streams: one runner and the work each kind of stream does per micro-batch.

A handler takes ``(batch frame, batch id)``. The checkpoint fixes which input makes up a
batch, and every handler replaces what its batch wrote before, so a batch that is run
again after a failure leaves one copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from edgelog import layouts as L
from edgelog.functions.times import DEFAULT_TZ
from edgelog.operators import archive, band, clean, filters, parse, rank, route
from edgelog.session import compiled
from edgelog.sinks.writers import CURRENT_WRITER, found, raw_lines_archive, read_band, routed_upsert, stream_id, write_archive, write_event_store
from edgelog.streaming import drain

Handler = Callable[[DataFrame, int], None]
_BROKER = ["partition", "offset"]


def run_stream(
    df: DataFrame, handler: Handler, checkpoint: str, interval: str | None = None, name: str | None = None,
    writer: str | None = None, mode: str = "append",
) -> StreamingQuery:
    """Start a stream. Without ``interval`` it works off what is there and stops.

    ``stop()`` on the returned query interrupts a running batch; :func:`edgelog.streaming.drain.drain`
    lets it finish. What the stream writes is marked with ``writer``, by default the id its checkpoint keeps, so streams on one table
    do not touch each other's rows. After the loss of a checkpoint a replay from the start
    replaces the old rows if it is given the old writer and cuts the input as before. ``mode``
    is the output mode, ``update`` for changed rows of a state.
    """
    # a request to stop that an earlier run left behind is not meant for this one
    drain.withdraw_stop(df.sparkSession, checkpoint)
    gate = drain.new_gate(checkpoint)
    out = df.writeStream.outputMode(mode).foreachBatch(gate.through(_skip_empty(handler, writer)))
    if name:
        out = out.queryName(name)
    out = out.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with compiled(df.sparkSession):  # a stream keeps the settings it is started with
        return out.trigger(**trigger).start()


def _skip_empty(handler: Handler, writer: str | None = None) -> Handler:
    def run(df: DataFrame, batch: int) -> None:
        if df.isEmpty():
            return
        before = CURRENT_WRITER.set(writer)
        try:
            handler(df, batch)
        finally:
            CURRENT_WRITER.reset(before)

    return run


def fan_out(*handlers: Handler) -> Handler:
    """Several outputs of one batch, read once."""

    def run(df: DataFrame, batch: int) -> None:
        df.persist()
        try:
            for handler in handlers:
                handler(df, batch)
        finally:
            df.unpersist()

    return run


def batch_time(df: DataFrame, base: str, batch: int) -> int:
    """The "now" of a batch: it stays the same when the batch runs again.

    The newest broker time where the source has one; else the clock at the first run,
    kept next to the tables.
    """
    spark = df.sparkSession
    if "timestamp" in df.columns and dict(df.dtypes)["timestamp"] == "timestamp":
        newest = df.agg(F.max(F.unix_timestamp("timestamp"))).first()[0]
        if newest is not None:
            return newest
    path = f"{base}/clock/{stream_id(spark)}/{batch}"
    if not found(spark, f"{path}/_SUCCESS"):
        spark.range(1).select(F.unix_timestamp(F.current_timestamp()).alias("now")).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema("now bigint").parquet(path).first()[0]


def _broker(df: DataFrame) -> list[str]:
    return _BROKER if all(c in df.columns for c in _BROKER) else []


def _tags(df: DataFrame, batch: int) -> tuple[str, str]:
    """Batch tags from broker offsets where the source has them, else from the batch id."""
    if _broker(df):
        row = route.batch_tag(df).first()
        return row["batch_tag"], row["batch_tag_all"]
    return f"0-{batch}", f"0-{batch};"


def _store_narrow(
    flagged: DataFrame, need: list[str], layout: str, base: str, batch: int,
    rows: Callable[[DataFrame, tuple[str, str]], None],
) -> None:
    """Give the good rows and the batch tags to ``rows``, the others to the quarantine.

    For outputs that read the batch several times. Held are the ``need`` columns, and the
    raw line of bad rows only.
    """
    raw = F.when(F.col("_reason").isNotNull(), F.col("_raw")).alias("_raw")
    held = flagged.select(*need, *_broker(flagged), raw, "_reason").persist()
    try:
        good, bad = parse.part_flagged(held, layout)
        rows(good, _tags(held, batch))
        routed_upsert(bad, f"{base}/quarantine", batch, part=["layout"])
    finally:
        held.unpersist()


def _store_whole(
    flagged: DataFrame, layout: str, base: str, batch: int, write: Callable[[DataFrame], None]
) -> None:
    """Write wide rows in one pass without holding them.

    Bad rows are counted on the way; only a batch that has some is read again for them.
    """
    seen = Observation()
    counted = flagged.observe(seen, F.count_if(F.col("_reason").isNotNull()).alias("bad"))
    write(parse.part_flagged(counted, layout)[0])
    if seen.get["bad"]:
        routed_upsert(parse.part_flagged(flagged, layout)[1], f"{base}/quarantine", batch, part=["layout"])


def band_handler(
    base: str, kind: str = "fusion", value: str = "value", as_of=None, tz: str = DEFAULT_TZ
) -> Handler:
    """One- and five-minute bandwidth of each batch as partial rows.

    Buckets follow arrival: a late record adds a partial row in a later batch, and
    readers sum (``band.band_totals``), so nothing is dropped.
    """
    layout, keys, index_type = {
        "fusion": ("fusion_band37", L.FUSION_KEYS, L.TYPE_BAND_FUSION),
        "jx": ("jx_band45", L.JX_KEYS, L.TYPE_BAND_JX),
    }[kind]

    def run(df: DataFrame, batch: int) -> None:
        parsed = parse.parse_flagged(df, layout, value=value, keep=_broker(df))
        now = batch_time(df, base, batch) if as_of is None else as_of

        def rows(good: DataFrame, tags: tuple[str, str]) -> None:
            tag, _ = tags
            one = band.band(good, keys, 60)
            out = []
            for frame, prefix in ((one, L.INDEX_BAND_1M), (band.reband(one, keys, 300), L.INDEX_BAND_5M)):
                routed = route.route_band(frame, prefix, index_type, now, tz)
                out.append(route.with_doc_id(routed, F.lit(tag)))
            routed_upsert(out[0].unionByName(out[1]), f"{base}/band", batch, part=["index_name", "index_type"])
            if kind == "jx":
                host = route.route_host(band.host_status(good), tz)
                routed_upsert(route.with_doc_id(host, F.lit(tag)), f"{base}/host", batch)

        need = [*keys, "time_unix", "body_bytes_sent", *(L.HOST_KEYS[:1] if kind == "jx" else [])]
        _store_narrow(clean.clean_band_flagged(parsed), need, layout, base, batch, rows)

    return run


def detail_handler(
    base: str, kind: str = "fusion", value: str = "value", tz: str = DEFAULT_TZ, keep_domain: str | None = None,
    index: str | None = None,
) -> Handler:
    """Detail records: parse, keep policy for our own nodes, clean, id, route, write.

    ``keep_domain`` is text of domains whose successes are kept on any layer, ``index`` what
    the names of indices start with.
    """
    layout = {"fusion": "fusion_detail39", "jx": "jx_detail45"}[kind]

    def run(df: DataFrame, batch: int) -> None:
        parsed = parse.parse_flagged(df, layout, value=value)
        if kind == "jx":
            parsed = filters.keep_policy(parsed, domain_substr=keep_domain)
        routed = route.route_detail(route.with_row_id(clean.clean_detail_flagged(parsed), kind), kind, tz, index)
        reason = F.coalesce("_reason", F.when(F.col("index_name").isNull(), F.lit("no index")))
        flagged = routed.withColumn("_reason", reason)
        _store_whole(flagged, layout, base, batch, lambda good: routed_upsert(good, f"{base}/detail", batch))

    return run


def rank_handler(base: str, n: int = 100, value: str = "value", tz: str = DEFAULT_TZ, legacy_order: bool = False) -> Handler:
    """URL-hour rollup of each batch and its top lists."""

    def run(df: DataFrame, batch: int) -> None:
        parsed = parse.parse_flagged(df, "common34", value=value, keep=_broker(df))

        def rows(good: DataFrame, tags: tuple[str, str]) -> None:
            _, tag = tags
            top = rank.top_union(rank.url_hour(good), n, legacy_order=legacy_order)
            routed = route.route_rank(route.with_rank_doc_id(top, F.lit(tag)), tz)
            routed_upsert(routed, f"{base}/rank", batch)

        need = ["time_unix", "domain", "request", "http_status", "body_bytes_sent"]
        _store_narrow(clean.clean_band_flagged(lenient_size(parsed)), need, "common34", base, batch, rows)

    return run


def lenient_size(df: DataFrame) -> DataFrame:
    """A rank counts a request of unreadable size with no bytes."""
    size = F.col("body_bytes_sent")
    return df.withColumn("body_bytes_sent", F.when(size.try_cast("double").isNotNull(), size).otherwise("0"))


def archive_handler(
    base: str, value: str = "value", salts: int = 10, as_of=None, hot_days: int = 30, tz: str = DEFAULT_TZ
) -> Handler:
    """Raw vendor lines to the archive."""

    def run(df: DataFrame, batch: int) -> None:
        now = batch_time(df, base, batch) if as_of is None else as_of
        flagged = archive.archive_lines_flagged(df, value=value, salts=salts, as_of=now, hot_days=hot_days, tz=tz)
        _store_whole(flagged, "archive", base, batch, lambda good: write_archive(good, f"{base}/archive", batch))

    return run


def sql_handler(
    view: str, query: str, sink: Callable[[DataFrame, int], None], quarantine: str | None = None, value: str = "value",
    parse_lines: bool = True,
) -> Handler:
    """User SQL over each batch: vendor lines become the view, the result goes to ``sink``.

    Lines that cannot be parsed go to the table ``quarantine``, which parsing needs.
    """
    if parse_lines and not quarantine:
        raise ValueError("parsing needs a quarantine table for the lines it rejects")

    def run(df: DataFrame, batch: int) -> None:
        def write(rows: DataFrame) -> None:
            rows.createOrReplaceTempView(view)
            sink(rows.sparkSession.sql(query), batch)

        if not parse_lines:
            write(df)
            return
        flagged = parse.parse_sql42_flagged(df, value=value).persist()
        try:
            good, bad = parse.part_flagged(flagged, "fusion_sql42")
            write(good)
            routed_upsert(bad, quarantine, batch, part=["layout"])
        finally:
            flagged.unpersist()

    return run


def firm_day_handler(
    base: str, value: str = "value", tz: str = DEFAULT_TZ, keep: bool = False, keep_domain: str | None = None, index: str = "details-",
) -> Handler:
    """The 42 typed columns of vendor lines in an index per firm and file day.

    With ``keep`` the retention policy applies first.
    """

    def run(df: DataFrame, batch: int) -> None:
        flagged = parse.parse_sql42_flagged(df, value=value)
        if keep:
            flagged = filters.keep_policy(flagged, domain_substr=keep_domain)
        name = F.concat(F.lit(index), "lowfirmname", F.lit("-"), "filetime")
        routed = flagged.withColumn("index_name", name)
        _store_whole(routed, "fusion_sql42", base, batch, lambda good: routed_upsert(good, f"{base}/detail", batch))

    return run


def event_handler(base: str, value: str = "value", tz: str = DEFAULT_TZ) -> Handler:
    """Bytes per event time and domain of each batch, as partial rows by day."""

    def run(df: DataFrame, batch: int) -> None:
        def rows(good: DataFrame, tags: tuple[str, str]) -> None:
            write_event_store(band.domain_rollup(good), f"{base}/events", batch, tz=tz)

        _store_narrow(parse.druid_events_flagged(df, value=value), ["time_local", "domain", "body_bytes_sent"], "druid_event", base, batch, rows)

    return run


def raw_handler(base: str, value: str = "value") -> Handler:
    """Unparsed lines to the archive."""
    return lambda df, batch: raw_lines_archive(df, f"{base}/raw", batch, value)


def watermarked_band(df: DataFrame, keys: list[str], delay: str, width: str = "60 seconds") -> DataFrame:
    """Event-time buckets that close ``delay`` after the newest record; later ones are lost.

    Opt-in: the default stream keeps late records.
    """
    timed = df.select(
        *[F.coalesce(F.col(k).cast("string"), F.lit("0")).alias(k) for k in keys],
        F.timestamp_seconds(F.col("time_unix")).alias("_at"),
        F.col("body_bytes_sent").try_cast("double").alias("_size"),
    )
    grouped = timed.withWatermark("_at", delay).groupBy(F.window("_at", width), *keys)
    return grouped.agg(F.count(F.lit(1)).alias("req_count"), F.sum("_size").alias("traffic")).select(
        *keys, F.unix_seconds("window.start").alias("from_time"), "req_count", "traffic"
    )


def watermarked_rollup(events: DataFrame, delay: str) -> DataFrame:
    """Bytes per event time and domain over a stream of events.

    Events more than ``delay`` behind the newest one are lost; the query's progress counts
    them as ``numRowsDroppedByWatermark``. :func:`event_handler` loses none.
    """
    return band.domain_rollup(events.withWatermark("time_local", delay))


def band_view(spark: SparkSession, base: str, prefix: str, keys: list[str], index_type: str | None = None) -> DataFrame:
    """Whole buckets of a band table: the sum of the partial rows that count.

    A table that holds both kinds of log needs ``index_type``.
    """
    return band.band_totals(read_band(spark, base, prefix, index_type), keys)
