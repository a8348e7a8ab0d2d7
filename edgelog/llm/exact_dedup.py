"""Exact deduplication with streaming state that never expires.

Texts are equal when identical after each run of ASCII white space becomes one space.
Documents pass as a stream of (digest, stable id, content locator). The state, kept on
disk by the RocksDB store of Structured Streaming, holds per digest the smallest id, the
file it lies in, and the number of rows, for as long as the checkpoint lives. Partial
aggregation meets a hot group before the shuffle, so a task sends one row for it.

A digest that is hit more than once is only a claim: the full texts behind it are read
again and compared byte by byte. Should one digest stand for several texts, their rows
are grouped by the text itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edgelog.llm import shared

#: Input one micro-batch takes at most; what a batch adds to the state is bounded by it.
TRIGGER_BYTES = 64 << 30
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # stores of small partitions stay small
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def normalised(df: DataFrame, text: str = "text", out: str = "normal") -> DataFrame:
    """``df`` with the white space of ``text`` made one space per run; null counts as empty."""
    spaced = F.coalesce(F.col(text), F.lit(""))
    for space in "\t\n\v\f\r":
        spaced = F.replace(spaced, F.lit(space), F.lit(" "))
    df = df.withColumn(out, spaced)
    runs = F.regexp_replace(out, "  +", " ")
    return df.withColumn(out, F.when(F.contains(F.col(out), F.lit("  ")), runs).otherwise(F.col(out)))


def feed(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """What the stream needs of each document: ``digest, doc_id, locator``."""
    slim = normalised(docs.select("doc_id", "text")).select("doc_id", digest(F.col("normal")).alias("digest"))
    return slim.select("digest", "doc_id", F.input_file_name().alias("locator"))


def _first() -> Column:
    """Order of staying: the smallest id; rows without an id come last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "locator"))


def observe(stream: DataFrame, checkpoint: str, out: str) -> None:
    """Run ``stream`` of :func:`feed` rows through the keyed state until its input ends.

    Each batch writes the digests it touched, with their state so far, to a folder of its
    own below ``out``; a batch that runs again replaces its folder. Calling this again
    with the same folders goes on from the state, with the files that are new.
    """
    spark = stream.sparkSession
    before = {key: spark.conf.get(key, None) for key in _STATE}
    state = stream.groupBy("digest").agg(_first().alias("first"), F.count("*").alias("n"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    try:
        for key, value in _STATE.items():
            spark.conf.set(key, value)
        query = (
            state.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(write).start()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    query.awaitTermination()


def latest(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """Newest state per digest: ``digest, first, n``; counts only grow."""
    seen = spark.read.schema(schema).parquet(out)
    return seen.groupBy("digest").agg(F.max_by("first", "n").alias("first"), F.max("n").alias("n"))


def _collisions(docs: DataFrame, repeated: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests that stand for more than one text, from the full bytes of all repeated ones."""
    texts = normalised(docs.select("text")).select("normal", digest(F.col("normal")).alias("digest"))
    hits = texts.withColumn("short", F.xxhash64("digest")).join(repeated, "short", "left_semi")
    return hits.groupBy("digest", "normal").agg(F.count("*").alias("rows")).groupBy("digest").count().filter("count > 1").select("digest")


def groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Per row of ``docs``: ``doc_id, digest, keep_id, group_size, kept``.

    Null text counts as empty; equal empty texts are one group. The smallest id stays;
    rows without an id stay only in a group that has no id at all, where all do. Rows that
    repeat the staying id all stay. An empty table gives no rows. Other columns are not read.
    """
    spark, base = docs.sparkSession, shared.scratch(docs.sparkSession, "exact")
    slim = feed(docs, digest)
    slim.write.parquet(f"{base}/feed")
    stream = spark.readStream.schema(slim.schema).option("maxBytesPerTrigger", TRIGGER_BYTES).parquet(f"{base}/feed")
    observe(stream, f"{base}/checkpoint", f"{base}/state")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"digest string, first struct<anonymous: boolean, doc_id: {kind}, locator: string>, n long"
    fed = spark.read.schema(slim.schema).parquet(f"{base}/feed")
    if fed.isEmpty():
        none = F.lit(None)
        return fed.select("doc_id", "digest", none.cast(kind).alias("keep_id"), none.cast("long").alias("group_size"), none.cast("boolean").alias("kept"))
    # written, so that both sides of the join below are plain shuffles and hot digests can be split
    state = shared.stored(latest(spark, f"{base}/state", schema), "latest")
    repeated = shared.stored(state.filter("n > 1").select(F.xxhash64("digest").alias("short")).distinct(), "repeated")
    collided = shared.stored(_collisions(docs, repeated, digest), "collided")
    claimed = state.select("digest", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"))
    found = fed.select("doc_id", "digest").join(claimed, "digest")
    if not collided.isEmpty():
        found = found.join(collided, "digest", "left_anti").unionByName(_by_text(docs, collided, digest))
    return found.select("doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def _by_text(docs: DataFrame, collided: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Groups of rows whose digest stands for several texts, by the text itself."""
    rows = normalised(docs.select("doc_id", "text")).select("doc_id", "normal", digest(F.col("normal")).alias("digest"))
    rows = rows.join(collided, "digest", "left_semi")
    kept = rows.groupBy("digest", "normal").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return rows.join(kept, ["digest", "normal"]).select("doc_id", "digest", "keep_id", "group_size")


def deduplicate(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Rows of ``docs`` that stay, columns unchanged."""
    gone = groups(docs, digest).filter(~F.col("kept")).select("doc_id", "digest")
    normal = shared.fresh(docs, "normal")
    mark = shared.fresh(docs, "digest")
    marked = normalised(docs, "text", normal).withColumn(mark, digest(F.col(normal))).drop(normal)
    return shared.without(marked, mark, gone)


def report(docs: DataFrame) -> DataFrame:
    return groups(docs).select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))
