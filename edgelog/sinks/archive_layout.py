"""How an archive lies on disk, so that a scan by minute, firm or key text reads little of it.

:func:`cluster` writes a table anew in Morton order of minute and firm: a file, and a row group
in it, covers a short span of both, so either prunes by its least and greatest value. :func:`index_keys`
keeps a bitmap of the three-letter parts of the row keys of each file; :func:`scan_containing` reads
only the files whose bitmap holds every part of the text that is looked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgelog.sinks.writers import found, read_routed, routed_upsert

#: Bits of each side of the Morton code; bits of a file's bitmap.
SIDE_BITS = 8
KEY_BITS = 16
#: Rows that a task sorts and writes, in one file or several.
TASK_ROWS = 100_000
_PART = ["table_suffix"]


def _interleaved(a: Column, b: Column) -> Column:
    """Bits of two numbers of ``SIDE_BITS`` bits, taken in turn."""
    bit = lambda c, i: F.shiftright(c, i).bitwiseAND(F.lit(1))
    out = F.lit(0)
    for i in range(SIDE_BITS):
        out = out + F.shiftleft(bit(a, i), 2 * i + 1) + F.shiftleft(bit(b, i), 2 * i)
    return out


def morton(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_z``, the Morton code of the minute's place in its table and the firm's place among firms.

    Both places keep the order of their values. Malformed rows, whose minute is no number, come first.
    """
    side = 1 << SIDE_BITS
    minute = F.col("log_minute").try_cast("bigint")
    spans = rows.groupBy(*_PART).agg(F.min(minute).alias("_lo"), F.max(minute).alias("_hi"))
    firms = rows.select("firm_name").distinct()
    place = F.row_number().over(Window.orderBy("firm_name")) - 1
    coded = firms.select("firm_name", (place * side / firms.agg(F.count(F.lit(1))).scalar()).cast("int").alias("_firm"))
    same = F.col("r.firm_name").eqNullSafe(F.col("c.firm_name"))
    # a row per table and per firm: sent to the rows, which a shuffle by table would heap in a task per table
    spans, coded = F.broadcast(spans.alias("s")), F.broadcast(coded.alias("c"))
    told = rows.alias("r").join(spans, [F.col(f"r.{p}").eqNullSafe(F.col(f"s.{p}")) for p in _PART], "left").join(coded, same, "left")
    at = F.floor((minute - F.col("_lo")) * side / (F.col("_hi") - F.col("_lo") + 1)).cast("int")
    z = _interleaved(F.coalesce(at, F.lit(0)), F.coalesce("_firm", F.lit(0)))
    return told.select(*[F.col(f"r.{c}") for c in rows.columns], z.alias("_z"))


def cluster(
    spark: SparkSession, base: str, target: str, file_rows: int = 5_000_000, group_bytes: int = 16 << 20,
    suffixes: list[str] | None = None,
) -> None:
    """Write the archive ``base``, or some of its tables, to ``target`` in Morton order.

    ``target`` is an archive of its own, to be put in place of the old one. ``file_rows`` and ``group_bytes``
    bound files and row groups. Rows are dealt by range, so a minute or a firm that
    holds much of the archive is shared out among files. A task writes one file after another of its
    range, so that small files do not make as many tasks and as many blocks of each map task.
    """
    rows = read_routed(spark, base, _PART).drop("writer", "run", "batch")
    if suffixes is not None:
        rows = rows.where(F.col("table_suffix").isin(*suffixes))
    tasks = max(1, -(-rows.count() // max(file_rows, TASK_ROWS)))
    order = [*_PART, "_z", "log_minute", "firm_name", "row_key"]
    dealt = morton(rows).repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("_z")
    marked = dealt.withColumns({"writer": F.lit("clustered"), "run": F.lit(0).cast("bigint"), "batch": F.lit(0).cast("bigint")})
    out = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("parquet.block.size", group_bytes)
    out.option("maxRecordsPerFile", file_rows).partitionBy(*_PART, "writer", "run", "batch").parquet(target)


def _file_in(files: set[str]) -> Column:
    """Whether a row's file is one of these: a test on names, by which the scan leaves files out unread."""
    return F.col("_metadata.file_path").isin(sorted(files))


def _slot(part: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(part), 64 - KEY_BITS)


def index_keys(spark: SparkSession, base: str, index: str, part: list[str] | None = None) -> int:
    """Add the files of the archive ``base`` that the index does not know; how many there were.

    A file's bitmap is a few rows of 64 bits: ``file, word, bits``. Files never change once
    written, so a run adds to the index and rewrites none of it.
    """
    rows = read_routed(spark, base, part or _PART)
    known = {r["file"] for r in _index(spark, index).select("file").distinct().collect()} if found(spark, index) else set()
    new = sorted(set(rows.inputFiles()) - known)
    if not new:
        return 0
    keys = (rows.where(~_file_in(known)) if known else rows).select(F.input_file_name().alias("file"), "row_key")
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.length("row_key") - 2, F.lit(1)))).alias("at")
    slots = keys.select("file", "row_key", at).select("file", _slot(F.substr("row_key", F.col("at"), F.lit(3))).alias("slot"))
    bits = slots.select("file", F.shiftright("slot", 6).cast("int").alias("word"), F.expr("shiftleft(1L, CAST(slot & 63 AS INT))").alias("bit"))
    words = bits.groupBy("file", "word").agg(F.bit_or("bit").alias("bits"))
    routed_upsert(words.withColumn("index_name", F.lit("keys")), index, batch=len(known), writer="keys")
    return len(new)


def _index(spark: SparkSession, index: str) -> DataFrame:
    return read_routed(spark, index).select("file", "word", "bits")


def ruled_out(spark: SparkSession, index: str, text: str) -> list[str]:
    """Files of the index that hold no row key with ``text``; none for a text below three letters."""
    parts = sorted({text[i : i + 3] for i in range(len(text) - 2)})
    if not parts:
        return []
    slots = spark.createDataFrame([(p,) for p in parts], "part string").select(_slot(F.col("part")).alias("slot")).distinct()
    wanted = slots.select(F.shiftright("slot", 6).cast("int").alias("word"), F.expr("shiftleft(1L, CAST(slot & 63 AS INT))").alias("bit"))
    need = wanted.groupBy("word").agg(F.bit_or("bit").alias("need"))
    held = _index(spark, index)
    full = held.join(need, "word").where("(bits & need) = need").groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    whole = full.where(F.col("n") == need.agg(F.count(F.lit(1))).scalar()).select("file")
    return [r["file"] for r in held.select("file").distinct().join(whole, "file", "left_anti").collect()]


def scan_containing(spark: SparkSession, base: str, index: str, text: str, part: list[str] | None = None) -> DataFrame:
    """Rows whose key contains ``text``, from the files that may hold one; files the index does not know are read."""
    parts = part or _PART
    rows = read_routed(spark, base, parts)
    out = set(ruled_out(spark, index, text)) if found(spark, index) else set()
    return (rows.where(~_file_in(out)) if out else rows).where(F.col("row_key").contains(text))
