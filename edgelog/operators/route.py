"""Document ids and the index each record belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgelog import layouts as L
from edgelog.functions.scalars import text_or_zero
from edgelog.functions.times import DEFAULT_TZ, fmt_epoch

# Fixed value: rollups older than this many seconds go to an error index.
MAX_AGE = 2592000


def with_row_id(df: DataFrame, kind: str) -> DataFrame:
    """Id of a detail record: request and layer, or file and line."""
    first, second = {
        "jx": ("X_Info_request_id", "layer"),
        "fusion": ("file_name", "line_num"),
    }[kind]
    row_id = F.concat_ws("-", text_or_zero(first), text_or_zero(second))
    if kind == "jx":
        df = df.withColumn("checkd", row_id)
    return df.withColumn("id", row_id)


def route_detail(df: DataFrame, kind: str, tz: str = DEFAULT_TZ, prefix: str | None = None) -> DataFrame:
    """Add ``index_name`` and ``index_type``; a vendor file name without a day has neither.

    ``prefix`` starts the index name in place of the one the kind has by default.
    """
    firm = F.lower(text_or_zero("firm_name"))
    if kind == "jx":
        name = F.concat(F.lit(prefix or L.INDEX_JX_DETAIL), firm, F.lit("-"), fmt_epoch("time_unix", "yyyy.MM", tz))
    elif kind == "fusion":
        parts = F.split(F.regexp_replace("file_name", "_+$", ""), "_")
        stamp = F.try_element_at(parts, F.lit(3))
        name = F.when(
            (F.size(parts) > 3) & (F.length(stamp) > 8),
            F.concat(F.lit(prefix or L.INDEX_FUSION_DETAIL), firm, F.lit("-"), F.substring(stamp, 1, 8)),
        )
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return df.withColumns(
        {"index_name": name, "index_type": F.when(name.isNotNull(), F.lit(L.TYPE_DETAIL))}
    )


def _epoch(as_of) -> Column:
    if as_of is None:
        return F.unix_timestamp(F.current_timestamp())
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def route_band(
    df: DataFrame, prefix: str, index_type: str, as_of=None, tz: str = DEFAULT_TZ
) -> DataFrame:
    """Daily index of a rollup, or the error index once it is too old at ``as_of``."""
    late = (_epoch(as_of) - F.col("from_time")) > MAX_AGE
    day = F.when(late, F.lit("error")).otherwise(fmt_epoch("from_time", "yyyy.MM.dd", tz))
    return df.withColumns(
        {"index_name": F.concat(F.lit(prefix), day), "index_type": F.lit(index_type)}
    )


def route_host(df: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Monthly index of a host count, from its ``log_date`` in milliseconds."""
    month = fmt_epoch(F.col("log_date") / 1000, "yyyy.MM", tz)
    return df.withColumns(
        {
            "index_name": F.concat(F.lit(L.INDEX_HOST), month),
            "index_type": F.lit(L.TYPE_BAND_JX),
        }
    )


def route_rank(df: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Monthly index of a URL rank."""
    month = fmt_epoch("time_unix", "yyyy.MM", tz)
    return df.withColumns(
        {"index_name": F.concat(F.lit(L.INDEX_RANK), month), "index_type": F.lit("urlrank")}
    )


def with_doc_id(df: DataFrame, tag, key: str = "id") -> DataFrame:
    """Make ``key`` unique to the batch ``tag``, so that a repeated batch lands on itself."""
    mark = F.coalesce(F.col(tag) if isinstance(tag, str) else tag, F.lit("0"))
    return df.withColumn(key, F.md5(F.concat(mark, F.lit("##"), text_or_zero(key))))


def with_rank_doc_id(df: DataFrame, tag, whole: bool = False) -> DataFrame:
    """Batch-unique id of a URL rank: hash of tag and hash of id, or one hash of both."""
    mark = F.col(tag) if isinstance(tag, str) else tag
    if whole:
        doc = F.md5(F.concat(mark, F.lit("##"), F.col("id")))
    else:
        doc = F.concat_ws("-", F.md5(mark), F.md5("id"))
    return df.withColumn("id", doc)


def batch_tag(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Tags of the batches in ``df``, from broker columns ``partition`` and ``offset``.

    ``batch_tag`` names the lowest partition and its lowest offset, ``batch_tag_all``
    every partition. Rows are first reduced to one per partition.
    """
    keys = by or []
    starts = df.groupBy(*keys, "partition").agg(F.min("offset").alias("offset"))
    text = lambda s: F.concat_ws("-", s["partition"].cast("string"), s["offset"].cast("string"))
    pair = F.struct("partition", "offset")
    return starts.groupBy(*keys).agg(
        text(F.min(pair)).alias("batch_tag"),
        F.concat(
            F.array_join(F.transform(F.array_sort(F.collect_list(pair)), text), ";"), F.lit(";")
        ).alias("batch_tag_all"),
    )


def dim_hash_id(df: DataFrame, keys: list[str] = L.FUSION_KEYS, prefix: str = "") -> DataFrame:
    """Hash of the grouping keys, ``-`` standing for a missing one."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys]
    return df.withColumn("id", F.md5(F.concat(F.lit(prefix), *parts)))
