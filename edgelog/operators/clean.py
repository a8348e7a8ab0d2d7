"""Typed measures of parsed records, and quarantine for those that have none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelog.functions.scalars import dash_to_zero, finite, log_time, text_or_zero
from edgelog.functions.times import floor_to
from edgelog.operators.parse import part_flagged


def _has(df: DataFrame, name: str) -> bool:
    return name.lower() in (c.lower() for c in df.columns)


def _source(df: DataFrame, name: str) -> Column:
    """The column, or the stand-in for a field the layout does not carry.

    Numbers stay numbers, so typed input is not turned into text and back.
    """
    found = {f.name.lower(): f.dataType for f in df.schema.fields}.get(name.lower())
    if found is None:
        return F.lit("0")
    if isinstance(found, T.NumericType):
        return F.coalesce(F.col(name), F.lit(0).cast(found))
    return text_or_zero(name)


def _flag(df: DataFrame, typed: dict[str, Column], with_time: bool) -> DataFrame:
    """Replace columns by typed forms; mark rows where one of them failed."""
    reason = F.col("_reason") if _has(df, "_reason") else F.lit(None).cast("string")
    for name, value in typed.items():
        reason = F.coalesce(reason, F.when(value.isNull(), F.lit(f"bad {name}")))
    if not _has(df, "_raw"):
        df = df.withColumn("_raw", F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    typed = {**typed, "_reason": reason}
    if with_time:
        typed["@timestamp"] = F.unix_millis(F.current_timestamp())
    return df.withColumns(typed)


def clean_band_flagged(df: DataFrame, with_ingest_time: bool = False) -> DataFrame:
    typed = {"time_unix": log_time(_source(df, "time_unix")), "body_bytes_sent": finite(_source(df, "body_bytes_sent"))}
    return _flag(df, typed, with_ingest_time)


def clean_band(df: DataFrame, layout: str = "band", **options) -> tuple[DataFrame, DataFrame]:
    """Time and size as numbers, which is all a rollup needs."""
    return part_flagged(clean_band_flagged(df, **options), layout)


def clean_detail_flagged(df: DataFrame, with_ingest_time: bool = False) -> DataFrame:
    when = log_time(_source(df, "time_unix"))
    typed = {
        "time_unix": when,
        "time_mt": floor_to(when, 60),
        "body_bytes_sent": finite(_source(df, "body_bytes_sent")),
        "http_status": _source(df, "http_status").try_cast("int"),
        "response_time": dash_to_zero(_source(df, "response_time")),
        "p_response_time": dash_to_zero(_source(df, "p_response_time")),
        "p_response_length": dash_to_zero(_source(df, "p_response_length")),
    }
    return _flag(df, typed, with_ingest_time)


def clean_detail(df: DataFrame, layout: str = "detail", **options) -> tuple[DataFrame, DataFrame]:
    """All numeric fields of a detail record; ``-`` counts as 0 in the timings."""
    return part_flagged(clean_detail_flagged(df, **options), layout)
