"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgelog.functions.scalars import text_or_zero

# The standing retention policy.
OK_STATUSES = ("200", "206", "304")
KEPT_LAYERS = ("0", "1")


def keep_policy(
    df: DataFrame, ok=OK_STATUSES, layers=KEPT_LAYERS, domain_substr: str | None = None
) -> DataFrame:
    """Keep every failure, and successes of the given layers or of domains with the given text."""
    status, layer = text_or_zero("http_status"), text_or_zero("layer")
    kept = ~status.isin(*ok) | layer.isin(*layers)
    if domain_substr:
        kept |= text_or_zero("domain").contains(domain_substr)
    return df.where(kept)


def time_range(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows with ``start <= column < end``."""
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def in_list(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose column is in a short list, or in the one column of a frame.

    The engine broadcasts the frame where its shuffled bytes are below its threshold.
    """
    if isinstance(values, DataFrame):
        name = values.columns[0]
        wanted = values.select(F.col(name).alias(column)).distinct()
        return df.join(wanted, column, "left_semi")
    return df.where(F.col(column).isin(*values))


def line_contains(df: DataFrame, text: str, value: str = "value") -> DataFrame:
    return df.where(F.col(value).contains(text))
