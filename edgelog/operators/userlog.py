"""Per-domain user log packages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgelog import layouts as L
from edgelog.functions.scalars import quoted

# A field longer than the limit is cut to the shorter length.
_LIMIT, _CUT = 40, 30


def export_field(name: str, limit: int | None = _LIMIT, cut: int = _CUT) -> Column:
    """A field up to its first slash; ``-`` where that leaves nothing to read.

    The format cuts a field of more than ``limit`` characters to ``cut``; None never cuts.
    """
    text = F.coalesce(F.col(name).cast("string"), F.lit("-"))
    head = F.substring_index(text, "/", 1)
    out = F.when(text.startswith("/") & text.rlike("^/+$"), F.lit("-"))
    if limit is not None:
        out = out.when(F.length(head) > limit, F.substring(head, 1, cut))
    return out.otherwise(head)


def export_key(name: str = "domain") -> Column:
    """The domain without path and port."""
    domain = F.coalesce(F.col(name), F.lit("-"))
    bare = F.when(F.instr(domain, "/") > 1, F.substring_index(domain, "/", 1)).otherwise(domain)
    return F.when(F.instr(bare, ":") > 1, F.substring_index(bare, ":", 1)).otherwise(bare)


def user_log_lines(df: DataFrame, keep: list[str] | None = None, limit: int | None = _LIMIT, cut: int = _CUT) -> DataFrame:
    """Package line of each record under the key of its domain; ``limit`` None keeps fields whole."""
    return df.select(
        export_key().alias("domain"),
        quoted([export_field(n, limit, cut) for n in L.USER_LINE_FIELDS]).alias("value"),
        *(keep or []),
    )


def sorted_lines(df: DataFrame, order: list[str]) -> DataFrame:
    return df.orderBy(*order)
