from __future__ import annotations

import math


def rows(df, cols=None) -> list[tuple]:
    """Rows of a frame as sorted tuples in column-name order."""
    names = sorted(cols or df.columns)
    return sorted((tuple(_plain(r[c]) for c in names) for r in df.select(*names).collect()), key=repr)


def _plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")
