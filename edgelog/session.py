"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM does not compile methods above 8000 bytes; wide log records exceed that when
    # a whole stage becomes one method, so such stages run operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rankings keep up to 2000 rows per domain; the stock limit of 1000 would turn the
    # early per-group cut off for them.
    "spark.sql.optimizer.windowGroupLimitThreshold": "5000",
}


def build_session(app: str = "edgelog", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_METHOD_KEY = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Inside, methods too long for the JVM to compile are not generated, whatever the session's limit; a lower one stays."""
    before = spark.conf.get(_METHOD_KEY)
    spark.conf.set(_METHOD_KEY, str(min(int(before), int(DEFAULTS[_METHOD_KEY]))))
    try:
        yield
    finally:
        spark.conf.set(_METHOD_KEY, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can write to, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
    own = tempfile.mkdtemp(prefix="edgelog-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own
