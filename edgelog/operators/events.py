"""Records as event documents, and time slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("foo", T.StringType()),
        T.StructField("bar", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)
# The columns an access record is stored with as an event.
LOG_EVENT_COLUMNS = ["firm_name", "response_time", "domain", "body_bytes_sent", "time_local"]


def serialise(df: DataFrame, form: str, columns: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Events as ``json``, ``nested`` JSON or ``csv`` text in column ``event``.

    The nested form of a sample event groups its data and its position; an access record
    nests nothing.
    """
    names = columns or EVENT_SCHEMA.names
    flat = F.struct(*names)
    if form == "json":
        text = F.to_json(flat)
    elif form == "nested":
        shaped = (
            F.struct(
                "ts", F.struct("foo", "bar").alias("data"), F.struct("lat", "lon").alias("geo")
            )
            if columns is None
            else flat
        )
        text = F.to_json(shaped)
    elif form == "csv":
        text = F.to_csv(flat)
    else:
        raise ValueError(f"unknown form {form!r}")
    return df.select(text.alias("event"), *(keep or []))


def read_events(df: DataFrame, column: str = "event") -> DataFrame:
    """Sample events back from their flat JSON."""
    return df.select(F.from_json(column, EVENT_SCHEMA).alias("e")).select("e.*")


def slices_of(df: DataFrame, start: str, end: str, step: int, keep: list[str] | None = None) -> DataFrame:
    """Cut ``[start, end)`` of each row into steps, the last one shorter if need be."""
    cut = df.where(F.col(start) < F.col(end)).select(
        *(keep or []),
        F.col(end).alias("_end"),
        F.explode(F.sequence(F.col(start), F.col(end) - 1, F.lit(step).cast("bigint"))).alias("slice_from"),
    )
    return cut.select(
        *(keep or []), "slice_from", F.least(F.col("slice_from") + step, "_end").alias("slice_to")
    )


def time_slices(spark: SparkSession, start: int, end: int, step: int) -> DataFrame:
    """Slices of one range."""
    return spark.range(start, end, step).select(
        F.col("id").alias("slice_from"), F.least(F.col("id") + step, F.lit(end)).alias("slice_to")
    )
