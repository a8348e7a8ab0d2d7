"""The archive of raw records: building, writing layout and range scans."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgelog import layouts as L
from edgelog.functions.scalars import log_time, quoted
from edgelog.functions.times import DEFAULT_TZ, day_start_utc8, fmt_epoch, minute_text
from edgelog.operators.parse import evaluated, part_flagged, split_lines

_DAY = 86400
MALFORMED_SUFFIX = "malformed"


def _salt(line: Column, salts: int) -> Column:
    at = F.pmod(line, F.lit(salts)).cast("int") + 1
    return F.lit(L.SALT_ALPHABET).substr(at, F.lit(1))


def archive_row_key(df: DataFrame, salts: int = 10, tz: str = DEFAULT_TZ, form: str = "minute") -> Column:
    """Key of a vendor record. The ``plain`` form has no minute and no hashed file name."""
    salt = _salt(F.col("line_num").try_cast("bigint"), salts)
    line = F.col("line_num").cast("string")
    if form == "plain":
        return F.concat(salt, F.lit("#!"), "firm_name", F.lit("#"), "file_name", F.lit("#"), line)
    return F.concat(
        salt, F.lit("#!"), minute_text("time_unix", tz), F.lit("#!"), F.col("firm_name"),
        F.lit("#"), F.md5("file_name"), F.lit("#"), line,
    )


def _is_hot(time_col: str, as_of, hot_days: int) -> Column:
    now = F.unix_timestamp(F.current_timestamp()) if as_of is None else F.lit(as_of)
    return now - day_start_utc8(time_col) <= hot_days * _DAY


def table_suffix(time_col: str = "time_unix", as_of=None, hot_days: int = 30, tz: str = DEFAULT_TZ) -> Column:
    """Daily table while the log day is at most ``hot_days`` old, else the monthly one."""
    return F.when(_is_hot(time_col, as_of, hot_days), fmt_epoch(time_col, "yyyyMMdd", tz)).otherwise(
        fmt_epoch(time_col, "yyyyMM", tz)
    )


def with_table_suffix(df: DataFrame, as_of=None, hot_days: int = 30, tz: str = DEFAULT_TZ) -> DataFrame:
    return df.withColumn("table_suffix", table_suffix("time_unix", as_of, hot_days, tz))


def pack_cells(df: DataFrame, kind: str = "fusion") -> list[Column]:
    """The two quoted cells of a record."""
    cell = lambda names: quoted([F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names])
    return [cell(L.ARCHIVE_USER).alias("info"), cell(L.ARCHIVE_REST[kind]).alias("info1")]


def to_archive(
    df: DataFrame, salts: int = 10, as_of=None, hot_days: int = 30, tz: str = DEFAULT_TZ
) -> DataFrame:
    """Parsed vendor records as archive rows."""
    return df.select(
        archive_row_key(df, salts, tz).alias("row_key"),
        minute_text("time_unix", tz).alias("log_minute"),
        "firm_name",
        F.md5("file_name").alias("file_md5"),
        F.col("line_num").cast("string").alias("line_num"),
        *pack_cells(df),
        table_suffix("time_unix", as_of, hot_days, tz).alias("table_suffix"),
    )


def archive_lines(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Raw vendor lines as archive rows, and a quarantine of what has no key."""
    return part_flagged(archive_lines_flagged(df, **options), "archive")


def archive_lines_flagged(
    df: DataFrame, *, value: str = "value", salts: int = 10, as_of=None, hot_days: int = 30,
    tz: str = DEFAULT_TZ,
) -> DataFrame:
    """Archive rows of raw vendor lines, marked where a line has no key.

    A line of exactly 37 fields is archived by time. A longer one carries its raw data
    and the error that kept it from being parsed; it goes to a table of its own.
    """
    width = len(L.VENDOR_37)
    lines = df.select(F.col(value).cast("string").alias("_raw"))
    split = split_lines(lines, {"_raw": "_parts"}, keep_trailing=True)
    at = lambda i: F.try_element_at("_parts", F.lit(i + 1))
    fields = split.select(
        "_raw", F.coalesce(F.size("_parts"), F.lit(0)).alias("_n"),
        *[at(i).alias(n) for i, n in enumerate(L.VENDOR_37)],
        at(width).alias("_rawdata"), at(width + 1).alias("_error"),
    )
    line = F.col("line_num").try_cast("bigint")
    exact = F.col("_n") == width
    whole = F.col("time_unix").try_cast("bigint")
    seconds = F.when(log_time(whole).isNotNull(), whole)
    reason = (
        F.when((F.col("_n") != width) & (F.col("_n") < width + 2), F.lit("wrong number of fields"))
        .when(line.isNull(), F.lit("bad line_num"))
        .when(exact & seconds.isNull(), F.lit("bad time_unix"))
    )
    timed = fields.withColumns({"time_unix": seconds, "_reason": reason, "_exact": exact})
    # one time text and one hash per line: key, minute and table are cut from them
    once = evaluated(timed, _minute=minute_text("time_unix", tz), _md5=F.md5("file_name"), _salt=_salt(line, salts), _salt10=_salt(line, 10))
    key = F.concat("_salt", F.lit("#!"), "_minute", F.lit("#!"), "firm_name", F.lit("#"), "_md5", F.lit("#"), "line_num")
    malformed_key = F.concat("_salt10", F.lit("#!"), F.lit(L.MALFORMED_MINUTE), F.lit("#"), "_md5", F.lit("#"), "line_num")
    info, info1 = pack_cells(once)
    pick = lambda good, other: F.when(F.col("_exact"), good).otherwise(other)
    table = F.when(_is_hot("time_unix", as_of, hot_days), F.substring("_minute", 1, 8)).otherwise(F.substring("_minute", 1, 6))
    return once.select(
        "_raw", "_reason",
        pick(key, malformed_key).alias("row_key"),
        pick(F.col("_minute"), F.lit(L.MALFORMED_MINUTE)).alias("log_minute"),
        "firm_name",
        F.col("_md5").alias("file_md5"),
        "line_num",
        pick(info, F.lit(None)).alias("info"),
        pick(info1, quoted(["_rawdata", "_error"])).alias("info1"),
        pick(table, F.lit(MALFORMED_SUFFIX)).alias("table_suffix"),
    )


def minute_suffixes(from_min: str, to_min: str) -> list[str]:
    """Daily and monthly tables that can hold minutes in ``[from_min, to_min)``."""
    day = datetime.strptime(from_min[:8], "%Y%m%d")
    last = datetime.strptime(to_min, "%Y%m%d%H%M") - timedelta(minutes=1)
    out: set[str] = set()
    while day <= last:
        out |= {day.strftime("%Y%m%d"), day.strftime("%Y%m")}
        day += timedelta(days=1)
    return sorted(out)


def archive_scan(
    df: DataFrame, from_min: str, to_min: str, firm: str | None = None, suffixes: list[str] | None = None
) -> DataFrame:
    """Archived rows of minutes ``[from_min, to_min)``, from daily and late monthly tables.

    The table suffix is the partition column, so only those folders are read.
    """
    tables = minute_suffixes(from_min, to_min) if suffixes is None else suffixes
    rows = df.where(
        F.col("table_suffix").isin(*tables)
        & (F.col("log_minute") >= from_min)
        & (F.col("log_minute") < to_min)
    )
    return rows if firm is None else rows.where(F.col("firm_name") == firm)


def archive_tables(df: DataFrame, suffixes: list[str]) -> DataFrame:
    """Rows of several tables of one archive in one scan of just those folders."""
    return df.where(F.col("table_suffix").isin(*suffixes))


def archive_union(daily: DataFrame, late: DataFrame) -> DataFrame:
    """Rows of a daily table and of the monthly table that took its late arrivals, where
    these are frames of their own; of one archive take :func:`archive_tables`."""
    return daily.unionByName(late)


def archive_key_contains(df: DataFrame, text: str) -> DataFrame:
    return df.where(F.col("row_key").contains(text))


def archive_firm_count(df: DataFrame) -> DataFrame:
    return df.groupBy("firm_name").agg(F.count(F.lit(1)).alias("n"))
