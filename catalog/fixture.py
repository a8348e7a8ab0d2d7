"""Access-log tables derived from the driver's ``events`` table.

The column texts are valid in Spark SQL and in DuckDB, so both sides of a check start
from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edgelog import layouts as L

SEP = L.FIELD_SEP

# name -> expression over events
LOG = {
    "line_num": "event_id",
    "time_unix": "1704067200 + (event_id % 4) * 3600 + (event_id * 7) % 300",
    "firm_name": "CASE user_id % 4 WHEN 0 THEN 'BS' WHEN 1 THEN 'WS' WHEN 2 THEN 'VC' ELSE 'UP' END",
    "layer": "CAST(user_id % 3 AS STRING)",
    "domain": "'d' || CAST(user_id % 6 AS STRING)"
    " || CASE WHEN user_id % 6 = 5 THEN '.media.test' ELSE '.example.com' END",
    "request": "'/v/' || CAST(event_id % 50 AS STRING)",
    "method": "'GET'",
    "protocol": "'HTTP/1.1'",
    "clientip": "'10.0.' || CAST(user_id % 256 AS STRING) || '.' || CAST(event_id % 256 AS STRING)",
    "prov": "'p' || CAST(user_id % 2 AS STRING)",
    "ISP": "'isp' || CAST(user_id % 2 AS STRING)",
    "hit_status": "CASE WHEN event_type IN ('view', 'click') THEN 'HIT' ELSE 'MISS' END",
    "http_status": "CASE event_type WHEN 'view' THEN '200' WHEN 'purchase' THEN '206'"
    " WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN '304' ELSE '200' END"
    " WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN '401' WHEN 1 THEN '403' ELSE '404' END"
    " ELSE CAST(500 + event_id % 5 AS STRING) END",
    "body_bytes_sent": "CASE WHEN event_id % 97 = 0 THEN '-'"
    " ELSE CAST(CAST(floor(value * 1000) AS BIGINT) AS STRING) END",
    "response_time": "CASE WHEN event_id % 10 = 0 THEN '-' ELSE CAST(event_id % 1000 AS STRING) END",
    "user_agent": "CASE WHEN event_id % 9 = 0 THEN '/'"
    " ELSE 'Mozilla/5.0 (agent ' || CAST(user_id AS STRING) || ')' END",
    "referer": "'-'",
    "host": "'edge' || CAST(user_id % 8 AS STRING)",
    "file_name": "'f' || CAST(user_id % 5 AS STRING) || '_d' || CAST(user_id % 6 AS STRING)"
    " || '_20240101000000_X.access'",
    "def1": "'-'",
    "X_Info_request_id": "md5(CAST(event_id AS STRING))",
    "time_local": "'01/Jan/2024:' || lpad(CAST(8 + event_id % 4 AS STRING), 2, '0') || ':'"
    " || lpad(CAST(CAST(floor(((event_id * 7) % 300) / 60) AS BIGINT) AS STRING), 2, '0') || ':'"
    " || lpad(CAST((event_id * 7) % 60 AS STRING), 2, '0') || ' +0800'",
}

# Wire fields the log does not carry; some are empty on some lines.
_WIRE = {
    "time_unix": "CAST(time_unix AS STRING)",
    "line_num": "CAST(line_num AS STRING)",
    "X_Info_Fetcher": "CASE WHEN line_num % 5 = 0 THEN '' ELSE 'fetch' END",
    "city": "CASE WHEN line_num % 3 = 0 THEN '' ELSE 'c' || CAST(line_num % 3 AS STRING) END",
    "country": "'CN'",
    "hit_status_whole": "hit_status",
    "p_response_length": "CASE WHEN line_num % 4 = 0 THEN '-' ELSE CAST(line_num % 512 AS STRING) END",
    "p_response_time": "CASE WHEN line_num % 6 = 0 THEN '-' ELSE CAST(line_num % 64 AS STRING) END",
    "rawdata": "CASE WHEN line_num % 7 = 0 THEN 'raw' ELSE '' END",
    "except_desc": "CASE WHEN line_num % 14 = 0 THEN 'err' ELSE '' END",
    "peak": "''",
}


def _wire_field(name: str) -> str:
    if name in _WIRE:
        return _WIRE[name]
    return name if name in LOG else "'-'"


def wire_sql(names: list[str], sep: str = SEP) -> str:
    """A line of the given fields."""
    return f"concat_ws('{sep}', {', '.join(_wire_field(n) for n in names)})"


def ragged_sql(names: list[str]) -> str:
    """The same, every 101st line ending after 20 fields."""
    return (
        f"CASE WHEN line_num % 101 = 0 THEN {wire_sql(names[:20])} ELSE {wire_sql(names)} END"
    )


def quoted_sql(names: list[str]) -> str:
    parts = ", ".join(_wire_field(n) for n in names)
    return f"""'"' || concat_ws('" "', {parts}) || '"'"""


# Minute text of a log row at UTC+8; the log covers one morning.
MINUTE_SQL = (
    "'20240101' || lpad(CAST(8 + line_num % 4 AS STRING), 2, '0')"
    " || lpad(CAST(CAST(floor(((line_num * 7) % 300) / 60) AS BIGINT) AS STRING), 2, '0')"
)
ROW_KEY_SQL = (
    f"substr('0123456789', CAST(line_num % 10 + 1 AS INT), 1) || '#!' || {MINUTE_SQL} || '#!'"
    " || firm_name || '#' || md5(file_name) || '#' || CAST(line_num AS STRING)"
)
# Daily table, or the monthly one for every 11th record as if it had come late.
SUFFIX_SQL = "CASE WHEN line_num % 11 = 0 THEN '202401' ELSE '20240101' END"
ARCHIVE = {
    "row_key": ROW_KEY_SQL,
    "log_minute": MINUTE_SQL,
    "firm_name": "firm_name",
    "file_md5": "md5(file_name)",
    "line_num": "CAST(line_num AS STRING)",
    "info": quoted_sql(L.ARCHIVE_USER),
    "table_suffix": SUFFIX_SQL,
}


def _archive(kind: str) -> dict[str, str]:
    return {**ARCHIVE, "info1": quoted_sql(L.ARCHIVE_REST[kind])}


def _select(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM {source}"


# ---- DuckDB side -------------------------------------------------------------------


def with_log(query: str, **ctes: str) -> str:
    """``query`` over the log, with further named tables before it."""
    tables = {"log": _select(LOG, "events"), **ctes}
    return "WITH " + ", ".join(f"{n} AS ({t})" for n, t in tables.items()) + " " + query


def archive_sql(kind: str = "fusion") -> str:
    return _select(_archive(kind), "log")


# ---- Spark side --------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in LOG.items()])


def lines(spark: SparkSession, sf_dir: str, names: list[str], ragged: bool = True) -> DataFrame:
    text = ragged_sql(names) if ragged else wire_sql(names)
    return log(spark, sf_dir).selectExpr(f"{text} AS value")


def archive(spark: SparkSession, sf_dir: str, kind: str = "fusion") -> DataFrame:
    return log(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in _archive(kind).items()])
