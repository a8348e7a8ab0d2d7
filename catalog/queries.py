"""Every checked query: the Spark form and, where SQL can say it, the same in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixture as fx
from edgelog import layouts as L
from edgelog.functions import scalars as sc
from edgelog.functions import times as tm
from edgelog.operators import archive as arc
from edgelog.operators import band, check, clean, events, filters, parse, rank, recommend, route, userlog
from edgelog.plans import jobs
from edgelog.sources import readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- SQL building blocks -----------------------------------------------------------

TOTAL = "CAST(coalesce(sum(CAST(body_bytes_sent AS BIGINT)), 0) AS DOUBLE)"
GOOD = "body_bytes_sent <> '-'"
MINUTE = "time_unix - time_unix % 60"
FIVE = "time_unix - time_unix % 300"
HOUR = "time_unix - time_unix % 3600"


def local(seconds: str, fmt: str) -> str:
    """Epoch as text at UTC+8."""
    return f"strftime(make_timestamp(CAST(({seconds}) * 1000000 AS BIGINT)) + INTERVAL 8 HOUR, '{fmt}')"


def layout_sql(names: list[str], parts: str = "p", empty_is_missing: bool = False) -> str:
    get = [f"{parts}[{i}]" for i in range(1, len(names) + 1)]
    if empty_is_missing:
        get = [f"nullif({g}, '')" for g in get]
    return ", ".join(f"{g} AS {n}" for g, n in zip(get, names))


def parts_cte(names: list[str], ragged: bool = True) -> str:
    text = fx.ragged_sql(names) if ragged else fx.wire_sql(names)
    return (
        "SELECT value, string_split(regexp_replace(value, '(@##@)+$', ''), '@##@') AS p "
        f"FROM (SELECT {text} AS value FROM log)"
    )


def parsed_sql(names: list[str], **options) -> str:
    return fx.with_log(f"SELECT {layout_sql(names, **options)} FROM l", l=parts_cte(names))


def band_sql(keys: list[str], bucket: str, prefix: str, extra: str = "", where: str = GOOD) -> str:
    cols = ", ".join(keys)
    row_key = f"concat_ws('|', '{prefix}', {cols}, CAST({bucket} AS STRING))"
    return (
        f"SELECT {cols}, {bucket} AS from_time, ({bucket}) * 1000 AS log_date, count(*) AS req_count, "
        f"{TOTAL} AS traffic, {TOTAL} AS traffic_pm, {row_key} AS id{extra} "
        f"FROM log WHERE {where} GROUP BY {cols}, {bucket}"
    )


SIZE = "CASE WHEN body_bytes_sent = '-' THEN 0 ELSE CAST(body_bytes_sent AS BIGINT) END"
COUNTERS = ", ".join(
    f"CAST(count(*) FILTER (http_status = '{s}') AS DOUBLE) AS req{s}" for s in L.ERROR_STATUSES
)
ERRORS = ", ".join(f"'{s}'" for s in L.ERROR_STATUSES)
URLS = (
    f"SELECT md5(domain || request || CAST({HOUR} AS STRING)) AS id, {HOUR} AS time_unix, domain, request, "
    f"CAST(sum({SIZE}) AS DOUBLE) AS traffic, CAST(count(*) AS DOUBLE) AS req_count, "
    "CAST(0 AS DOUBLE) AS downloadnum, "
    f"CAST(count(*) FILTER (http_status IN ({ERRORS})) AS DOUBLE) AS req_error, {COUNTERS} "
    f"FROM log GROUP BY {HOUR}, domain, request"
)


def top_sql(metric: str, n: int) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY {metric} DESC, id DESC) AS rn "
        f"FROM urls) WHERE rn <= {n}"
    )


# ---- sources -----------------------------------------------------------------------

@query(
    "src_multi_topic",
    fx.with_log(
        f"SELECT {fx.wire_sql(L.VENDOR_37)} AS value, 'vendor' AS topic FROM log "
        f"UNION ALL SELECT {fx.wire_sql(L.OWN_45)}, 'own' FROM log"
    ),
)
def _(spark, sf):
    return readers.union_topics(
        {"vendor": fx.lines(spark, sf, L.VENDOR_37, False), "own": fx.lines(spark, sf, L.OWN_45, False)}
    )


_STORED = {
    "storage_day": "'202401' || lpad(CAST(1 + line_num % 5 AS STRING), 2, '0')",
    "log_hour": "'20240101' || lpad(CAST(8 + line_num % 4 AS STRING), 2, '0')",
}


@query(
    "src_lagged_days",
    fx.with_log(
        f"SELECT * FROM (SELECT line_num, request, {', '.join(f'{e} AS {n}' for n, e in _STORED.items())} FROM log) "
        "WHERE storage_day IN ('20240101', '20240102', '20240103') AND log_hour = '2024010109'"
    ),
)
def _(spark, sf):
    stored = fx.log(spark, sf).selectExpr("line_num", "request", *[f"{e} AS {n}" for n, e in _STORED.items()])
    return readers.lagged(stored, "2024010109", 2)


@query(
    "src_text_lines",
    "SELECT doc_id, CAST(generate_subscripts(p, 1) AS BIGINT) AS line_no, unnest(p) AS value "
    "FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)",
)
def _(spark, sf):
    return readers.text_records(_table(spark, sf, "documents"), "text", ["doc_id"])


@query(
    "src_quoted_lines",
    fx.with_log(
        "SELECT value, CAST(len(p) AS BIGINT) AS n_fields, p[4] AS method, p[5] AS domain FROM "
        f"(SELECT value, string_split(value, '\" \"') AS p FROM (SELECT {fx.quoted_sql(L.ARCHIVE_USER)} AS value FROM log))"
    ),
)
def _(spark, sf):
    text = fx.log(spark, sf).selectExpr(f"{fx.quoted_sql(L.ARCHIVE_USER)} AS value")
    return readers.quoted_fields(text).selectExpr(
        "value", "CAST(size(fields) AS BIGINT) AS n_fields", "fields[3] AS method", "fields[4] AS domain"
    )


_FROM, _TO = "202401010802", "202401011003"
_RANGE = f"log_minute >= '{_FROM}' AND log_minute < '{_TO}'"


@query("archive_range", fx.with_log(f"SELECT * FROM a WHERE {_RANGE}", a=fx.archive_sql()))
def _(spark, sf):
    return arc.archive_scan(fx.archive(spark, sf), _FROM, _TO)


@query("archive_firm", fx.with_log(f"SELECT * FROM a WHERE {_RANGE} AND firm_name = 'WS'", a=fx.archive_sql()))
def _(spark, sf):
    return arc.archive_scan(fx.archive(spark, sf), _FROM, _TO, firm="WS")


@query("archive_substring", fx.with_log("SELECT * FROM a WHERE row_key LIKE '%0#!BS#%'", a=fx.archive_sql()))
def _(spark, sf):
    return arc.archive_key_contains(fx.archive(spark, sf), "0#!BS#")


_T0, _T1 = 1704067260, 1704074460


@query(
    "index_range_project",
    fx.with_log(f"SELECT {', '.join(L.USER_LOG_COLUMNS)} FROM log WHERE time_unix >= {_T0} AND time_unix < {_T1}"),
)
def _(spark, sf):
    return readers.user_log_source(fx.log(spark, sf), _T0, _T1)


@query(
    "band_range",
    fx.with_log(
        f"SELECT * FROM b WHERE from_time >= {_T0} AND from_time < {_T1}", b=band_sql(L.JX_KEYS, FIVE, "m5")
    ),
)
def _(spark, sf):
    good, _ = clean.clean_band(fx.log(spark, sf))
    return filters.time_range(band.band(good, L.JX_KEYS, 300), "from_time", _T0, _T1)


_JX_INDEX = f"'nginx-' || lower(firm_name) || '-' || {local('time_unix', '%Y.%m')}"


@query(
    "index_wildcard",
    fx.with_log(
        "SELECT * FROM i WHERE index_name LIKE 'nginx-%s-2024.01' OR index_name = 'nginx-vc-2024.01'",
        i=f"SELECT line_num, {_JX_INDEX} AS index_name, 'fluentd' AS index_type FROM log",
    ),
)
def _(spark, sf):
    routed = route.route_detail(fx.log(spark, sf), "jx").select("line_num", "index_name", "index_type")
    return readers.index_wildcard(routed, ["nginx-*s-2024.01", "nginx-vc-2024.01"])


# ---- parse jobs --------------------------------------------------------------------

def _layout_query(key: str, layout: str, tag: str | None = None) -> None:
    names = L.LAYOUTS[layout]
    sql = parsed_sql(names, empty_is_missing=layout in L.EMPTY_IS_MISSING)
    if tag:
        sql = sql.replace(" FROM l", f", '{tag}' AS offset_tag FROM l")

    @query(key, sql)
    def _(spark, sf):
        return parse.parse_lines(fx.lines(spark, sf, names), layout, batch_tag=tag)[0]


_layout_query("parse_common34", "common34")
_layout_query("parse_fusion_detail", "fusion_detail39")
_layout_query("parse_fusion_band", "fusion_band37", "0-17")
_layout_query("parse_jx_detail", "jx_detail45")
_layout_query("parse_jx_band", "jx_band45", "0-17")
_layout_query("parse_unified46", "unified46")
_layout_query("parse_unified38", "unified_band38")


def _cells(kind: str) -> str:
    strip = lambda c: f"""string_split(regexp_replace({c}, '^"|"$', '', 'g'), '" "')"""
    return f"SELECT {strip('info')} AS u, {strip('info1')} AS r FROM ({fx.archive_sql(kind)})"


def _cell_columns(kind: str) -> str:
    return layout_sql(L.ARCHIVE_USER, "u") + ", " + layout_sql(L.ARCHIVE_REST[kind], "r")


@query("parse_archive_jx", fx.with_log(f"SELECT {_cell_columns('jx')} FROM c", c=_cells("jx")))
def _(spark, sf):
    return parse.parse_archive(fx.archive(spark, sf, "jx"), "jx")[0]


@query(
    "parse_archive_fusion",
    fx.with_log(
        f"SELECT {', '.join(L.ARCHIVE_BAND)} FROM (SELECT {_cell_columns('fusion')} FROM c)", c=_cells("fusion")
    ),
)
def _(spark, sf):
    return parse.parse_archive(fx.archive(spark, sf), "fusion")[0]


# Vendor lines, every 13th with three fields more.
_SQL42_LINE = (
    f"CASE WHEN line_num % 13 = 0 THEN {fx.wire_sql(L.VENDOR_37)} || '@##@x@##@raw@##@err' "
    f"ELSE {fx.wire_sql(L.VENDOR_37)} END"
)
_STAMP = "string_split(file_name, '_')[3]"


def _sql42_columns(month: str = "202401") -> str:
    fields = ", ".join(
        f"CAST({fx._wire_field(n)} AS BIGINT) AS {n}" if n == "body_bytes_sent" else f"{fx._wire_field(n)} AS {n}"
        for n in L.VENDOR_37
    )
    return (
        f"{fields}, md5(file_name || '-' || CAST(line_num AS STRING)) AS id, "
        f"CASE WHEN substr({_STAMP}, 1, 6) = '{month}' THEN substr({_STAMP}, 1, 8) || '-1' "
        f"ELSE substr({_STAMP}, 1, 8) END AS filetime, lower(firm_name) AS lowfirmname, "
        "CASE WHEN line_num % 13 = 0 THEN 'raw' ELSE '' END AS rawdata, "
        "CASE WHEN line_num % 13 = 0 THEN 'err' ELSE '' END AS except_desc"
    )


def _sql42_lines(spark, sf):
    return fx.log(spark, sf).selectExpr(f"{_SQL42_LINE} AS value")


@query("parse_sql42", fx.with_log(f"SELECT {_sql42_columns()} FROM log WHERE {GOOD}"))
def _(spark, sf):
    return parse.parse_sql42(_sql42_lines(spark, sf), suffix_month="202401")[0]


@query(
    "sql42_derived",
    fx.with_log(
        f"SELECT line_num, file_name, md5(file_name || '-' || CAST(line_num AS STRING)) AS id, "
        f"substr({_STAMP}, 1, 8) AS filetime, lower(firm_name) AS lowfirmname FROM log"
    ),
)
def _(spark, sf):
    return fx.log(spark, sf).select("line_num", "file_name", *parse.sql42_columns())


@query(
    "parse_druid_event",
    fx.with_log(
        "SELECT time_unix AS at, domain, firm_name, CAST(body_bytes_sent AS BIGINT) AS body_bytes_sent, "
        f"CAST(line_num AS STRING) AS line_num FROM log WHERE {GOOD}"
    ),
)
def _(spark, sf):
    good, _ = parse.druid_events(_sql42_lines(spark, sf))
    return good.select(
        F.unix_seconds("time_local").alias("at"), "domain", "firm_name", "body_bytes_sent", "line_num"
    )


@query(
    "parse_rank_positional",
    fx.with_log(
        f"SELECT time_unix, domain, request, http_status, CAST({SIZE} AS DOUBLE) AS body_bytes_sent "
        "FROM log WHERE line_num % 101 <> 0"
    ),
)
def _(spark, sf):
    return parse.rank_input(fx.lines(spark, sf, L.VENDOR_34))[0]


_PREAGG_LINE = "concat_ws(' ', domain, request, body_bytes_sent, '1', '0', CAST(line_num % 3 AS STRING), http_status)"


@query(
    "parse_preagg",
    fx.with_log(
        "SELECT domain, request, body_bytes_sent AS traffic, '1' AS req_count, '0' AS downloadnum, "
        "CAST(line_num % 3 AS STRING) AS status_count, http_status AS status FROM log"
    ),
)
def _(spark, sf):
    return parse.parse_lines(fx.log(spark, sf).selectExpr(f"{_PREAGG_LINE} AS value"), "preagg7", sep=" ")[0]


@query(
    "parse_package",
    fx.with_log(
        "SELECT X_Info_request_id, layer, p[33] AS time_local, CAST(time_unix AS STRING) AS time_unix, body, "
        "X_Info_request_id || '-' || layer AS id, 'pkg' AS index_name, 'day' AS index_type FROM "
        f"(SELECT *, string_split(body, '\" \"') AS p FROM (SELECT *, {fx.quoted_sql(L.ARCHIVE_REST['jx'])} || '<<>>' || "
        f"{fx.quoted_sql(L.ARCHIVE_USER)} AS body FROM log))"
    ),
)
def _(spark, sf):
    text = fx.log(spark, sf).selectExpr(
        f"{fx.quoted_sql(L.ARCHIVE_REST['jx'])} || '<<>>' || {fx.quoted_sql(L.ARCHIVE_USER)} AS value"
    )
    return parse.package_lines(text, index_name="pkg", index_type="day")


@query("parse_row_key", fx.with_log(f"SELECT md5(file_name) AS file_md5, {FIVE} AS from_time FROM log"))
def _(spark, sf):
    return parse.parse_row_key(fx.archive(spark, sf))


# ---- projections -------------------------------------------------------------------

_CLEAN_COLUMNS = [
    "X_Info_request_id", "time_unix", "time_mt", "body_bytes_sent", "http_status", "response_time",
    "p_response_time", "p_response_length",
]


@query(
    "clean_detail",
    fx.with_log(
        "SELECT CASE WHEN line_num % 101 <> 0 THEN X_Info_request_id END AS X_Info_request_id, "
        f"CAST(time_unix AS DOUBLE) AS time_unix, {MINUTE} AS time_mt, "
        "CAST(body_bytes_sent AS DOUBLE) AS body_bytes_sent, CAST(http_status AS INT) AS http_status, "
        "CASE WHEN response_time = '-' THEN 0.0 ELSE CAST(response_time AS DOUBLE) END AS response_time, "
        "CAST(CASE WHEN line_num % 6 = 0 THEN 0 ELSE line_num % 64 END AS DOUBLE) AS p_response_time, "
        "CAST(CASE WHEN line_num % 101 = 0 OR line_num % 4 = 0 THEN 0 ELSE line_num % 512 END AS DOUBLE) AS p_response_length "
        f"FROM log WHERE {GOOD}"
    ),
)
def _(spark, sf):
    parsed = parse.parse_flagged(fx.lines(spark, sf, L.OWN_45), "jx_detail45")
    good, _ = parse.part_flagged(clean.clean_detail_flagged(parsed), "jx_detail45")
    return good.select(*_CLEAN_COLUMNS)


@query(
    "clean_band",
    fx.with_log(
        "SELECT line_num, CAST(time_unix AS DOUBLE) AS time_unix, CAST(body_bytes_sent AS DOUBLE) AS body_bytes_sent "
        f"FROM log WHERE {GOOD}"
    ),
)
def _(spark, sf):
    return clean.clean_band(fx.log(spark, sf))[0].select("line_num", "time_unix", "body_bytes_sent")


@query(
    "quarantine_rows",
    fx.with_log(
        "SELECT value AS raw, CASE WHEN line_num % 101 = 0 THEN 'too few fields' ELSE 'bad body_bytes_sent' END AS reason, "
        f"'fusion_band37' AS layout FROM (SELECT *, {fx.ragged_sql(L.VENDOR_37)} AS value FROM log) "
        "WHERE line_num % 101 = 0 OR body_bytes_sent = '-'"
    ),
)
def _(spark, sf):
    parsed = parse.parse_flagged(fx.lines(spark, sf, L.VENDOR_37), "fusion_band37", on_short="quarantine")
    return parse.part_flagged(clean.clean_band_flagged(parsed), "fusion_band37")[1]


@query(
    "jx_row_id",
    fx.with_log("SELECT line_num, X_Info_request_id || '-' || layer AS id, X_Info_request_id || '-' || layer AS checkd FROM log"),
)
def _(spark, sf):
    return route.with_row_id(fx.log(spark, sf), "jx").select("line_num", "id", "checkd")


@query("fusion_row_id", fx.with_log("SELECT line_num, file_name || '-' || CAST(line_num AS STRING) AS id FROM log"))
def _(spark, sf):
    return route.with_row_id(fx.log(spark, sf), "fusion").select("line_num", "id")


@query("route_jx_detail", fx.with_log(f"SELECT line_num, {_JX_INDEX} AS index_name, 'fluentd' AS index_type FROM log"))
def _(spark, sf):
    return route.route_detail(fx.log(spark, sf), "jx").select("line_num", "index_name", "index_type")


@query(
    "route_fusion_detail",
    fx.with_log(
        f"SELECT line_num, 'nginx-zss-' || lower(firm_name) || '-' || substr({_STAMP}, 1, 8) AS index_name, "
        "'fluentd' AS index_type FROM log"
    ),
)
def _(spark, sf):
    return route.route_detail(fx.log(spark, sf), "fusion", prefix="nginx-zss-").select("line_num", "index_name", "index_type")


# A moment at which part of the log is more than 30 days old.
_AS_OF = 1704067200 + 2592000 + 7200 + 120


def _band_index(prefix: str, bucket: str = "from_time") -> str:
    return (
        f"'{prefix}' || CASE WHEN {_AS_OF} - ({bucket}) > 2592000 THEN 'error' "
        f"ELSE {local(bucket, '%Y.%m.%d')} END"
    )


@query(
    "route_band",
    fx.with_log(
        f"SELECT *, {_band_index('statsdata_m_')} AS index_name, 'bandself' AS index_type FROM b",
        b=band_sql(L.JX_KEYS, MINUTE, "m1"),
    ),
)
def _(spark, sf):
    good, _ = clean.clean_band(fx.log(spark, sf))
    return route.route_band(band.band(good, L.JX_KEYS), L.INDEX_BAND_1M, L.TYPE_BAND_JX, _AS_OF)


_HOST_SQL = (
    f"SELECT host, http_status, domain, ({MINUTE}) * 1000 AS log_date, count(*) AS req_count, "
    "CAST(0 AS DOUBLE) AS traffic, CAST(0 AS DOUBLE) AS traffic_pm, "
    f"concat_ws('|', 'hst_sts', host, http_status, domain, CAST({MINUTE} AS STRING)) AS id "
    f"FROM log GROUP BY host, http_status, domain, {MINUTE}"
)


@query(
    "route_host",
    fx.with_log(
        f"SELECT *, 'stats-host-' || {local('log_date / 1000', '%Y.%m')} AS index_name, 'bandself' AS index_type FROM h",
        h=_HOST_SQL,
    ),
)
def _(spark, sf):
    return route.route_host(band.host_status(fx.log(spark, sf)))


@query(
    "batch_doc_id",
    fx.with_log("SELECT * REPLACE (md5('0-17##' || id) AS id) FROM b", b=band_sql(L.JX_KEYS, MINUTE, "m1")),
)
def _(spark, sf):
    good, _ = clean.clean_band(fx.log(spark, sf))
    return route.with_doc_id(band.band(good, L.JX_KEYS), F.lit("0-17"))


@query(
    "rank_doc_id",
    fx.with_log(
        "SELECT md5('0-17;1-4;') || '-' || md5(id) AS id, md5('0-17;1-4;##' || id) AS whole_id, domain, request, time_unix FROM u",
        u=URLS,
    ),
)
def _(spark, sf):
    urls = rank.url_hour(fx.log(spark, sf)).select("id", "domain", "request", "time_unix")
    both = urls.withColumn("_plain", F.col("id"))
    split = route.with_rank_doc_id(both, F.lit("0-17;1-4;"))
    whole = route.with_rank_doc_id(
        split.withColumns({"_split": F.col("id"), "id": F.col("_plain")}), F.lit("0-17;1-4;"), whole=True
    )
    return whole.select(
        F.col("_split").alias("id"), F.col("id").alias("whole_id"), "domain", "request", "time_unix"
    )


@query(
    "batch_tag",
    fx.with_log(
        "SELECT hour, CAST(arg_min(p, p) AS STRING) || '-' || CAST(arg_min(o, p) AS STRING) AS batch_tag, "
        "string_agg(CAST(p AS STRING) || '-' || CAST(o AS STRING), ';' ORDER BY p) || ';' AS batch_tag_all FROM s GROUP BY hour",
        s=f"SELECT {HOUR} AS hour, line_num % 12 AS p, min(line_num) AS o FROM log GROUP BY ALL",
    ),
)
def _(spark, sf):
    rows = fx.log(spark, sf).selectExpr(f"{HOUR} AS hour", "line_num % 12 AS partition", "line_num AS offset")
    return route.batch_tag(rows, ["hour"])


@query(
    "archive_row_key",
    fx.with_log(
        f"SELECT line_num, {fx.ROW_KEY_SQL} AS key10, "
        "substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST(line_num % 36 + 1 AS INT), 1) || substr("
        f"{fx.ROW_KEY_SQL}, 2) AS key36, CAST(line_num % 10 AS STRING) || '#!' || firm_name || '#' || file_name || '#' || "
        "CAST(line_num AS STRING) AS key_plain FROM log"
    ),
)
def _(spark, sf):
    df = fx.log(spark, sf)
    return df.select(
        "line_num",
        arc.archive_row_key(df).alias("key10"),
        arc.archive_row_key(df, salts=36).alias("key36"),
        arc.archive_row_key(df, form="plain").alias("key_plain"),
    )


# The log moved back by up to 59 days.
_AGED = "time_unix - (line_num % 60) * 86400"
_NOW = 1704067200
_SUFFIX = (
    f"CASE WHEN {_NOW} - (t - ((t - 57600) % 86400)) <= {{days}} * 86400 THEN {local('t', '%Y%m%d')} "
    f"ELSE {local('t', '%Y%m')} END"
)


@query(
    "archive_table_suffix",
    fx.with_log(
        f"SELECT line_num, t AS time_unix, {_SUFFIX.format(days=30)} AS table_suffix, {_SUFFIX.format(days=3)} AS suffix_3 "
        f"FROM (SELECT line_num, {_AGED} AS t FROM log)"
    ),
)
def _(spark, sf):
    aged = fx.log(spark, sf).selectExpr("line_num", f"{_AGED} AS time_unix")
    return arc.with_table_suffix(aged, _NOW).withColumn("suffix_3", arc.table_suffix("time_unix", _NOW, 3))


@query(
    "archive_pack",
    fx.with_log(
        f"SELECT row_key, log_minute, firm_name, file_md5, line_num, info, info1, '20240101' AS table_suffix FROM a",
        a=fx.archive_sql(),
    ),
)
def _(spark, sf):
    parsed, _ = parse.parse_lines(fx.lines(spark, sf, L.VENDOR_37, False), "fusion_band37")
    return arc.to_archive(parsed, as_of=_NOW)


_MALFORMED_LINE = (
    f"CASE WHEN line_num % 101 = 0 THEN {fx.wire_sql(L.VENDOR_37)} || '@##@bad bytes@##@no parse' "
    f"ELSE {fx.wire_sql(L.VENDOR_37)} END"
)


@query(
    "archive_malformed",
    fx.with_log(
        "SELECT CAST(line_num % 10 AS STRING) || '#!199700000000#' || md5(file_name) || '#' || CAST(line_num AS STRING) AS row_key, "
        "'199700000000' AS log_minute, firm_name, md5(file_name) AS file_md5, CAST(line_num AS STRING) AS line_num, "
        "CAST(NULL AS STRING) AS info, '\"bad bytes\" \"no parse\"' AS info1, 'malformed' AS table_suffix "
        "FROM log WHERE line_num % 101 = 0"
    ),
)
def _(spark, sf):
    good, _ = arc.archive_lines(fx.log(spark, sf).selectExpr(f"{_MALFORMED_LINE} AS value"), as_of=_NOW)
    return good.where(F.col("table_suffix") == arc.MALFORMED_SUFFIX)


def _export_sql(name: str) -> str:
    head = f"string_split({name}, '/')[1]"
    return (
        f"CASE WHEN {name} IS NULL OR regexp_full_match({name}, '/+') THEN '-' "
        f"WHEN length({head}) > 40 THEN substr({head}, 1, 30) ELSE {head} END"
    )


_KEY_SQL = "string_split(string_split(domain, '/')[1], ':')[1]"
_LINE_SQL = "'\"' || " + " || '\" \"' || ".join(_export_sql(n) for n in L.USER_LINE_FIELDS) + " || '\"'"


@query("user_log_line", fx.with_log(f"SELECT {_KEY_SQL} AS domain, {_LINE_SQL} AS value, line_num FROM log"))
def _(spark, sf):
    return userlog.user_log_lines(fx.log(spark, sf), keep=["line_num"])


_URL_DOMAIN = "regexp_replace(url, '^[a-z]+://', '')"


@query(
    "user_log_key",
    f"SELECT page_id, split_part(split_part({_URL_DOMAIN}, '/', 1), ':', 1) AS domain FROM pages",
)
def _(spark, sf):
    pages = _table(spark, sf, "pages").selectExpr("page_id", f"{_URL_DOMAIN} AS domain")
    return pages.select("page_id", userlog.export_key().alias("domain"))


@query(
    "rank_keyed",
    fx.with_log(
        f"SELECT md5(domain || request || CAST({HOUR} AS STRING)) AS id, {local(HOUR, '%Y-%m-%dT%H:%M:%S')} || '.000+0800' AS time_local, "
        f"{HOUR} AS time_unix, domain, request, CAST({SIZE} AS DOUBLE) AS traffic, CAST(1 AS DOUBLE) AS req_count, "
        f"CAST(0 AS DOUBLE) AS downloadnum, CAST(http_status IN ({ERRORS}) AS DOUBLE) AS req_error, "
        + ", ".join(f"CAST(http_status = '{s}' AS DOUBLE) AS req{s}" for s in L.ERROR_STATUSES)
        + " FROM log"
    ),
)
def _(spark, sf):
    return rank.rank_keyed(fx.log(spark, sf))


_EVENT = {
    "ts": "time_unix", "foo": "domain", "bar": "CAST(line_num % 100 AS INT)",
    "lat": "CAST(line_num % 90 AS DOUBLE) + 0.5", "lon": "CAST(line_num % 180 AS DOUBLE) + 0.25",
}


@query(
    "event_serialise",
    fx.with_log(
        "SELECT line_num, CAST(to_json({'ts': ts, 'foo': foo, 'bar': bar, 'lat': lat, 'lon': lon}) AS STRING) AS flat, "
        "CAST(to_json({'ts': ts, 'data': {'foo': foo, 'bar': bar}, 'geo': {'lat': lat, 'lon': lon}}) AS STRING) AS nested, "
        "concat_ws(',', ts, foo, bar, lat, lon) AS csv FROM e",
        e=f"SELECT line_num, {', '.join(f'{x} AS {n}' for n, x in _EVENT.items())} FROM log",
    ),
)
def _(spark, sf):
    df = fx.log(spark, sf).selectExpr("line_num", *[f"{x} AS {n}" for n, x in _EVENT.items()])
    keep = ["line_num", *_EVENT]
    flat = events.serialise(df, "json", keep=keep).withColumnRenamed("event", "flat")
    nested = events.serialise(flat, "nested", keep=[*keep, "flat"]).withColumnRenamed("event", "nested")
    csv = events.serialise(nested, "csv", keep=["line_num", "flat", "nested"])
    return csv.withColumnRenamed("event", "csv")


@query(
    "route_rank",
    fx.with_log(
        f"SELECT id, domain, request, time_unix, 'urlstats-' || {local('time_unix', '%Y.%m')} AS index_name, 'urlrank' AS index_type FROM u",
        u=URLS,
    ),
)
def _(spark, sf):
    urls = rank.url_hour(fx.log(spark, sf)).select("id", "domain", "request", "time_unix")
    return route.route_rank(urls)


@query(
    "dim_hash_id",
    fx.with_log(f"SELECT line_num, md5({' || '.join(L.FUSION_KEYS)}) AS id FROM log"),
)
def _(spark, sf):
    return route.dim_hash_id(fx.log(spark, sf)).select("line_num", "id")


# ---- filters -----------------------------------------------------------------------

@query(
    "retention_filter",
    fx.with_log(
        "SELECT line_num, http_status, layer, domain FROM log WHERE http_status NOT IN ('200', '206', '304') "
        "OR layer IN ('0', '1') OR contains(domain, 'media')"
    ),
)
def _(spark, sf):
    return filters.keep_policy(fx.log(spark, sf), domain_substr="media").select("line_num", "http_status", "layer", "domain")


_N = 10


@query(
    "rank_prune",
    fx.with_log(
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY id, request) AS rn FROM urls) "
        f"WHERE rn <= {_N + 1} OR req_count > 1 OR req_error > 0",
        urls=URLS,
    ),
)
def _(spark, sf):
    return rank.prune_rank(rank.url_hour(fx.log(spark, sf)), _N)


@query(
    "host_list_filter",
    fx.with_log("SELECT line_num, host FROM log WHERE host IN ('edge1', 'edge3', 'edge6')"),
)
def _(spark, sf):
    return filters.in_list(fx.log(spark, sf), "host", ["edge1", "edge3", "edge6"]).select("line_num", "host")


@query(
    "host_table_filter",
    fx.with_log(
        "SELECT line_num, host FROM log WHERE host IN (SELECT 'edge' || CAST(n_nationkey AS STRING) FROM nation WHERE n_regionkey = 1)"
    ),
)
def _(spark, sf):
    hosts = _table(spark, sf, "nation").where("n_regionkey = 1").selectExpr("'edge' || n_nationkey AS h")
    return filters.in_list(fx.log(spark, sf), "host", hosts).select("line_num", "host")


@query("firm_list_filter", fx.with_log("SELECT line_num, firm_name FROM log WHERE firm_name IN ('VC', 'UP')"))
def _(spark, sf):
    return filters.in_list(fx.log(spark, sf), "firm_name", ["VC", "UP"]).select("line_num", "firm_name")


@query(
    "line_contains",
    fx.with_log(f"SELECT value FROM (SELECT {fx.wire_sql(L.VENDOR_37)} AS value FROM log) WHERE contains(value, 'media')"),
)
def _(spark, sf):
    return filters.line_contains(fx.lines(spark, sf, L.VENDOR_37, False), "media")


# ---- reconciliation ----------------------------------------------------------------

_CHECK = (
    "SELECT coalesce(b.file_name, a.file_md5) AS file_name, a.from_time, a.from_time * 1000 AS log_date, "
    "a.n AS archive_req_count, b.n AS band_req_count, CASE WHEN a.n = b.n THEN 'Y' ELSE 'N' END AS is_normal "
    "FROM a LEFT JOIN b ON a.file_md5 = b.file_md5 AND a.from_time = b.from_time"
)
_CHECK_A = f"SELECT md5(file_name) AS file_md5, {FIVE} AS from_time, count(*) AS n FROM log GROUP BY ALL"
_CHECK_B = (
    f"SELECT md5(file_name) AS file_md5, min(file_name) AS file_name, {FIVE} AS from_time, count(*) AS n "
    f"FROM log WHERE {GOOD} AND hit_status = 'MISS' GROUP BY 1, 3"
)


@query("band_check", fx.with_log(_CHECK, a=_CHECK_A, b=_CHECK_B))
def _(spark, sf):
    good, _ = clean.clean_band(fx.log(spark, sf).where("hit_status = 'MISS'"))
    return check.band_check(fx.archive(spark, sf), band.band(good, L.FUSION_KEYS, 60))


@query("file_5m_counts", fx.with_log("SELECT file_md5, from_time, n AS archive_req_count FROM a", a=_CHECK_A))
def _(spark, sf):
    return check.archive_file_counts(fx.archive(spark, sf))


# ---- rollups -----------------------------------------------------------------------

def _band_query(key: str, keys: list[str], width: int, bucket: str) -> None:
    @query(key, fx.with_log(band_sql(keys, bucket, band.ID_PREFIX[width])))
    def _(spark, sf):
        good, _ = clean.clean_band(fx.log(spark, sf))
        return band.band(good, keys, width)


_band_query("band_1m_fusion", L.FUSION_KEYS, 60, MINUTE)
_band_query("band_5m_fusion", L.FUSION_KEYS, 300, FIVE)
_band_query("band_1m_jx", L.JX_KEYS, 60, MINUTE)
_band_query("band_5m_jx", L.JX_KEYS, 300, FIVE)


@query("band_5m_from_1m", fx.with_log(band_sql(L.FUSION_KEYS, FIVE, "m5")))
def _(spark, sf):
    good, _ = clean.clean_band(fx.log(spark, sf))
    return band.reband(band.band(good, L.FUSION_KEYS, 60), L.FUSION_KEYS, 300)


@query(
    "band_1m_tagged",
    fx.with_log(
        band_sql(
            L.JX_KEYS, MINUTE, "m1",
            ", CAST(min(line_num % 12) AS STRING) || '-' || CAST(min(line_num) FILTER (line_num % 12 = m) AS STRING) AS offset_tag",
        ).replace(
            "FROM log",
            f"FROM (SELECT *, min(line_num % 12) OVER (PARTITION BY {', '.join(L.JX_KEYS)}, {MINUTE}) AS m FROM log WHERE {GOOD})",
        )
    ),
)
def _(spark, sf):
    tagged = fx.log(spark, sf).selectExpr("*", "concat_ws('-', line_num % 12, line_num) AS offset_tag")
    return band.band(clean.clean_band(tagged)[0], L.JX_KEYS, 60, tag="offset_tag")


@query("host_status_1m", fx.with_log(_HOST_SQL))
def _(spark, sf):
    return band.host_status(fx.log(spark, sf))


@query("url_hour", fx.with_log(URLS))
def _(spark, sf):
    return rank.url_hour(fx.log(spark, sf))


_URL_SUM = ["traffic", "req_count"]


@query(
    "url_sum_salted",
    fx.with_log(
        f"SELECT domain, request, CAST(sum({SIZE}) AS DOUBLE) AS traffic, CAST(count(*) AS DOUBLE) AS req_count "
        "FROM log GROUP BY domain, request"
    ),
)
def _(spark, sf):
    return rank.url_sum_salted(rank.rank_keyed(fx.log(spark, sf)), ["domain", "request"], _URL_SUM)


_PREAGG_SUM = (
    f"SELECT domain, request, CAST(sum({SIZE}) AS DOUBLE) AS traffic, CAST(count(*) AS DOUBLE) AS req_count, "
    "CAST(0 AS DOUBLE) AS downloadnum, "
    f"CAST(coalesce(sum(line_num % 3) FILTER (http_status IN ({ERRORS})), 0) AS DOUBLE) AS req_error, "
    + ", ".join(
        f"CAST(coalesce(sum(line_num % 3) FILTER (http_status = '{s}'), 0) AS DOUBLE) AS req{s}" for s in L.ERROR_STATUSES
    )
    + " FROM log GROUP BY domain, request"
)


def _preagg(spark, sf):
    text = fx.log(spark, sf).selectExpr(f"{_PREAGG_LINE} AS value")
    return rank.preagg_sum(parse.parse_lines(text, "preagg7", sep=" ")[0])


@query("preagg_sum", fx.with_log(_PREAGG_SUM))
def _(spark, sf):
    return _preagg(spark, sf)


@query("archive_firm_count", fx.with_log("SELECT firm_name, count(*) AS n FROM log GROUP BY firm_name"))
def _(spark, sf):
    return arc.archive_firm_count(fx.archive(spark, sf))


@query(
    "domain_rollup",
    fx.with_log(
        f"SELECT time_unix AS at, domain, CAST(sum(CAST(body_bytes_sent AS BIGINT)) AS BIGINT) AS body_bytes_sent "
        f"FROM log WHERE {GOOD} GROUP BY time_unix, domain"
    ),
)
def _(spark, sf):
    good, _ = parse.druid_events(_sql42_lines(spark, sf))
    return band.domain_rollup(good).select(
        F.unix_seconds("time_local").alias("at"), "domain", "body_bytes_sent"
    )


@query(
    "firm_day_count",
    fx.with_log(
        f"SELECT {local('t', '%Y%m%d')} AS day, lower(firm_name) AS firm_name, count(firm_name) AS req_count "
        f"FROM (SELECT firm_name, {_AGED} AS t FROM log) GROUP BY ALL"
    ),
)
def _(spark, sf):
    aged = fx.log(spark, sf).selectExpr("firm_name", f"{_AGED} AS time_unix")
    return band.firm_day_count(aged, tm.fmt_epoch("time_unix", "yyyyMMdd"))


@query(
    "word_count",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word",
)
def _(spark, sf):
    return band.word_count(_table(spark, sf, "documents"), "text")


@query("row_count", "SELECT count(*) AS n FROM events")
def _(spark, sf):
    return band.row_count(fx.log(spark, sf))


# ---- top lists ---------------------------------------------------------------------

def _top_query(key: str, metric: str) -> None:
    @query(key, fx.with_log(top_sql(metric, _N), urls=URLS))
    def _(spark, sf):
        return rank.top_by(rank.url_hour(fx.log(spark, sf)), metric, _N)


_top_query("top_req", "req_count")
_top_query("top_traffic", "traffic")
_top_query("top_download", "downloadnum")
_top_query("top_error", "req_error")

_UNION = " UNION ".join(f"({top_sql(m, _N)})" for m in rank.TOP_METRICS)


@query("top_union", fx.with_log(_UNION, urls=URLS))
def _(spark, sf):
    return rank.top_union(rank.url_hour(fx.log(spark, sf)), _N)


@query("top_req_salted", fx.with_log(top_sql("req_count", _N), urls=URLS))
def _(spark, sf):
    return rank.top_by(rank.url_hour(fx.log(spark, sf)), "req_count", _N, salts=4)


@query(
    "rank_sql",
    fx.with_log(
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY traffic DESC, request DESC) AS rowid FROM r) WHERE rowid <= 2",
        r=_PREAGG_SUM,
    ),
)
def _(spark, sf):
    top = rank.rank_sql(spark, _preagg(spark, sf), 2)
    return top.withColumn("rowid", F.col("rowid").cast("bigint"))


@query(
    "sorted_export",
    fx.with_log(f"SELECT {_KEY_SQL} AS domain, {_LINE_SQL} AS value, time_unix, line_num FROM log"),
)
def _(spark, sf):
    out = userlog.user_log_lines(fx.log(spark, sf), keep=["time_unix", "line_num"])
    return userlog.sorted_lines(out, ["domain", "time_unix", "line_num"])


@query("sample_rows", fx.with_log("SELECT * FROM log ORDER BY line_num LIMIT 100"))
def _(spark, sf):
    return fx.log(spark, sf).orderBy("line_num").limit(100)


@query("archive_union_late", fx.with_log("SELECT * FROM a WHERE table_suffix IN ('20240101', '202401')", a=fx.archive_sql()))
def _(spark, sf):
    return arc.archive_tables(fx.archive(spark, sf), ["20240101", "202401"])


# ---- scalar functions --------------------------------------------------------------

_FORMATS = {
    "d_dots": ("yyyy.MM.dd", "%Y.%m.%d"), "m_dots": ("yyyy.MM", "%Y.%m"), "d_plain": ("yyyyMMdd", "%Y%m%d"),
    "m_plain": ("yyyyMM", "%Y%m"), "minute": ("yyyyMMddHHmm", "%Y%m%d%H%M"),
}


def _order_seconds(spark, sf):
    return _table(spark, sf, "orders").selectExpr(
        "o_orderkey", "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', o_orderdate) + o_orderkey % 86400 AS t"
    )


_ORDER_SQL = "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400 AS t FROM orders"


@query(
    "date_formats",
    f"SELECT o_orderkey, {', '.join(f'{local("t", d)} AS {n}' for n, (_, d) in _FORMATS.items())} FROM ({_ORDER_SQL})",
)
def _(spark, sf):
    cols = [tm.fmt_epoch("t", p).alias(n) for n, (p, _) in _FORMATS.items()]
    return _order_seconds(spark, sf).select("o_orderkey", *cols)


@query(
    "date_parse",
    "SELECT o_orderkey, (t + 28800 - (t + 28800) % 86400 - 28800) * 1000 AS day_ms, (t - t % 60) * 1000 AS minute_ms "
    f"FROM ({_ORDER_SQL})",
)
def _(spark, sf):
    text = _order_seconds(spark, sf).select(
        "o_orderkey", tm.fmt_epoch("t", "yyyyMMdd").alias("d"), tm.fmt_epoch("t", "yyyyMMddHHmm").alias("m")
    )
    return text.select(
        "o_orderkey",
        (tm.parse_epoch("d", "yyyyMMdd") * 1000).alias("day_ms"),
        (tm.parse_epoch("m", "yyyyMMddHHmm") * 1000).alias("minute_ms"),
    )


@query("minute_string", fx.with_log(f"SELECT line_num, {local(MINUTE, '%Y%m%d%H%M')} AS minute FROM log"))
def _(spark, sf):
    return fx.log(spark, sf).select("line_num", tm.minute_text("time_unix").alias("minute"))


@query(
    "time_buckets",
    "SELECT o_orderkey, t - t % 60 AS m1, t - t % 300 AS m5, t - t % 3600 AS h1, "
    f"t + 28800 - (t + 28800) % 86400 - 28800 AS day8 FROM ({_ORDER_SQL})",
)
def _(spark, sf):
    return _order_seconds(spark, sf).select(
        "o_orderkey",
        *[tm.floor_to("t", n).alias(a) for a, n in (("m1", 60), ("m5", 300), ("h1", 3600))],
        tm.day_start_utc8("t").alias("day8"),
    )


@query(
    "iso_time",
    f"SELECT o_orderkey, {local('t', '%Y-%m-%dT%H:%M:%S')} || '.000+0800' AS iso FROM ({_ORDER_SQL})",
)
def _(spark, sf):
    return _order_seconds(spark, sf).select("o_orderkey", tm.iso_time("t").alias("iso"))


@query("md5_hex", "SELECT doc_id, md5(text) AS digest FROM documents")
def _(spark, sf):
    return _table(spark, sf, "documents").select("doc_id", F.md5("text").alias("digest"))


@query(
    "lenient_double",
    fx.with_log(
        "SELECT line_num, coalesce(TRY_CAST(body_bytes_sent AS DOUBLE), 0) AS size, "
        "coalesce(TRY_CAST(body_bytes_sent AS DOUBLE), 0) + coalesce(TRY_CAST(response_time AS DOUBLE), 0) AS total FROM log"
    ),
)
def _(spark, sf):
    return fx.log(spark, sf).select(
        "line_num", sc.lenient("body_bytes_sent").alias("size"),
        sc.null_safe_add("body_bytes_sent", "response_time").alias("total"),
    )


@query(
    "lenient_int",
    fx.with_log(
        "SELECT line_num, coalesce(TRY_CAST(response_time AS INT), 7) AS n, coalesce(nullif(referer, '-'), '0') AS text FROM log"
    ),
)
def _(spark, sf):
    return fx.log(spark, sf).select(
        "line_num", sc.lenient("response_time", "int", 7).alias("n"),
        sc.text_or_zero(F.nullif("referer", F.lit("-"))).alias("text"),
    )


_IP = " + ".join(f"CAST(split_part(clientip, '.', {i + 1}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4))


@query(
    "ip_codec",
    fx.with_log(
        f"SELECT line_num, {_IP} AS n, CAST({_IP} AS INT) AS signed, clientip AS back, "
        f"{_IP} + 3000000000 AS high, CAST({_IP} + 3000000000 - 4294967296 AS INT) AS high_signed FROM log"
    ),
)
def _(spark, sf):
    n = sc.ip_to_long("clientip")
    high = n + F.lit(3000000000)
    return fx.log(spark, sf).select(
        "line_num", n.alias("n"), sc.ip_to_int("clientip").alias("signed"), sc.long_to_ip(n).alias("back"),
        high.alias("high"), sc.ip_to_int(sc.long_to_ip(high)).alias("high_signed"),
    )


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    return fx.events(spark, sf).select("event_id", sc.json_map("props", "bigint")["k"].alias("k"))


# ---- late data ---------------------------------------------------------------------

@query(
    "late_routing",
    fx.with_log(
        f"SELECT line_num, t AS from_time, 'statsdata_m_' || CASE WHEN {_NOW} - t > 2592000 THEN 'error' ELSE "
        f"{local('t', '%Y.%m.%d')} END AS index_name, 'bandwidth' AS index_type, {_SUFFIX.format(days=30)} AS table_suffix "
        f"FROM (SELECT line_num, {_AGED} AS t FROM log)"
    ),
)
def _(spark, sf):
    aged = fx.log(spark, sf).selectExpr("line_num", f"{_AGED} AS from_time")
    routed = route.route_band(aged, L.INDEX_BAND_1M, L.TYPE_BAND_FUSION, _NOW)
    return routed.withColumn("table_suffix", arc.table_suffix("from_time", _NOW))


# ---- models ------------------------------------------------------------------------

def _ratings(spark, sf):
    return fx.events(spark, sf).selectExpr(
        "CAST(user_id AS INT) AS user", "CAST(event_id % 20 AS INT) AS item", "value AS rating"
    )


def _points(spark, sf, positive: bool = False):
    e = F.transform("embedding", lambda x: F.abs(x).cast("double") if positive else x.cast("double"))
    return _table(spark, sf, "embeddings").select(
        "vec_id", (F.col("label") % 2).cast("double").alias("label"), array_to_vector(e).alias("features")
    )


def _predicted(model, points):
    return model.transform(points).select("vec_id", "label", "prediction")


NAMED_USERS = (1, 2, 3, 5, 8)


@query("als_top")
def als_top(spark, sf, users: tuple[int, ...] = NAMED_USERS, n: int = 3):
    """The items of named users with their scores. SQL cannot fit factors: ``als_fit`` and a brute-force test check them."""
    ratings = _ratings(spark, sf).groupBy("user", "item").agg(F.avg("rating").alias("rating"))
    named = ratings.select("user").where(F.col("user").isin(*users)).distinct()
    return recommend.als_top(ratings, named, n=n)


@query(
    "als_fit",
    "WITH r AS (SELECT user_id, event_id % 20 AS item, avg(value) AS r FROM events GROUP BY ALL) "
    "SELECT count(*) AS n, round(var_pop(CAST(CAST(r AS FLOAT) AS DOUBLE)), 3) AS mean_error, true AS better FROM r",
)
def _(spark, sf):
    """A model of ten factors predicts every rating, and nearer than the mean rating does."""
    ratings = _ratings(spark, sf).groupBy("user", "item").agg(F.avg("rating").alias("rating"))
    error = recommend.als_error(recommend.als_model(ratings, rank=10, iterations=5), ratings.withColumn("rating", F.col("rating").cast("float")))
    return error.select("n", F.round("mean_error", 3).alias("mean_error"), (F.col("model_error") < 0.9 * F.col("mean_error")).alias("better"))


@query(
    "cosine_users",
    "WITH k AS (SELECT user_id, event_id % 20 AS item, avg(value) AS r FROM events GROUP BY ALL), "
    "o AS (SELECT item, r FROM k WHERE user_id = 8) "
    "SELECT CAST(user_id AS INT) AS user, round(sum(k.r * coalesce(o.r, 0)) / (sqrt(sum(k.r * k.r)) * "
    "(SELECT sqrt(sum(r * r)) FROM o)), 6) AS similarity FROM k LEFT JOIN o ON k.item = o.item GROUP BY user_id",
)
def _(spark, sf):
    return recommend.cosine_users(_ratings(spark, sf), 8)


_NB = (
    "WITH e AS (SELECT vec_id, CAST(label % 2 AS DOUBLE) AS label, abs(CAST(unnest(embedding) AS DOUBLE)) AS x, "
    "generate_subscripts(embedding, 1) AS j FROM embeddings), "
    "n AS (SELECT CAST(label % 2 AS DOUBLE) AS label, count(*) AS n FROM embeddings GROUP BY 1), "
    "prior AS (SELECT label, ln(n + 1.0) - ln((SELECT sum(n) + count(*) FROM n)) AS pi FROM n), "
    "s AS (SELECT label, j, sum(x) AS s FROM e GROUP BY ALL), "
    "t AS (SELECT label, sum(s) + count(*) AS t FROM s GROUP BY label), "
    "theta AS (SELECT s.label, j, ln(s + 1.0) - ln(t) AS theta FROM s JOIN t ON s.label = t.label), "
    "score AS (SELECT e.vec_id, e.label, theta.label AS guess, sum(x * theta) + any_value(pi) AS score FROM e "
    "JOIN theta ON e.j = theta.j JOIN prior ON theta.label = prior.label GROUP BY ALL) "
    "SELECT vec_id, label, arg_max(guess, score) AS prediction FROM score GROUP BY vec_id, label"
)


@query("naive_bayes", _NB)
def _(spark, sf):
    points = _points(spark, sf, positive=True)
    return _predicted(recommend.naive_bayes(points), points)


@query(
    "linear_regression",
    "SELECT round(regr_slope(l_extendedprice, l_quantity), 2) AS slope, "
    "round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem",
)
def _(spark, sf):
    points = _table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("label"), array_to_vector(F.array("l_quantity")).alias("features")
    )
    model = recommend.linear_regression(points)
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 2), round(float(model.intercept), 2))], "slope double, intercept double"
    )


# A label whose rate differs by kind of event; a model that sees the kind alone has one answer.
_KINDS = ("view", "click", "signup", "purchase", "error")
_KIND_LABEL = "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 3 WHEN 'signup' THEN 6 WHEN 'purchase' THEN 8 ELSE 9 END"
_RATED = f"SELECT event_id, event_type, CASE WHEN event_id % 10 < {_KIND_LABEL} THEN 1.0 ELSE 0.0 END AS label FROM events"
_RATES = f"SELECT event_type, avg(label) AS rate FROM ({_RATED}) GROUP BY event_type"


def _kinds(spark, sf):
    """A point per event: its kind as features, one of which each kind but the last has."""
    kind = [F.when(F.col("event_type") == k, 1.0).otherwise(0.0) for k in _KINDS[:-1]]
    rated = fx.events(spark, sf).selectExpr("event_id", "event_type", f"CAST(event_id % 10 < {_KIND_LABEL} AS DOUBLE) AS label")
    return rated.select("event_id", "label", array_to_vector(F.array(*kind)).alias("features"))


@query(
    "logistic_regression",
    "SELECT event_id, CAST(label AS DOUBLE) AS label, round(rate, 3) AS probability, CAST(rate > 0.5 AS INT)::DOUBLE AS prediction "
    f"FROM ({_RATED}) e JOIN ({_RATES}) r USING (event_type)",
)
def _(spark, sf):
    """Features that only tell groups apart: the fitted probability is the rate of the group."""
    points = _kinds(spark, sf)
    told = recommend.logistic_regression(points, iterations=200, tol=1e-12).transform(points)
    return told.select("event_id", "label", F.round(vector_to_array("probability")[1], 3).alias("probability"), "prediction")


@query("logistic_points")
def _(spark, sf):
    """Predictions of a model learnt on a part of the embeddings for all of them; a test checks such a model."""
    points = _points(spark, sf)
    train, _ = recommend.split_points(points)
    return _predicted(recommend.logistic_regression(train), points)


@query(
    "random_split",
    "SELECT count(*) AS total, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS twice, true AS both FROM lineitem",
)
def _(spark, sf):
    """The parts hold every row of the table once."""
    whole = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    parts = recommend.split_points(whole)
    tagged = parts[0].withColumn("part", F.lit(1)).unionByName(parts[1].withColumn("part", F.lit(2)))
    counted = whole.withColumn("part", F.lit(0)).unionByName(tagged).groupBy("l_orderkey", "l_linenumber").agg(
        F.count_if(F.col("part") == 0).alias("in_whole"), F.count_if(F.col("part") > 0).alias("in_parts"), F.max("part").alias("last"), F.min(F.when(F.col("part") > 0, F.col("part"))).alias("first"),
    )
    return counted.agg(
        F.sum("in_parts").alias("total"), F.count_if(F.col("in_parts") < F.col("in_whole")).alias("missing"),
        F.count_if(F.col("in_parts") > F.col("in_whole")).alias("twice"), ((F.min("first") == 1) & (F.max("last") == 2)).alias("both"),
    )


@query(
    "accuracy",
    fx.with_log(
        "SELECT avg(CASE WHEN (hit_status = 'HIT') = (http_status = '200') THEN 1.0 ELSE 0.0 END) AS accuracy FROM log"
    ),
)
def _(spark, sf):
    pairs = fx.log(spark, sf).selectExpr(
        "CAST(hit_status = 'HIT' AS DOUBLE) AS prediction", "CAST(http_status = '200' AS DOUBLE) AS label"
    )
    return recommend.accuracy(pairs)


@query(
    "linear_svc",
    "SELECT event_id, CAST(label AS DOUBLE) AS label, CAST(rate > 0.5 AS INT)::DOUBLE AS prediction "
    f"FROM ({_RATED}) e JOIN ({_RATES}) r USING (event_type)",
)
def _(spark, sf):
    """The hinge loss of a group is least on the side of its majority."""
    points = _kinds(spark, sf)
    model = recommend.linear_svc(recommend.distinct_points(points), iterations=100, weight="weight")
    return model.transform(points).select("event_id", "label", "prediction")


@query("svc_points")
def _(spark, sf):
    points = _points(spark, sf)
    return _predicted(recommend.linear_svc(points), points)


# ---- batch jobs --------------------------------------------------------------------

@query(
    "rebuild_band",
    fx.with_log(
        "SELECT * REPLACE (md5('0##' || id) AS id), "
        f"{_band_index('statsdata_5m_')} AS index_name, 'bandwidth' AS index_type FROM b",
        b=band_sql(L.FUSION_KEYS, FIVE, "m5", where=f"{GOOD} AND firm_name = 'BS' AND {fx.MINUTE_SQL} >= '{_FROM}' AND {fx.MINUTE_SQL} < '{_TO}'"),
    ),
)
def _(spark, sf):
    return jobs.rebuild_band(fx.archive(spark, sf), _FROM, _TO, firm="BS", as_of=_AS_OF)[300]


@query(
    "rebuild_band_jx",
    fx.with_log(
        "SELECT * REPLACE (md5('0##' || id) AS id), "
        f"{_band_index('statsdata_m_')} AS index_name, 'bandself' AS index_type FROM b",
        b=band_sql(L.JX_KEYS, MINUTE, "m1", where=f"{GOOD} AND {fx.MINUTE_SQL} >= '{_FROM}' AND {fx.MINUTE_SQL} < '{_TO}'"),
    ),
)
def _(spark, sf):
    return jobs.rebuild_band(fx.archive(spark, sf, "jx"), _FROM, _TO, kind="jx", as_of=_AS_OF)[60]


@query(
    "time_slices",
    fx.with_log(
        "SELECT file_name, s AS slice_from, least(s + 1200, b) AS slice_to FROM "
        "(SELECT file_name, b, unnest(range(a, b, 1200)) AS s FROM f)",
        f="SELECT file_name, min(time_unix) AS a, max(time_unix) AS b FROM log GROUP BY file_name",
    ),
)
def _(spark, sf):
    spans = fx.log(spark, sf).groupBy("file_name").agg(
        F.min("time_unix").alias("a"), F.max("time_unix").alias("b")
    )
    return events.slices_of(spans, "a", "b", 1200, ["file_name"])
