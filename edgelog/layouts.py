"""Record layouts of the access logs.

Every name list below is a fixed value: the position of a name in its list is the
position of the field on the wire, so lists must not be reordered.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Wire separators.
FIELD_SEP = "@##@"
CELL_SEP = '" "'

# The first 34 fields of a vendor line and of a line of our own nodes.
VENDOR_34 = [
    "firm_name", "response_time", "http_range", "upstream_response_time",
    "time_local", "time_unix", "clientip", "method", "domain", "request", "protocol",
    "http_status", "body_bytes_sent", "referer", "user_agent", "hit_status_detail",
    "hit_status", "upstream_addr", "server_addr", "X_Info_Fetcher", "X_Info_ObjSize",
    "X_Info_request_id", "X_Info_MD5", "prov", "country", "city", "ISP", "latitude",
    "longitude", "blockid", "referer_host", "search_engine", "hackerid", "layer",
]
OWN_34 = [
    "firm_name", "response_time", "http_range", "p_response_time",
    "time_local", "time_unix", "clientip", "method", "domain", "request", "protocol",
    "http_status", "body_bytes_sent", "referer", "user_agent", "hit_status_detail",
    "hit_status", "upstream_addr", "server_addr", "X_Info_Fetcher", "X_Info_ObjSize",
    "X_Info_request_id", "X_Info_MD5", "prov", "country", "city", "ISP", "latitude",
    "longitude", "blockid", "referer_host", "search_engine", "hackerid", "layer",
]
# What follows them in the longer layouts.
VENDOR_37 = VENDOR_34 + ["def1", "file_name", "line_num"]
OWN_45 = OWN_34 + [
    "def1", "hit_status_whole", "host", "p_response_length", "p_server", "p_status",
    "request_from", "ruleid", "xff", "rawdata", "except_desc",
]

LAYOUTS: dict[str, list[str]] = {
    "common34": VENDOR_34,
    "fusion_band37": VENDOR_37,
    "fusion_detail39": VENDOR_37 + ["rawdata", "except_desc"],
    "jx_band45": OWN_45,
    "jx_detail45": OWN_45,
    "unified_band38": OWN_34 + ["def1", "file_name", "hit_status_whole", "host"],
    "unified46": OWN_34 + [
        "def1", "file_name", "line_num", "hit_status_whole", "host",
        "p_response_length", "p_server", "p_status", "request_from", "ruleid", "xff",
        "peak",
    ],
    "preagg7": [
        "domain", "request", "traffic", "req_count", "downloadnum", "status_count",
        "status",
    ],
}

# Layouts in which an empty field counts as missing.
EMPTY_IS_MISSING = {"jx_band45", "jx_detail45"}

# The two cells of an archived record.
ARCHIVE_USER = [
    "clientip", "response_time", "time_local", "method", "domain", "request",
    "protocol", "http_status", "body_bytes_sent", "referer", "user_agent",
    "hit_status",
]
_ARCHIVE_REST = [
    "firm_name", "http_range", "upstream_response_time", "time_unix",
    "hit_status_detail", "upstream_addr", "server_addr", "X_Info_Fetcher",
    "X_Info_ObjSize", "X_Info_request_id", "X_Info_MD5", "prov", "country", "city",
    "ISP", "latitude", "longitude", "blockid", "referer_host", "search_engine",
    "hackerid", "layer", "def1",
]
ARCHIVE_REST = {
    "fusion": _ARCHIVE_REST + ["file_name", "line_num"],
    "jx": _ARCHIVE_REST + [
        "hit_status_whole", "host", "p_response_length", "p_server", "p_status",
        "request_from", "ruleid", "xff",
    ],
}
ARCHIVE_BAND = [
    "domain", "http_status", "body_bytes_sent", "hit_status", "firm_name", "time_unix",
    "prov", "country", "city", "ISP", "layer", "def1", "file_name",
]

# Grouping keys of the rollups.
FUSION_KEYS = [
    "file_name", "layer", "firm_name", "domain", "prov", "ISP", "hit_status",
    "http_status", "def1",
]
JX_KEYS = [
    "layer", "firm_name", "domain", "prov", "ISP", "hit_status", "http_status",
]
HOST_KEYS = ["host", "http_status", "domain"]

# Statuses counted one by one in a URL-hour record.
ERROR_STATUSES = ["401", "403", "404", "500", "501", "502", "503", "504"]
RANK_MEASURES = (
    ["traffic", "req_count", "downloadnum", "req_error"]
    + [f"req{s}" for s in ERROR_STATUSES]
)

# Fields of one exported user log line, in order.
USER_LINE_FIELDS = ARCHIVE_USER
# Fields an index query for the export asks for.
USER_LOG_COLUMNS = [
    "clientip", "response_time", "time_local", "time_unix", "method", "domain",
    "request", "protocol", "http_status", "body_bytes_sent", "referer", "user_agent",
    "hit_status",
]

# Index names and document types.
INDEX_FUSION_DETAIL = "vendor-"
INDEX_JX_DETAIL = "nginx-"
INDEX_BAND_1M = "statsdata_m_"
INDEX_BAND_5M = "statsdata_5m_"
INDEX_HOST = "stats-host-"
INDEX_RANK = "urlstats-"
TYPE_DETAIL = "fluentd"
TYPE_BAND_FUSION = "bandwidth"
TYPE_BAND_JX = "bandself"

# Fixed value: key minute of a record that could not be taken apart.
MALFORMED_MINUTE = "199700000000"
# Fixed value: alphabet the archive salt is drawn from.
SALT_ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyz"

SQL42_SCHEMA = T.StructType(
    [
        T.StructField(n, T.LongType() if n == "body_bytes_sent" else T.StringType())
        for n in VENDOR_37
        + ["id", "filetime", "lowfirmname", "rawdata", "except_desc"]
    ]
)

URL_RANK_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("time_unix", T.LongType()),
        T.StructField("domain", T.StringType()),
        T.StructField("request", T.StringType()),
    ]
    + [T.StructField(m, T.DoubleType()) for m in RANK_MEASURES]
)

RAW_LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])
