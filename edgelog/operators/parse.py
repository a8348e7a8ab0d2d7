"""Raw log lines to named columns, with a quarantine for what does not fit.

Every parser is a projection: one split per line, then positional reads. The ``*_flagged``
forms keep all rows and mark bad ones in ``_reason``; the others part them into
``(good, quarantine)``. Both parts read the same input, so persist the flagged frame
first when both are consumed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgelog import layouts as L
from edgelog.functions.scalars import drop_outer_quotes, lenient, log_time
from edgelog.functions.times import floor_to, parse_epoch

QUARANTINE_COLUMNS = ["raw", "reason", "layout"]


def _literal(sep: str) -> str:
    """Separator as a pattern that matches just itself."""
    return sep if sep.isalnum() or sep == L.FIELD_SEP else f"\\Q{sep}\\E"


def trimmed(line: str, sep: str = L.FIELD_SEP) -> Column:
    """A line without the separators at its end; empty if it is nothing but separators.

    The pattern only runs on the short tail made of the separator's characters.
    """
    text = F.col(line)
    base = F.rtrim(text, F.lit("".join(sorted(set(sep)))))
    tail = F.substring(text, F.length(base) + 1, F.length(text))
    kept = F.regexp_replace(tail, f"({_literal(sep)})+$", "")
    return F.when(~text.endswith(sep), text).otherwise(F.concat(base, kept))


def split_lines(
    df: DataFrame, lines: dict[str, str], sep: str = L.FIELD_SEP, keep_trailing: bool = False
) -> DataFrame:
    """Add the fields of each line column as an array column, ``{line: array}``.

    Empty fields at the end of a line count as absent unless kept.
    """
    bare = df
    text = {line: F.col(line) for line in lines}
    if not keep_trailing:
        bare = df.withColumns({f"{line}_bare": trimmed(line, sep) for line in lines})
        for line in lines:
            rest = F.col(f"{line}_bare")
            text[line] = F.when((rest != "") | (F.col(line) == ""), rest)
    parts = {out: F.split(text[line], _literal(sep), -1) for line, out in lines.items()}
    return evaluated(bare, **parts).select(*df.columns, *parts)


def evaluated(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    Filters and projections above a generator are not merged into it, so a costly
    expression read dozens of times, such as a split line, is not repeated in each reader.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    held = df.select("*", F.explode(F.array(packed)).alias("_once"))
    return held.select(*df.columns, *[F.col(f"_once.{n}").alias(n) for n in columns])


def _fields(parts: Column, names: list[str], empty_is_missing: bool = False) -> list[Column]:
    out = []
    for i, name in enumerate(names, 1):
        value = F.try_element_at(parts, F.lit(i))
        out.append((F.when(value != "", value) if empty_is_missing else value).alias(name))
    return out


def part_flagged(flagged: DataFrame, layout: str, raw: str = "_raw") -> tuple[DataFrame, DataFrame]:
    """Split a flagged frame into its good rows and its quarantine."""
    good = flagged.where(F.col("_reason").isNull()).drop("_reason", raw)
    bad = flagged.where(F.col("_reason").isNotNull()).select(
        F.col(raw).alias("raw"), F.col("_reason").alias("reason"), F.lit(layout).alias("layout")
    )
    return good, bad


def parse_flagged(
    df: DataFrame,
    layout: str,
    *,
    value: str = "value",
    sep: str = L.FIELD_SEP,
    on_short: str = "null",
    min_fields: int | None = None,
    keep: list[str] | None = None,
    batch_tag: str | Column | None = None,
) -> DataFrame:
    """Columns of ``layout`` plus ``_raw`` and ``_reason`` (null when the row is good).

    ``on_short='null'`` leaves the fields a short line lacks null; ``'quarantine'``
    marks lines below ``min_fields`` (all fields of the layout by default). Columns in
    ``keep`` are carried along, for example broker offsets.
    """
    if on_short not in ("null", "quarantine"):
        raise ValueError("on_short must be 'null' or 'quarantine'")
    names = L.LAYOUTS[layout]
    need = min_fields if min_fields is not None else len(names)
    lines = df.select(F.col(value).cast("string").alias("_raw"), *(keep or []))
    # Where an empty field is a missing one, those at the end need no stripping.
    split = split_lines(
        lines, {"_raw": "_parts"}, sep, keep_trailing=layout in L.EMPTY_IS_MISSING and on_short == "null"
    )
    count = F.coalesce(F.size("_parts"), F.lit(0))
    reason = F.when(F.col("_raw").isNull(), F.lit("no line"))
    if on_short == "quarantine":
        reason = reason.when(count < need, F.lit("too few fields"))
    columns = _fields(F.col("_parts"), names, layout in L.EMPTY_IS_MISSING)
    if batch_tag is not None:
        tag = batch_tag if isinstance(batch_tag, Column) else F.lit(batch_tag)
        columns.append(tag.alias("offset_tag"))
    return split.select("_raw", *columns, *(keep or []), reason.alias("_reason"))


def parse_lines(df: DataFrame, layout: str, **options) -> tuple[DataFrame, DataFrame]:
    return part_flagged(parse_flagged(df, layout, **options), layout)


def parse_archive_flagged(df: DataFrame, kind: str, keep: list[str] | None = None) -> DataFrame:
    """Take the two quoted cells ``info`` and ``info1`` of an archived record apart."""
    rest = L.ARCHIVE_REST[kind]
    bare = df.select(
        "info", "info1", drop_outer_quotes("info").alias("_u"), drop_outer_quotes("info1").alias("_r"),
        *(keep or []),
    )
    cells = split_lines(bare, {"_u": "_user", "_r": "_rest"}, L.CELL_SEP)
    reason = (
        F.when(F.col("info").isNull() | F.col("info1").isNull(), F.lit("cell missing"))
        .when(F.size("_user") > len(L.ARCHIVE_USER), F.lit("too many fields"))
        .when(F.size("_rest") > len(rest), F.lit("too many fields"))
    )
    columns = _fields(F.col("_user"), L.ARCHIVE_USER) + _fields(F.col("_rest"), rest)
    raw = F.concat(
        F.coalesce("info", F.lit("")), F.lit("<<>>"), F.coalesce("info1", F.lit(""))
    )
    return cells.select(raw.alias("_raw"), *columns, *(keep or []), reason.alias("_reason"))


def parse_archive(df: DataFrame, kind: str, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Archived records as columns; for vendor records just those a rollup needs."""
    good, bad = part_flagged(parse_archive_flagged(df, kind, keep), f"archive_{kind}")
    if kind == "fusion":
        good = good.select(*L.ARCHIVE_BAND, *(keep or []))
    return good, bad


def sql42_columns(suffix_month: str | None = None) -> list[Column]:
    """Id, file day and lower-case firm of a vendor record.

    File days in ``suffix_month``, if one is named, get the suffix ``-1``.
    """
    stamp = F.try_element_at(F.split("file_name", "_"), F.lit(3))
    day = F.substring(stamp, 1, 8)
    if suffix_month:
        day = F.when(F.substring(stamp, 1, 6) == suffix_month, F.concat(day, F.lit("-1"))).otherwise(day)
    return [
        F.md5(F.concat(F.col("file_name"), F.lit("-"), F.col("line_num"))).alias("id"),
        day.alias("filetime"),
        F.lower("firm_name").alias("lowfirmname"),
    ]


def parse_sql42_flagged(
    df: DataFrame, *, value: str = "value", sep: str = L.FIELD_SEP, suffix_month: str | None = None
) -> DataFrame:
    """Vendor lines as the 42 typed columns user SQL works on."""
    lines = df.select(F.col(value).cast("string").alias("_raw"))
    split = split_lines(lines, {"_raw": "_parts"}, sep)
    fields = split.select(
        "_raw", F.size("_parts").alias("_n"), *_fields(F.col("_parts"), L.VENDOR_37),
        *[F.try_element_at("_parts", F.lit(i)).alias(n) for i, n in ((39, "_f38"), (40, "_f39"))],
    )
    full = F.col("_n") == 40
    size = F.col("body_bytes_sent").try_cast("bigint")
    stamp = F.try_element_at(F.split("file_name", "_"), F.lit(3))
    reason = (
        F.when(F.coalesce("_n", F.lit(0)) < len(L.VENDOR_37), F.lit("too few fields"))
        .when(size.isNull(), F.lit("bad body_bytes_sent"))
        .when(F.coalesce(F.length(stamp), F.lit(0)) < 8, F.lit("no day in file_name"))
    )
    return fields.select(
        "_raw",
        *[size.alias(n) if n == "body_bytes_sent" else F.col(n) for n in L.VENDOR_37],
        *sql42_columns(suffix_month),
        F.when(full, F.col("_f38")).otherwise("").alias("rawdata"),
        F.when(full, F.col("_f39")).otherwise("").alias("except_desc"),
        reason.alias("_reason"),
    )


def parse_sql42(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    return part_flagged(parse_sql42_flagged(df, **options), "fusion_sql42")


# Fixed value: how a log line writes its local time.
TIME_LOCAL_PATTERN = "dd/MMM/yyyy:HH:mm:ss Z"


def druid_events(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """The 42 columns with ``time_local`` as an instant; unreadable times to quarantine."""
    return part_flagged(druid_events_flagged(df, **options), "druid_event")


def druid_events_flagged(df: DataFrame, **options) -> DataFrame:
    flagged = parse_sql42_flagged(df, **options)
    when = F.try_to_timestamp("time_local", F.lit(TIME_LOCAL_PATTERN))
    reason = F.coalesce("_reason", F.when(when.isNull(), F.lit("bad time_local")))
    return flagged.withColumns({"_reason": reason, "time_local": when})


def rank_input(
    df: DataFrame, *, value: str = "value", sep: str = L.FIELD_SEP, min_fields: int = 30
) -> tuple[DataFrame, DataFrame]:
    """The five fields a URL rank needs, by position; short lines to quarantine."""
    flagged = parse_flagged(
        df, "common34", value=value, sep=sep, on_short="quarantine", min_fields=min_fields
    )
    whole = F.col("time_unix").try_cast("bigint")
    seconds = F.when(log_time(whole).isNotNull(), whole)
    reason = F.coalesce("_reason", F.when(seconds.isNull(), F.lit("bad time_unix")))
    narrow = flagged.select(
        "_raw",
        seconds.alias("time_unix"),
        "domain",
        "request",
        "http_status",
        lenient("body_bytes_sent").alias("body_bytes_sent"),
        reason.alias("_reason"),
    )
    return part_flagged(narrow, "common34")


def package_lines(
    df: DataFrame, *, value: str = "value", index_name: str = "packages", index_type: str = "log"
) -> DataFrame:
    """Packaged quoted lines: four fields, an id of the first two, and the whole line."""
    lines = df.select(F.col(value).alias("body"))
    split = split_lines(lines, {"body": "_p"}, L.CELL_SEP, keep_trailing=True)
    field = lambda i: F.try_element_at("_p", F.lit(i + 1))
    return split.select(
        field(9).alias("X_Info_request_id"),
        field(21).alias("layer"),
        field(32).alias("time_local"),
        field(3).alias("time_unix"),
        "body",
        F.concat_ws("-", field(9), field(21)).alias("id"),
        F.lit(index_name).alias("index_name"),
        F.lit(index_type).alias("index_type"),
    )


def parse_row_key(df: DataFrame, *, row_key: str = "row_key", tz: str = "Asia/Shanghai") -> DataFrame:
    """File hash and five-minute bucket of ``salt#!minute#!firm#md5#line`` keys."""
    taken = df.select(
        F.split_part(row_key, F.lit("#!"), F.lit(2)).alias("_minute"),
        F.split_part(F.split_part(row_key, F.lit("#!"), F.lit(3)), F.lit("#"), F.lit(2)).alias("file_md5"),
    )
    return taken.select("file_md5", floor_to(parse_epoch("_minute", "yyyyMMddHHmm", tz), 300).alias("from_time"))
