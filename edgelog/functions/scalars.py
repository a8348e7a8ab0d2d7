"""Scalar column expressions: lenient numbers, addresses, text and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from edgelog.functions.times import EPOCH_RANGE, column


def lenient(x, type_: str = "double", default=0) -> Column:
    """Cast that gives ``default`` where the value is missing or no number."""
    return F.coalesce(column(x).try_cast(type_), F.lit(default).cast(type_))


def text_or_zero(x) -> Column:
    return F.coalesce(column(x).cast("string"), F.lit("0"))


def null_safe_add(a, b) -> Column:
    return lenient(a) + lenient(b)


def finite(x) -> Column:
    """Cast to double, null where the text is no number a bigint could hold."""
    d = column(x).try_cast("double")
    return F.when(F.abs(d) < F.lit(2.0**63), d)


def log_time(x) -> Column:
    """Epoch seconds of a record; null where it is no number or outside the years 1970 to 9999.

    Milliseconds sent as seconds fall outside and so reach the quarantine.
    """
    d = finite(x)
    return F.when((d >= EPOCH_RANGE[0]) & (d < EPOCH_RANGE[1]), d)


def dash_to_zero(x) -> Column:
    """Missing or ``-`` gives 0, other text its number, bad text null."""
    c = F.coalesce(column(x).cast("string"), F.lit("0"))
    return F.when(c == "-", F.lit(0.0)).otherwise(finite(c))


def ip_to_long(x) -> Column:
    """Dotted IPv4 text as a number; null where it has not four octets of 0 to 255."""
    octets = F.split(column(x), r"\.")
    total = F.lit(0).cast("bigint")
    for i in range(4):
        octet = F.try_element_at(octets, F.lit(i + 1)).try_cast("bigint")
        total = total * 256 + F.when(octet.between(0, 255), octet)
    return F.when(F.size(octets) == 4, total)


def long_to_ip(x) -> Column:
    n = column(x)
    octet = lambda shift: F.shiftright(n, shift).bitwiseAND(F.lit(255).cast("bigint"))
    return F.concat_ws(".", *[octet(s).cast("string") for s in (24, 16, 8, 0)])


def ip_to_int(x) -> Column:
    """Same address as a signed 32-bit number."""
    n = ip_to_long(x)
    return F.when(n >= 2**31, n - 2**32).otherwise(n).cast("int")


def int_to_long(x) -> Column:
    """Signed 32-bit address back to its unsigned number."""
    return F.pmod(column(x).cast("bigint"), F.lit(2**32))


def drop_outer_quotes(x) -> Column:
    return F.regexp_replace(column(x), '^"|"$', "")


def json_map(x, value_type: str = "string") -> Column:
    return F.from_json(column(x), f"map<string,{value_type}>")


def quoted(cols) -> Column:
    """Quote every value and part them with single spaces."""
    return F.concat(F.lit('"'), F.concat_ws('" "', *cols), F.lit('"'))
