"""Time expressions that do not depend on the session time zone.

An epoch is turned into a zone-less timestamp in the wanted zone, so formatting and
parsing never pass through the session zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TZ = "Asia/Shanghai"
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
# Where each pattern token sits in the text form 'yyyy-MM-dd HH:mm:ss'.
_TOKENS = {
    "yyyy": (1, 4), "MM": (6, 2), "dd": (9, 2), "HH": (12, 2), "mm": (15, 2),
    "ss": (18, 2),
}
# The separator that follows each token in that form.
_AFTER = {"yyyy": "-", "MM": "-", "dd": " ", "HH": ":", "mm": ":"}
_TOKEN_RE = re.compile("yyyy|MM|dd|HH|mm|ss")
_DAY = 86400
#: Epoch seconds a log time may have: 1970 to the end of 9999, a day less for any zone.
EPOCH_RANGE = (0, 253402300800 - 86400)
# Seconds from a UTC midnight to the next midnight at UTC+8.
_UTC8_MIDNIGHT = 57600


def column(x) -> Column:
    """A column given by name or as itself."""
    return F.col(x) if isinstance(x, str) else x


def floor_to(x, seconds: int) -> Column:
    """Start of the bucket of ``seconds`` that holds epoch ``x``, as bigint."""
    t = column(x).try_cast("bigint")
    return t - t % F.lit(seconds)


def day_start_utc8(x) -> Column:
    """Epoch of the UTC+8 midnight at or before ``x``."""
    t = column(x).try_cast("bigint") - F.lit(_UTC8_MIDNIGHT)
    return t - F.pmod(t, F.lit(_DAY)) + F.lit(_UTC8_MIDNIGHT)


def local_time(x, tz: str = DEFAULT_TZ) -> Column:
    """Epoch seconds (whole or fractional) as a zone-less timestamp in ``tz``; null far outside
    the years a log can hold."""
    utc = F.timestamp_add("MILLISECOND", _millis(x), F.expr(_EPOCH))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def _millis(x) -> Column:
    """Epoch milliseconds; null where no text form with four digits of year exists."""
    seconds = column(x).cast("double")
    shown = (seconds >= -EPOCH_RANGE[1] // 10) & (seconds < EPOCH_RANGE[1])
    return F.when(shown, F.round(seconds * 1000)).try_cast("bigint")


def _seconds(ntz: Column) -> Column:
    """Seconds from 1970 to a zone-less timestamp. A difference of timestamps would pass
    through the session zone and shift times its clocks skip."""
    clock = F.hour(ntz) * 3600 + F.minute(ntz) * 60 + F.second(ntz)
    return F.unix_date(ntz.cast("date")).cast("bigint") * _DAY + clock


def fmt_epoch(x, pattern: str, tz: str = DEFAULT_TZ) -> Column:
    """Epoch seconds as text; ``pattern`` may use yyyy, MM, dd, HH, mm and ss."""
    text = local_time(x, tz).cast("string")
    span = _one_span(pattern)
    if span:
        start, length, old, new = span
        return F.translate(F.substring(text, start, length), old, new)
    parts, at = [], 0
    for m in _TOKEN_RE.finditer(pattern):
        if m.start() > at:
            parts.append(F.lit(pattern[at:m.start()]))
        parts.append(F.substring(text, *_TOKENS[m.group()]))
        at = m.end()
    if at < len(pattern):
        parts.append(F.lit(pattern[at:]))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _one_span(pattern: str) -> tuple[int, int, str, str] | None:
    """How to get a pattern by cutting the text form once and changing its separators.

    Possible when the tokens follow each other as in the text form and each kind of
    separator turns into one character or none. It saves converting the time once for
    every token.
    """
    found = list(_TOKEN_RE.finditer(pattern))
    order = list(_TOKENS)
    names = [m.group() for m in found]
    if not found or found[0].start() or found[-1].end() < len(pattern):
        return None
    first = order.index(names[0])
    if names != order[first:first + len(names)]:
        return None
    change: dict[str, str] = {}
    for left, right in zip(found, found[1:]):
        old = _AFTER[left.group()]
        new = pattern[left.end():right.start()]
        if len(new) > 1 or change.setdefault(old, new) != new:
            return None
    start = _TOKENS[names[0]][0]
    last_at, last_len = _TOKENS[names[-1]]
    kept = [o for o, n in change.items() if n] + [o for o, n in change.items() if not n]
    return start, last_at + last_len - start, "".join(kept), "".join(change[o] for o in kept)


def parse_epoch(x, pattern: str, tz: str = DEFAULT_TZ) -> Column:
    """Text in a fixed-width pattern as epoch seconds; null where it is no time."""
    src = column(x)
    part = {}
    for m in _TOKEN_RE.finditer(pattern):
        part[m.group()] = F.substring(src, m.start() + 1, m.end() - m.start())
    get = lambda token, default: part.get(token, F.lit(default))
    iso = F.concat(
        get("yyyy", "1970"), F.lit("-"), get("MM", "01"), F.lit("-"), get("dd", "01"),
        F.lit(" "), get("HH", "00"), F.lit(":"), get("mm", "00"), F.lit(":"),
        get("ss", "00"),
    )
    whole = F.when(F.length(src) == len(pattern), iso)
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), whole.try_cast("timestamp_ntz"))
    return _seconds(utc)


def iso_time(x, tz: str = DEFAULT_TZ) -> Column:
    """Epoch seconds as ``yyyy-MM-dd'T'HH:mm:ss.SSSZ`` in ``tz``."""
    local, millis = local_time(x, tz), _millis(x)
    utc = F.timestamp_add("MILLISECOND", millis, F.expr(_EPOCH))
    shift = ((_seconds(local) - _seconds(utc)) / 60).cast("int")
    sign = F.when(shift < 0, "-").otherwise("+")
    hours = F.lpad((F.abs(shift) / 60).cast("int").cast("string"), 2, "0")
    minutes = F.lpad((F.abs(shift) % 60).cast("string"), 2, "0")
    return F.concat(
        fmt_epoch(x, "yyyy-MM-ddTHH:mm:ss", tz), F.lit("."),
        F.lpad(F.pmod(millis, F.lit(1000)).cast("string"), 3, "0"), sign, hours, minutes,
    )


def minute_text(x, tz: str = DEFAULT_TZ) -> Column:
    return fmt_epoch(floor_to(x, 60), "yyyyMMddHHmm", tz)
