"""Dates without a time zone: ``TIMESTAMP_NTZ`` in, ``TIMESTAMP_NTZ`` out."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the formats in the notice files ---------------------------
CREATED = "%Y/%m/%d%H:%M"
MODIFIED = "%Y/%m/%d %H:%M"
ISO_SECONDS = "%Y-%m-%d %H:%M:%S"
ISO_MINUTES = "%Y-%m-%d %H:%M"
SLASH_SECONDS = "%Y/%m/%d %H:%M:%S"

# What each directive accepts; one- and two-digit fields are both fine, and a
# one-digit day may have a blank before it.
_DIRECTIVES = {
    "%Y": r"(?!0000)([0-9]{4})",
    "%m": r"(1[0-2]|0[1-9]|[1-9])",
    "%d": r"(?:(3[01]|[12][0-9]|0[1-9]|[1-9])| ([1-9]))",
    "%H": r"(2[0-3]|[01][0-9]|[0-9])",
    "%M": r"([0-5][0-9]|[0-9])",
    "%S": r"([0-5][0-9]|[0-9])",
}


def _pattern(fmt: str) -> str:
    parts = [p for p in re.split(r"(%[YmdHMS]| +)", fmt) if p]
    body = "".join(_DIRECTIVES.get(p, r"\s+" if p.isspace() else re.escape(p)) for p in parts)
    return rf"^{body}\z"


def parse(text: Column, fmt: str) -> Column:
    """Parse by a format with year, month, day, hour, minute and maybe second.

    Text that does not fit the whole format, or names no real day, is NULL. The
    rewritten text holds a ``T``, which no format does, so text that comes back
    as it was did not fit.
    """
    iso = "$1-$2-$3$4T$5:$6" + (":$7" if "%S" in fmt else "")
    rewritten = F.regexp_replace(text, _pattern(fmt), iso)
    return F.nullif(rewritten, text).try_cast("timestamp_ntz")


def parse_either(text: Column, first: str, second: str) -> Column:
    """The first format, or else the second, row by row."""
    return F.coalesce(parse(text, first), parse(text, second))


def parse_column(name: str, text: Column) -> Column:
    """The pair of formats that goes with a (folded) header name."""
    if "Vigencia" in name or "Publicacion" in name:
        return parse_either(text, ISO_SECONDS, ISO_MINUTES)
    if "Fecha" in name:
        return parse_either(text, ISO_SECONDS, SLASH_SECONDS)
    return text


def moment(value: datetime | str) -> Column:
    """A literal without a zone, folded to a constant so that it reaches the scan."""
    text = value if isinstance(value, str) else value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(text).cast("timestamp_ntz")


def to_second(ts: Column) -> Column:
    return F.date_trunc("second", ts).cast("timestamp_ntz")


def midnight_before(as_of: datetime | str, days: int) -> Column:
    """Midnight of the day ``days`` days before ``as_of``."""
    day = F.date_sub(moment(as_of).cast("date"), days)
    return day.cast("timestamp_ntz")


def run_partition(ts: Column) -> Column:
    """``struct(year, month)`` of the run, six hours behind the clock."""
    local = ts - F.expr("INTERVAL 6 HOURS")
    return F.struct(
        F.date_format(local, "yyyy").alias("year"), F.date_format(local, "MM").alias("month")
    )


def log_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd HH:mm:ss")
