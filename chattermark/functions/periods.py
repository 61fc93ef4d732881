"""Periods: the time slots in which comments are counted.

A period is given by a MySQL date format such as ``%Y-%m-%d %H:%i``. Rows are
grouped by a *slot*, which identifies the period, and the slot is turned into
text only after the grouping. When the format spells a whole date down to some
unit, the slot is the number of that unit since 1970 (years and months since
the year 0), eight bytes to hash and shuffle; for any other format it is the
text itself.

Comment times have no zone, and nothing here lets them pass through one: they
are taken apart into date, hour, minute and second, so clock changes of the
session's zone play no part.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# MySQL date format codes, the part each stands for and its width (0: no padding).
FORMAT_CODES = {
    "%Y": ("year", 4),
    "%y": ("short_year", 2),
    "%m": ("month", 2),
    "%c": ("month", 0),
    "%d": ("day", 2),
    "%e": ("day", 0),
    "%H": ("hour", 2),
    "%k": ("hour", 0),
    "%i": ("minute", 2),
    "%s": ("second", 2),
    "%S": ("second", 2),
}

# Finest code of a format -> unit, valid when all coarser codes are there too.
_UNITS = (
    ("%Y", "year"),
    ("%m", "month"),
    ("%d", "day"),
    ("%H", "hour"),
    ("%i", "minute"),
    ("%s", "second"),
)

# Units in which one user seldom comments twice under one video.
SHORT_UNITS = ("hour", "minute", "second")


# How many of a unit a day has, for units shorter than it.
_PER_DAY = {"day": 1, "hour": 24, "minute": 24 * 60, "second": 24 * 60 * 60}


def format_tokens(period_format: str) -> list[str]:
    """The codes of a format and the text between them."""
    tokens = re.findall(r"%.?|[^%]+", period_format, flags=re.DOTALL)
    for token in tokens:
        if token.startswith("%") and token != "%%" and token not in FORMAT_CODES:
            raise ValueError(f"unsupported code {token!r} in period format {period_format!r}")
    return tokens


def _date_parts(date: Column) -> dict[str, Column]:
    year = F.year(date)
    return {
        "year": year,
        "short_year": F.pmod(year, F.lit(100)),
        "month": F.month(date),
        "day": F.dayofmonth(date),
    }


def _spelled(parts: dict[str, Column], period_format: str) -> Column:
    """The period as text, from the parts of a time."""
    pieces = []
    for token in format_tokens(period_format):
        if token in FORMAT_CODES:
            part, width = FORMAT_CODES[token]
            text = parts[part].cast("string")
            pieces.append(F.lpad(text, width, "0") if width else text)
        else:
            pieces.append(F.lit("%" if token == "%%" else token))
    return F.concat(*pieces) if pieces else F.lit("")


def slot_unit(period_format: str) -> str | None:
    """Unit to truncate to, or None when the format skips part of the date."""
    used = {code.replace("%S", "%s") for code in re.findall(r"%[^%]", period_format)}
    for depth in range(1, len(_UNITS) + 1):
        if used == {code for code, _ in _UNITS[:depth]}:
            return _UNITS[depth - 1][1]
    return None


def slot(timestamp: str | Column, period_format: str) -> Column:
    """Grouping key of the period a timestamp falls in."""
    ts = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    date = ts.cast("date")
    unit = slot_unit(period_format)
    if unit == "year":
        return F.year(date).cast("long")
    if unit == "month":
        return F.year(date).cast("long") * 12 + F.month(date) - 1
    if unit == "day":
        return F.unix_date(date).cast("long")
    if unit:
        count = F.unix_date(date).cast("long") * 24 + F.hour(ts)
        for finer, part in (("minute", F.minute), ("second", F.second)):
            if _PER_DAY[unit] >= _PER_DAY[finer]:
                count = count * 60 + part(ts)
        return count
    parts = {"hour": F.hour(ts), "minute": F.minute(ts), "second": F.second(ts)}
    return F.when(ts.isNotNull(), _spelled({**_date_parts(date), **parts}, period_format))


def slot_text(slot_column: str | Column, period_format: str) -> Column:
    """The period as text, from its slot."""
    key = F.col(slot_column) if isinstance(slot_column, str) else slot_column
    unit = slot_unit(period_format)
    if unit is None:
        return key
    if unit == "year":
        return _spelled({"year": key}, period_format)
    if unit == "month":
        year = F.floor(key / 12)
        return _spelled({"year": year, "month": key - year * 12 + 1}, period_format)
    per_day = _PER_DAY[unit]
    days = F.floor(key / per_day)
    left = key - days * per_day  # units since midnight
    parts = _date_parts(F.date_from_unix_date(days.cast("int")))
    for name in ("hour", "minute", "second"):
        if per_day >= _PER_DAY[name]:
            here = per_day // _PER_DAY[name]
            per_larger = 24 if name == "hour" else 60
            parts[name] = F.pmod(F.floor(left / here), F.lit(per_larger))
    return _spelled(parts, period_format)


def month_text(slot_column: str | Column, period_format: str) -> Column:
    """First seven characters of the period, `yyyy-MM` for formats that start with it."""
    return F.substring(slot_text(slot_column, period_format), 1, 7)
