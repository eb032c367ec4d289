"""Posting dates and report days. ``as_of`` is always a parameter, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapwatch.functions.text import first_digits

# The Hebrew time units as the boards write them (some with vowel points) and "a minute ago".
DAY_UNITS = ("יְוֹם", "ימים")
CLOCK_UNITS = ("שְׁנִיָה", "שניות", "דַקָה", "דקות", "שָׁעָה", "שעות")
A_MINUTE_AGO = "לפני דקה"

# What a log's name begins with, and the three date layouts (data, file names, dump prefix).
DATA_DAY = "dd/MM/yyyy"
FILE_DAY = "yyyy_MM_dd"
DUMP_DAY = "dd-MM-yy"
LOG_PREFIX = "scrapy_log_output_"


def _holds_any(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


def relative_date(text: Column, as_of: dt.date, otherwise_today: bool = False) -> Column:
    """A text such as "5 days ago" as ``dd/MM/yyyy``.

    The first number counts. Days are taken off ``as_of``, clock units mean ``as_of`` itself, and
    any other text with a number (0 included) stays as it is. Without a number, or with more days
    than the calendar has, the result is ``as_of`` for "a minute ago" and else the empty string, or
    ``as_of`` where the board asks for that.
    """
    today = F.lit(as_of.strftime("%d/%m/%Y"))
    digits = first_digits(text)
    unreadable = today if otherwise_today else F.when(text == A_MINUTE_AGO, today).otherwise("")
    n = digits.try_cast("int")
    in_calendar = F.coalesce(n < as_of.toordinal(), F.lit(False))
    return (
        F.when(digits.isNull() | text.isNull(), unreadable)
        .when(~digits.rlike("[1-9]"), text)
        .when(
            _holds_any(text, DAY_UNITS),
            F.when(in_calendar, F.date_format(F.date_sub(F.lit(as_of), n), "dd/MM/y")).otherwise(unreadable),
        )
        .when(_holds_any(text, CLOCK_UNITS), today)
        .otherwise(text)
    )


# A clock time with an optional zone, as it may follow a date.
_CLOCK = r"(?:[T ]+[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?\s*(?:[AaPp][Mm])?\s*(?:Z|GMT|UTC|[+-][0-9]{2}:?[0-9]{2})?)?\s*$"
_YEAR_FIRST = r"^\s*([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})" + _CLOCK
_YEAR_LAST = r"^\s*([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{4})" + _CLOCK
_PLAIN = r"^\s*([0-9]{4})([0-9]{2})([0-9]{2})" + _CLOCK
_SHORT_YEAR_LAST = r"^\s*([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{2})" + _CLOCK
_COMPACT = r"^\s*([0-9]{4})([0-9]{2})([0-9]{2})[T ]?[0-9]{4}(?:[0-9]{2})?(?:Z|[+-][0-9]{2}:?[0-9]{2})?\s*$"
_WEEKDAY = r"^\s*(?:[A-Za-z]{3,9}\.?,?\s+)?"
_DAY_NAMED = _WEEKDAY + r"([0-9]{1,2})(?:st|nd|rd|th)?[-/. ]+([A-Za-z]{3})[a-z]*\.?[-/., ]+([0-9]{4})" + _CLOCK
_DAY_NAMED_SHORT = _WEEKDAY + r"([0-9]{1,2})(?:st|nd|rd|th)?[-/. ]+([A-Za-z]{3})[a-z]*\.?[-/., ]+([0-9]{2})" + _CLOCK
_NAMED_MONTH = r"^\s*([A-Za-z]{3})[a-z]*\.?,?[- ]+([0-9]{4})\s*$"
_NAMED_DAY = _WEEKDAY + r"([A-Za-z]{3})[a-z]*\.?\s+([0-9]{1,2})(?:st|nd|rd|th)?,?\s+([0-9]{4})" + _CLOCK


def _ymd(text: Column, pattern: str, year: int, month: int, day: int, layout: str = "yyyy-M-d") -> Column:
    parts = [F.regexp_extract(text, pattern, g) for g in (year, month, day)]
    return F.try_to_date(F.concat_ws("-", *(F.initcap(p) for p in parts)), layout)


def _of_month(text: Column, as_of: dt.date) -> Column:
    """A month and a year: the day of the month is that of ``as_of``, or the month's last day before it."""
    first = F.try_to_date(
        F.concat_ws("-", F.regexp_extract(text, _NAMED_MONTH, 2), F.initcap(F.regexp_extract(text, _NAMED_MONTH, 1))), "yyyy-MMM"
    )
    return F.least(F.date_add(first, as_of.day - 1), F.last_day(first))


def parse_day(text: Column, as_of: dt.date | None = None) -> Column:
    """The calendar day written in ``text`` (the zone does not shift it), NULL when there is none.

    Two numbers before the year are read month first, and day first where that is no date; a year of two digits is
    one of 2000 to 2099. A month without a day needs ``as_of``.
    """
    short = "yy-M-d"
    return F.coalesce(
        _ymd(text, _YEAR_FIRST, 1, 2, 3),
        _ymd(text, _YEAR_LAST, 3, 1, 2),
        _ymd(text, _YEAR_LAST, 3, 2, 1),
        _ymd(text, _PLAIN, 1, 2, 3),
        _ymd(text, _DAY_NAMED, 3, 2, 1, "yyyy-MMM-d"),
        _ymd(text, _NAMED_DAY, 3, 1, 2, "yyyy-MMM-d"),
        _ymd(text, _SHORT_YEAR_LAST, 3, 1, 2, short),
        _ymd(text, _SHORT_YEAR_LAST, 3, 2, 1, short),
        _ymd(text, _COMPACT, 1, 2, 3),
        _ymd(text, _DAY_NAMED_SHORT, 3, 2, 1, "yy-MMM-d"),
        *([_of_month(text, as_of)] if as_of else []),
    )


def unread_date(text: Column, as_of: dt.date) -> Column:
    """Whether ``post_date`` puts ``as_of`` in place of a text that it can't read; a missing text is not unread."""
    return F.coalesce(F.trim(text) != "", F.lit(False)) & parse_day(text, as_of).isNull()


def post_date(text: Column, as_of: dt.date) -> Column:
    """An absolute date as ``dd/MM/yyyy``, ``as_of`` when it cannot be read."""
    return F.date_format(F.coalesce(parse_day(text, as_of), F.lit(as_of)), DATA_DAY)


def to_day(text: Column, layout: str = DATA_DAY) -> Column:
    return F.try_to_date(text, layout)


def last_days(as_of: dt.date, n: int) -> list[dt.date]:
    """The ``n`` days that end with ``as_of``, newest first."""
    return [as_of - dt.timedelta(days=i) for i in range(n)]


def artifact_day(name: Column) -> Column:
    """The date text in a file name, in the file layout: log prefix cut, first ten characters, ``-`` as ``_``."""
    return F.translate(F.substring(F.replace(name, F.lit(LOG_PREFIX), F.lit("")), 1, 10), "-", "_")
