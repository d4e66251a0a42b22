"""Reading date and time texts. Pure Python over single strings: it runs once per distinct text (see operators.instants).

``read_date`` and ``read_time`` return ``(kind, day, micros, offset, zone)`` or None if the text resolves to nothing.

=========  ====================================================================
kind       meaning
=========  ====================================================================
date       a calendar date: ``day`` counts from 1970-01-01
local      a date-time: ``day`` and ``micros`` of the day, in ``zone`` or in the default zone
instant    ``micros`` since 1970-01-01T00:00Z
time       a time of day: ``micros``, perhaps with ``offset`` seconds or a ``zone``
=========  ====================================================================
"""

from __future__ import annotations

import re
from datetime import date
from functools import lru_cache
from zoneinfo import available_timezones

DAY = 86_400_000_000
EPOCH = date(1970, 1, 1).toordinal()
MONTHS = {m: i for i, m in enumerate(("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"), 1)}
LONG_MONTHS = {m: i for i, m in enumerate(("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"), 1)}

_YMD = re.compile(r"([0-9]{4})([-/.])([0-9]{1,2})\2([0-9]{1,2})")
_DMY = re.compile(r"([0-9]{1,2})([-/.])([0-9]{1,2})\2([0-9]{4})")
_DBY = re.compile(r"([0-9]{1,2})[ -]([A-Za-z]{3,9})\.?[ ,-]{1,2}([0-9]{4})")
_BDY = re.compile(r"([A-Za-z]{3,9})\.? ([0-9]{1,2}),? ([0-9]{4})")
_JOINED = re.compile(r"([0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}|[0-9]{8})(?:[Tt]| +)(.+)", re.S)
_CLOCK = re.compile(r"([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]{1,9}))?)?")
_COMPACT = re.compile(r"([0-9]{2})([0-9]{2})([0-9]{2})(?:\.([0-9]{1,9}))?")
_OFFSET = re.compile(r"([+-])([0-9]{2}):?([0-9]{2})?")
_HALF = re.compile(r"(.*?) ?([AaPp])\.?[Mm]\.?")


def _day(y: str, m: int | str, d: str) -> int | None:
    try:
        return date(int(y), int(m), int(d)).toordinal() - EPOCH
    except ValueError:
        return None


def _calendar(s: str) -> int | None:
    """The day of a date text without a time."""
    if m := _YMD.fullmatch(s):
        return _day(m[1], m[3], m[4])
    if m := _DMY.fullmatch(s):
        return _day(m[4], m[3], m[1])
    if m := _DBY.fullmatch(s):
        d, name, y = m.groups()
    elif m := _BDY.fullmatch(s):
        name, d, y = m.groups()
    elif len(s) == 8 and s.isascii() and s.isdigit():
        return _day(s[:4], s[4:6], s[6:])
    else:
        return None
    month = MONTHS.get(name.lower()) or LONG_MONTHS.get(name.lower())
    return month and _day(y, month, d)


def _micros(h: str | int, m: str, s: str | None, frac: str | None) -> int | None:
    hour, minute, second = int(h), int(m), int(s or 0)
    if hour > 23 or minute > 59 or second > 59:
        return None
    return ((hour * 60 + minute) * 60 + second) * 1_000_000 + int((frac or "0")[:6].ljust(6, "0"))


@lru_cache(maxsize=4)
def _zones(allowed: frozenset[str] | None) -> frozenset[str]:
    known = frozenset(z for z in available_timezones() if "/" in z)
    return known & allowed if allowed else known


def read_time(text: str | None, allowed: frozenset[str] | None = None) -> tuple | None:
    """A time of day, perhaps with an offset or the name of a zone (one of ``allowed``, if given)."""
    s = (text or "").strip()
    offset: int | None = None
    zone: str | None = None
    if s[-1:] in "Zz" and s[:-1].rstrip()[-1:].isdigit():
        s, offset = s[:-1].rstrip(), 0
    elif s.upper().endswith((" UTC", " GMT")):
        s, offset = s[:-4].rstrip(), 0
    elif m := re.fullmatch(r"(.*[0-9AaPpMm.]) +([A-Za-z_]+(?:/[A-Za-z_+\-0-9]+)+)", s):
        s, zone = m[1], m[2]
        if zone not in _zones(allowed):
            return None
    elif (m := re.fullmatch(r"(.+?) ?([+-][0-9]{2}(?::?[0-9]{2})?)", s)) and (o := _OFFSET.fullmatch(m[2])):
        hours, minutes = int(o[2]), int(o[3] or 0)
        if hours > 18 or minutes > 59 or hours * 60 + minutes > 18 * 60:
            return None
        s, offset = m[1], (hours * 3600 + minutes * 60) * (-1 if o[1] == "-" else 1)
    if (h := _HALF.fullmatch(s)) and (c := _CLOCK.fullmatch(h[1])):
        if not 1 <= int(c[1]) <= 12:
            return None
        micros = _micros(int(c[1]) % 12 + 12 * (h[2] in "Pp"), c[2], c[3], c[4])
    elif (c := _CLOCK.fullmatch(s)) or (c := _COMPACT.fullmatch(s)):
        micros = _micros(*c.groups())
    else:
        return None
    return None if micros is None else ("time", None, micros, offset, zone)


def read_date(text: str | None, allowed: frozenset[str] | None = None) -> tuple | None:
    """A date, a date-time or an instant."""
    s = (text or "").strip()
    if s.isascii() and s.isdigit() and len(s) in (10, 13, 16):
        return ("instant", None, int(s) * 10 ** (16 - len(s)), None, None)
    day = _calendar(s)
    if day is not None:
        return ("date", day, None, None, None)
    if (m := _JOINED.fullmatch(s)) and (day := _calendar(m[1])) is not None and (t := read_time(m[2], allowed)):
        _, _, micros, offset, zone = t
        if offset is not None:
            return ("instant", None, day * DAY + micros - offset * 1_000_000, None, None)
        return ("local", day, micros, None, zone)
    return None
