"""Composite parsers of the medallion pipeline. None of them fails on bad input under ANSI rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def is_blank(col: Column) -> Column:
    """Null or nothing but spaces."""
    return col.isNull() | (F.trim(col) == "")


def parse_date(col: Column, strict: bool = False) -> Column:
    """ISO date, dd/MM/yyyy, or an epoch: 13 digits are milliseconds, any other number seconds.

    With ``strict`` only 9 or 10 digits are an epoch in seconds, so that 20241231 is not read as a day in 1970.
    """
    s = F.trim(col)
    seconds = s.try_cast("double").try_cast("long")
    epoch = F.when(s.rlike(r"^[0-9]{13}$"), F.floor(s.try_cast("long") / 1000)).when(s.rlike(r"^[0-9]{9,10}$" if strict else _NUMBER), seconds)
    day = F.when(epoch.between(-62135596800, 253402300799), F.to_date(F.timestamp_seconds(epoch)))
    turned = F.concat_ws("-", F.substring(s, 7, 4), F.substring(s, 4, 2), F.substring(s, 1, 2))
    return F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), s.try_cast("date")).when(s.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), turned.try_cast("date")).otherwise(day)


def parse_timestamp(date_col: Column, time_col: Column, strict: bool = False) -> Column:
    """The parsed date with a HH:mm:ss time; a null time is midnight, an unreadable one gives null."""
    t = F.coalesce(F.trim(time_col), F.lit("00:00:00"))
    fine = t.rlike(r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$")
    part = lambda at: F.substring(t, at, 2).try_cast("int")
    return F.when(fine, F.timestamp_seconds(F.unix_date(parse_date(date_col, strict)).cast("long") * 86_400 + part(1) * 3_600 + part(4) * 60 + part(7)))


def is_date_variant(col: Column, strict: bool = False) -> Column:
    """A date text that is not ISO. By default blanks and unreadable texts count, too; with ``strict`` it must parse."""
    variant = col.isNotNull() & ~F.coalesce(F.trim(col).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.lit(False))
    return variant & parse_date(col, True).isNotNull() if strict else variant


def is_quoted_amount(raw_json: Column) -> Column:
    """Whether the raw line writes its amount as a string."""
    return F.coalesce(raw_json.rlike(r'"amount"\s*:\s*"'), F.lit(False))


def age_band(dob: Column, as_of: Column, reference: bool = False) -> Column:
    """Age band on a day; under 18 and unknown are null (with ``reference``: the lowest band)."""
    years = F.floor(F.months_between(as_of, dob) / 12)
    lowest = F.lit("18-25") if reference else F.when(years >= 18, "18-25")
    bands = ((65, "65+"), (56, "56-65"), (46, "46-55"), (36, "36-45"), (26, "26-35"))
    band = lowest
    for least, name in reversed(bands):
        band = F.when(years >= least, name).otherwise(band)
    return band
