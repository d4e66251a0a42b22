"""Readable amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An optional sign, one to sixteen ASCII digits, optionally a point with one or two digits; blanks around it.
READABLE = r"^[ \t]*[+-]?[0-9]{1,16}(\.[0-9]{1,2})?[ \t]*\z"


def is_blank(col: Column) -> Column:
    """Null, or nothing but white space. Never null."""
    return F.coalesce(col.rlike(r"^\s*\z"), F.lit(True))


def is_readable(col: Column) -> Column:
    """Whether a text is a readable amount; null counts as unreadable. Never null."""
    return F.coalesce(col.rlike(READABLE), F.lit(False))


def amount(col: Column) -> Column:
    """The amount of a readable text as decimal(18,2), else null."""
    return F.when(is_readable(col), F.trim(F.translate(col, "\t", " ")).try_cast("decimal(18,2)"))
