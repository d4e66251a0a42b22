"""Currency normalisation and readiness for conversion, from one classification of the written text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrom.config import CURRENCY_ALIASES, HOME_CURRENCY

#: How a currency may be written: a code of three letters, a code of three digits, anything else, or not at all.
LETTERS, DIGITS, OTHER, NOTHING = "letters", "digits", "other", "nothing"


def classified(col: Column) -> Column:
    """``struct(written, form, home)``: the text in upper case without blanks around it, its form, and whether it names the
    home currency. ``form`` and ``home`` are never null."""
    written = F.upper(F.trim(col))
    form = F.when(F.coalesce(written, F.lit("")) == "", NOTHING).when(written.rlike("^[A-Z]{3}$"), LETTERS).when(written.rlike("^[0-9]{3}$"), DIGITS).otherwise(OTHER)
    return F.struct(written.alias("written"), form.alias("form"), F.coalesce(written.isin(HOME_CURRENCY, *CURRENCY_ALIASES), F.lit(False)).alias("home"))


def clean_currency(col: Column) -> Column:
    """Aliases of the home currency become its code; anything else passes in upper case."""
    c = classified(col)
    return F.when(c["home"], F.lit(HOME_CURRENCY)).otherwise(c["written"])


def is_variant(col: Column, reference: bool = True) -> Column:
    """An alias of the home currency. Without ``reference`` its code in other letters or with blanks is one, too."""
    c = classified(col)
    plain = c["written"] == HOME_CURRENCY if reference else col == HOME_CURRENCY
    return c["home"] & ~F.coalesce(plain, F.lit(False))


def readiness_columns(col: Column) -> dict[str, Column]:
    """All readiness columns by name. A foreign currency must be converted; it can be if its form is that of a code."""
    c = classified(col)
    written, form = c["written"], c["form"]
    foreign = (form != NOTHING) & ~c["home"]
    return {
        "currency_raw": col,
        "currency_clean": clean_currency(col),
        "currency_iso_candidate": F.when(form == LETTERS, written),
        "currency_numeric_candidate": F.when(form == DIGITS, written),
        "currency_conversion_required": foreign,
        "currency_conversion_ready": foreign & (form != OTHER),
        "currency_unknown": foreign & (form == OTHER),
    }
