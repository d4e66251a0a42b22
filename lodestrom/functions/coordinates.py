"""Free-text coordinates and distances on a sphere, as JVM expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
#: Latitude and longitude of a usable point.
LAT_RANGE, LON_RANGE = (-35.0, -22.0), (16.0, 33.0)

_NUM = r"[+-]?[0-9]{1,3}(?:\.[0-9]+)?"
_PART = r"([NSEW])?\s*([+-]?[0-9]{1,3}(?:\.[0-9]+)?)(?:\s*[°º]\s*(?:([0-9]{1,2}(?:\.[0-9]+)?)\s*['′’]\s*(?:([0-9]{1,2}(?:\.[0-9]+)?)\s*(?:[\"″”]|'')\s*)?)?)?\s*([NSEW])?"
_PAIR = rf"^{_PART}(?:\s*[,;]\s*|\s+|(?<=[NSEW])(?=[NSEW]))_PART_\z".replace("_PART_", _PART)
_PLAIN = rf"^{_NUM} ?, ?{_NUM}\z"
_WKT = rf"^POINT\s*\(\s*({_NUM})\s+({_NUM})\s*\)\z"
#: One pass turns a text into its ten parts, each between bars, so that one regular expression is run once per row.
_SPLIT = "|".join(f"${i}" for i in range(1, 11))


def point_of(text: Column) -> Column:
    """``struct(lat, lon)`` of a usable coordinate text, else null.

    Latitude comes first unless hemisphere letters say otherwise; well-known text has longitude first; where a semicolon
    separates the numbers a comma is a decimal mark. Degrees may carry minutes and seconds below 60. Hemisphere letters
    must stand at both numbers, once each, one N/S and one E/W, and not beside a sign. The point must lie within
    ``LAT_RANGE`` and ``LON_RANGE``.
    """
    return let(F.upper(F.trim(text)), _point)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _point(s: Column) -> Column:
    """The common notation first, because it needs the simplest pattern; then all others."""
    plain = let(F.split(s, ","), lambda w: _within(F.struct(F.trim(F.get(w, 0)).try_cast("double").alias("lat"), F.trim(F.get(w, 1)).try_cast("double").alias("lon"))))
    return F.when(s.rlike(_PLAIN), plain).otherwise(_any_point(s))


def _within(f: Column) -> Column:
    return let(f, lambda p: F.when(p["lat"].between(*LAT_RANGE) & p["lon"].between(*LON_RANGE), p))


def _any_point(s: Column) -> Column:
    bare = F.regexp_replace(s, r"^\(\s*(.*?)\s*\)\z", "$1")
    pair = lambda t: F.when(t.rlike(_PAIR), F.split(F.regexp_replace(t, _PAIR, _SPLIT), r"\|", -1))
    parts = let(let(bare, lambda t: F.when(t.contains(";"), F.translate(t, ",", ".")).otherwise(t)), pair)
    wkt = F.when(s.startswith("POINT") & s.rlike(_WKT), F.split(F.regexp_replace(s, _WKT, "$1|$2"), r"\|"))
    as_point = lambda a, b: F.struct(a.alias("lat"), b.alias("lon"))
    from_wkt = let(wkt, lambda w: F.when(w.isNotNull(), as_point(F.get(w, 1).try_cast("double"), F.get(w, 0).try_cast("double"))))

    def number(p: Column, k: int) -> Column:
        """Letter and signed degrees of the k-th number; null if it is badly formed."""
        before, degrees, minutes, seconds, after = (F.get(p, 5 * k + i) for i in range(5))
        letter = F.concat(before, after)
        m, sec = F.coalesce(minutes.try_cast("double"), F.lit(0.0)), F.coalesce(seconds.try_cast("double"), F.lit(0.0))
        size = F.abs(degrees.try_cast("double")) + m / 60 + sec / 3600
        fine = (m < 60) & (sec < 60) & (F.length(letter) < 2) & ~((letter != "") & degrees.rlike("^[+-]")) & ~(degrees.contains(".") & (minutes != "")) & ~(minutes.contains(".") & (seconds != ""))
        return F.when(fine, F.struct(letter.alias("l"), F.when(degrees.startswith("-") | letter.isin("S", "W"), -size).otherwise(size).alias("v")))

    def ordered(n: Column) -> Column:
        (l1, v1), (l2, v2) = ((F.get(n, k)["l"], F.get(n, k)["v"]) for k in (0, 1))
        plain = ((l1 == "") & (l2 == "")) | (l1.isin("N", "S") & l2.isin("E", "W"))
        return F.when(plain, as_point(v1, v2)).when(l1.isin("E", "W") & l2.isin("N", "S"), as_point(v2, v1))

    found = let(let(parts, lambda p: F.when(p.isNotNull(), F.array(number(p, 0), number(p, 1)))), ordered)
    return _within(F.coalesce(from_wkt, found))


def with_points(df: DataFrame, text: Column) -> DataFrame:
    """The rows of ``df`` whose text is usable, with ``lat`` and ``lon``; each text is read once."""
    return df.select("*", F.inline(F.array_compact(F.array(point_of(text)))))


def sphere_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_M) -> Column:
    """Great-circle distance in metres (haversine)."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def letters_only(col: Column) -> Column:
    """Letters only, ignoring case."""
    return F.lower(F.regexp_replace(col, r"[^\p{L}]", ""))
