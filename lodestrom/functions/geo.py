"""Quality flags of ``lat,lon`` texts. These mark anomalies; :mod:`lodestrom.functions.coordinates` reads all notations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrom.config import COUNTRY_BOX, PROVINCE_BOXES
from lodestrom.functions.parse import is_blank


def _parts(text: Column) -> Column:
    return F.split(text, ",")


def latitude(text: Column) -> Column:
    return F.when(F.size(_parts(text)) == 2, F.get(_parts(text), 0).try_cast("double"))


def longitude(text: Column) -> Column:
    return F.when(F.size(_parts(text)) == 2, F.get(_parts(text), 1).try_cast("double"))


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    return lat.between(box[0], box[1]) & lon.between(box[2], box[3])


def flags(text: Column, province: Column, lat: Column, lon: Column, check_province: bool = True) -> dict[str, Column]:
    """Every anomaly as a boolean that is never null, in the order in which they are listed."""
    known = lat.isNotNull() & lon.isNotNull()
    home = in_box(lat, lon, COUNTRY_BOX)
    name = F.upper(F.trim(province))
    elsewhere = reduce(lambda a, b: a | b, ((name == p) & ~in_box(lat, lon, box) for p, box in PROVINCE_BOXES.items()))
    found = {
        "PARSE_FAILED": ~is_blank(text) & (lat.isNull() | lon.isNull()),
        "INVALID_WORLD_BOUNDS": known & ~(lat.between(-90, 90) & lon.between(-180, 180)),
        "ZERO_ZERO": (lat == 0) & (lon == 0),
        "POSSIBLE_LAT_LON_SWAP": lat.between(COUNTRY_BOX[2], COUNTRY_BOX[3]) & lon.between(COUNTRY_BOX[0], COUNTRY_BOX[1]),
        "SA_SIGN_MISMATCH": known & ~((lat == 0) & (lon == 0)) & lat.between(-90, 90) & lon.between(-180, 180) & ((lat >= 0) | (lon <= 0)),
        "OUTSIDE_SA_BOUNDS": known & ~((lat == 0) & (lon == 0)) & lat.between(-90, 90) & lon.between(-180, 180) & ~home,
        "PROVINCE_COORDINATE_MISMATCH": (home & elsewhere) if check_province else F.lit(False),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in found.items()}


def flag_text(found: dict[str, Column]) -> Column:
    """The flags joined by bars; null if there are none."""
    return F.nullif(F.concat_ws("|", *(F.when(v, F.lit(k)) for k, v in found.items())), F.lit(""))
