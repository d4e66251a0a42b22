"""Points near other points or regions.

*Regions*: crossing parity. Polygon edges are binned into latitude strips, each point meets the edges of its own strip
only, the crossings of its ray to the east are counted per point and region, and an odd count means inside. A strip
keeps the edges of one region together, so the join yields one row per point and region with all the edges its ray can
meet, and the grouped count needs no shuffle. A point on an edge or corner is handled explicitly: it belongs to the
region, and it is on an edge within ``TOUCH_DEG``, so that rounding does not decide on slanted edges. Edges are straight in degrees; a crossing is counted half-open in latitude, so a corner counts once.

*Points*: each centre covers the grid cells its radius touches, at a level of the grid that suits its radius; each
point looks up its own cell at each level in use. Distances are then checked on the sphere.

Both joins are equi-joins on a bin. The side of the places is counted and broadcast only below
``joins.BROADCAST_BYTES``; beyond it the bins are shuffled and adaptive execution splits crowded ones.

Defined results
---------------
* Points without coordinates, and places without position, radius or at least three corners, match nothing. NaN is no
  position. A ring may repeat its first corner at the end. Longitudes must not cross the date line.
* Repeated points each match; a repeated place matches once. Empty tables give empty results. Points need ``lat, lon``; all
  their other columns are carried in one struct, so that no name can clash, but for ``place_id``, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrom import scratch
from lodestrom.functions.coordinates import EARTH_M, sphere_distance
from lodestrom.operators.joins import broadcast_if_small

STRIP_DEG = 0.05
#: Edges of one region in one strip beyond which narrower strips are tried; points this near to an edge are on it (0.1 mm).
STRIP_EDGES, TOUCH_DEG = 512, 1e-9
BASE_RADIUS_M, LEVEL_FACTOR, BASE_CELL_DEG = 2_000.0, 8, 0.04


def _strip(lat: Column, height: float) -> Column:
    return F.floor(lat / F.lit(height)).cast("int")


def region_strips(regions: DataFrame, height: float = STRIP_DEG) -> DataFrame:
    """``strip, place_id, edges`` of regions given as ``place_id, ring`` (array of struct(lat, lon))."""
    ring = regions.where(F.size("ring") >= 3).dropDuplicates(["place_id"])
    corner = ring.select("place_id", F.explode(F.arrays_zip(F.col("ring").alias("a"), F.concat(F.slice("ring", 2, F.size("ring")), F.slice("ring", 1, 1)).alias("b"))).alias("e"))
    edge = corner.select("place_id", F.struct(F.col("e.a.lat").alias("y1"), F.col("e.a.lon").alias("x1"), F.col("e.b.lat").alias("y2"), F.col("e.b.lon").alias("x2")).alias("e"))
    edge = edge.where("(e.y1 <> e.y2 or e.x1 <> e.x2) and not isnan(e.y1 + e.x1 + e.y2 + e.x2)")
    low, high = _strip(F.least("e.y1", "e.y2"), height), _strip(F.greatest("e.y1", "e.y2"), height)
    in_strips = edge.withColumn("strip", F.explode(F.sequence(low, high)))
    return in_strips.groupBy("strip", "place_id").agg(F.collect_list("e").alias("edges"), F.min(F.least("e.x1", "e.x2")).alias("_west"), F.max(F.greatest("e.x1", "e.x2")).alias("_east"))


def fitting_strips(regions: DataFrame, height: float = STRIP_DEG) -> tuple[DataFrame, float]:
    """The strips of ``regions`` (written) and their height, which is halved as long as the most detailed border has more
    than ``STRIP_EDGES`` edges in one strip and narrower strips still help."""
    strips = scratch.materialise(region_strips(regions, height), "region-strips")
    most = strips.agg(F.coalesce(F.max(F.size("edges")), F.lit(0)).alias("n")).first()["n"]
    while most > STRIP_EDGES:
        finer = scratch.materialise(region_strips(regions, height / 2), "region-strips")
        fewer = finer.agg(F.max(F.size("edges")).alias("n")).first()["n"]
        if fewer > 0.8 * most:
            break
        strips, most, height = finer, fewer, height / 2
    return strips, height


def _crosses(e: Column, lat: Column, lon: Column) -> Column:
    straddles = (e["y1"] <= lat) != (e["y2"] <= lat)
    return straddles & (lon < e["x1"] + (lat - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) * (e["x2"] - e["x1"]))


def _touches(e: Column, lat: Column, lon: Column) -> Column:
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    near = lambda v, a, b: v.between(F.least(a, b) - TOUCH_DEG, F.greatest(a, b) + TOUCH_DEG)
    beside = F.abs((lon - e["x1"]) * dy - (lat - e["y1"]) * dx)
    return near(lat, e["y1"], e["y2"]) & near(lon, e["x1"], e["x2"]) & (beside <= F.lit(TOUCH_DEG) * F.sqrt(dx * dx + dy * dy))


def _packed(points: DataFrame) -> DataFrame:
    """``_point`` (the whole row), ``lat`` and ``lon`` of the points that have a position."""
    return points.where("lat is not null and lon is not null").select(F.struct(*(F.col(f"`{c}`") for c in points.columns if c != "place_id")).alias("_point"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))


def points_in_regions(points: DataFrame, regions: DataFrame, height: float = STRIP_DEG) -> DataFrame:
    """The columns of ``points`` (with ``lat, lon``) and ``place_id`` of each region that contains the point."""
    strips, height = fitting_strips(regions, height)
    side = broadcast_if_small(strips)
    lat, lon = F.col("lat"), F.col("lon")
    met = _packed(points).withColumn("strip", _strip(F.col("lat"), height)).join(side, "strip")
    # within a strip a region lies between the ends of its edges: no ray from elsewhere needs to be followed
    met = met.where(lon.between(F.col("_west") - TOUCH_DEG, F.col("_east") + TOUCH_DEG))
    crossings = F.size(F.filter("edges", lambda e: F.coalesce(_crosses(e, lat, lon), F.lit(False))))
    on_edge = F.exists("edges", lambda e: _touches(e, lat, lon))
    return met.where((crossings % 2 == 1) | on_edge).select("_point.*", "place_id")


def _level(radius: Column) -> Column:
    return F.greatest(F.ceil(F.log(float(LEVEL_FACTOR), radius / BASE_RADIUS_M)), F.lit(0)).cast("int")


def _cell(degrees: Column, level: Column) -> Column:
    return F.floor(degrees / (F.lit(BASE_CELL_DEG) * F.pow(F.lit(float(LEVEL_FACTOR)), level))).cast("int")


def points_near(points: DataFrame, centres: DataFrame) -> DataFrame:
    """The columns of ``points`` and ``place_id`` of each centre (``place_id, c_lat, c_lon, radius_m``) in reach."""
    good = centres.where("radius_m >= 0 and not isnan(c_lat + c_lon + radius_m)").dropDuplicates(["place_id"])
    level = F.when(F.col("radius_m") > 0, _level(F.col("radius_m"))).otherwise(0)
    dlat = F.degrees(F.col("radius_m") / EARTH_M) * 1.000001
    dlon = dlat / F.greatest(F.cos(F.radians(F.least(F.abs("c_lat") + dlat, F.lit(89.9)))), F.lit(0.001))
    span = lambda c, d: F.explode(F.sequence(_cell(F.col(c) - d, F.col("level")), _cell(F.col(c) + d, F.col("level"))))
    cells = good.withColumn("level", level).withColumn("cy", span("c_lat", dlat)).withColumn("cx", span("c_lon", dlon))
    cells = scratch.materialise(cells, "centre-cells")
    levels = sorted(r[0] for r in cells.select("level").distinct().collect())  # logarithm of the largest radius: a handful
    side = broadcast_if_small(cells)
    at = _packed(points).withColumn("level", F.explode(F.array(*map(F.lit, levels or [0]))))
    at = at.withColumns({"cy": _cell(F.col("lat"), F.col("level")), "cx": _cell(F.col("lon"), F.col("level"))})
    reach = sphere_distance(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon")) <= F.col("radius_m")
    return at.join(side, ["level", "cy", "cx"]).where(reach).select("_point.*", "place_id")
