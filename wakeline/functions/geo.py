"""Spherical geometry on degree columns. Longitude comes first in WKT, never elsewhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.schema import BOX_MARGIN, COS_FLOOR, EARTH_RADIUS_NM, NM_PER_DEGREE


def valid_position(lat: Column, lon: Column) -> Column:
    """True only for a complete position inside the globe's ranges; never NULL."""
    return F.coalesce(lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0), F.lit(False))


def haversine_nm(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance in nautical miles."""
    half_lat = F.sin(F.radians(lat_a - lat_b) / 2.0)
    half_lon = F.sin(F.radians(lon_a - lon_b) / 2.0)
    chord = (
        half_lat * half_lat
        + F.cos(F.radians(lat_b)) * F.cos(F.radians(lat_a)) * half_lon * half_lon
    )
    return F.atan2(F.sqrt(chord), F.sqrt(1.0 - chord)) * (2.0 * EARTH_RADIUS_NM)


def lat_margin(radius_nm: Column) -> Column:
    return radius_nm / NM_PER_DEGREE * BOX_MARGIN


def lon_margin(radius_nm: Column, lat: Column) -> Column:
    """Degrees of longitude spanned by a radius at a latitude, bounded near the poles."""
    shrink = F.greatest(F.cos(F.radians(F.abs(lat))), F.lit(COS_FLOOR))
    return radius_nm / (shrink * NM_PER_DEGREE) * BOX_MARGIN


def lon_gap(lon_a: Column, lon_b: Column) -> Column:
    """Shortest angular distance between two longitudes, across the antimeridian if shorter."""
    gap = F.abs(lon_a - lon_b)
    return F.least(gap, 360.0 - gap)


def cell_index(degrees: Column, cell_deg: float) -> Column:
    return F.floor(degrees / cell_deg).cast("int")


def lon_cells(cell_deg: float) -> int:
    """Number of longitude cells around the globe."""
    return int(-(-360.0 // cell_deg))


# The largest double below one half: adding it and rounding down sends every half up and no
# smaller value, which adding 0.5 itself would not.
_BELOW_HALF = 0.49999999999999994


def grid_rank(degrees: Column, step: float) -> Column:
    """Index of the nearest multiple of step, halves away from zero.

    Equal to round(degrees / step), without a decimal object per value.
    """
    ratio = degrees / step
    return (F.signum(ratio) * F.floor(F.abs(ratio) + _BELOW_HALF)).cast("int")


def grid_value(rank: Column, step: float) -> Column:
    return F.round(rank * F.lit(float(step)), 4)


def point_wkt(lon: Column, lat: Column) -> Column:
    """POINT text, NULL when a coordinate is missing."""
    return F.concat(
        F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")
    )


def wkt_point_lon(wkt: Column) -> Column:
    return F.regexp_extract(wkt, r"POINT\s*\(\s*(\S+)\s+(\S+?)\s*\)", 1).try_cast("double")


def wkt_point_lat(wkt: Column) -> Column:
    return F.regexp_extract(wkt, r"POINT\s*\(\s*(\S+)\s+(\S+?)\s*\)", 2).try_cast("double")


def polygon_edges(wkt: Column) -> Column:
    """The edges (ax, ay, bx, by) of all rings of a POLYGON or MULTIPOLYGON text."""
    def corner(text: Column) -> Column:
        xy = F.split(F.trim(text), r"\s+")
        return F.struct(F.get(xy, F.lit(0)).try_cast("double").alias("x"),
                        F.get(xy, F.lit(1)).try_cast("double").alias("y"))

    def edges(ring: Column) -> Column:
        corners = F.transform(F.split(ring, ","), corner)
        sides = F.size(corners) - 1
        return F.zip_with(
            F.slice(corners, F.lit(1), sides), F.slice(corners, F.lit(2), sides),
            lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"),
                                  b["y"].alias("by")))

    rings = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))
    return F.flatten(F.transform(rings, edges))


def inside_edges(lon: Column, lat: Column, edges: Column) -> Column:
    """Whether a point lies in a polygon, its border included; holes are left out.

    A ray to the east crosses the border of a polygon that holds its start an odd number of times.
    Longitudes are taken as they stand: a polygon over the antimeridian has to be cut there.
    """
    def crosses(e: Column) -> Column:
        return ((e["ay"] > lat) != (e["by"] > lat)) & (
            lon < (e["bx"] - e["ax"]) * (lat - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0))
            + e["ax"])

    def touches(e: Column) -> Column:
        return (((e["bx"] - e["ax"]) * (lat - e["ay"]) == (lon - e["ax"]) * (e["by"] - e["ay"]))
                & lon.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
                & lat.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"])))

    crossed = F.size(F.filter(edges, lambda e: F.coalesce(crosses(e), F.lit(False))))
    return F.exists(edges, touches) | (crossed % 2 == 1)
