"""Spatial joins expressed as equi-joins on grid cells plus an exact filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions import geo
from wakeline.operators.joins import BROADCAST_ROWS, dimension_join, fits_broadcast
from wakeline.schema import DEFAULT_PORT_RADIUS_NM

CELL_DEG = 0.25


def _span(low: Column, high: Column, cell_deg: float) -> Column:
    return F.sequence(geo.cell_index(low, cell_deg), geo.cell_index(high, cell_deg))


def _lon_span(low: Column, high: Column, cell_deg: float) -> Column:
    """Longitude cells between two bounds, wrapped around the globe and each listed once."""
    around = geo.lon_cells(cell_deg)
    cells = F.when(
        high - low >= 360.0 - cell_deg, F.sequence(F.lit(0), F.lit(around - 1))
    ).otherwise(
        F.transform(
            _span(low + 180.0, high + 180.0, cell_deg),
            lambda c: F.pmod(c, F.lit(around)),
        )
    )
    return F.array_distinct(cells)


def _with_position_cells(positions: DataFrame, cell_deg: float) -> DataFrame:
    around = geo.lon_cells(cell_deg)
    return positions.withColumns({
        "_lat_cell": geo.cell_index(F.col("LAT"), cell_deg),
        "_lon_cell": F.pmod(geo.cell_index(F.col("LON") + 180.0, cell_deg), F.lit(around)),
    })


def ports_in_range(
    positions: DataFrame,
    ports: DataFrame,
    default_radius_nm: float = DEFAULT_PORT_RADIUS_NM,
    cell_deg: float = CELL_DEG,
    spread_by: Sequence[str] = ("MMSI", "BaseDateTime"),
    max_broadcast_rows: int = BROADCAST_ROWS,
    salts: int | None = None,
) -> DataFrame:
    """Every position paired with each port whose radius it lies in, with `dist_nm`.

    Each port is listed under the cells its bounding box touches, so a position meets only the
    ports of its own cell: a hash lookup instead of a comparison with every port. The box test
    runs before the trigonometry. Works across the antimeridian.
    """
    radius = F.coalesce(F.col("radius_nm"), F.lit(float(default_radius_nm)))
    boxed = ports.withColumn("_radius", radius).withColumns({
        "_lat_margin": geo.lat_margin(F.col("_radius")),
        "_lon_margin": geo.lon_margin(F.col("_radius"), F.col("port_lat")),
    })
    lat_low = F.col("port_lat") - F.col("_lat_margin")
    lat_high = F.col("port_lat") + F.col("_lat_margin")
    # One spare cell on each side: the last cell is shorter when 360 / cell_deg is not whole.
    lon_low = F.col("port_lon") - F.col("_lon_margin") - cell_deg
    lon_high = F.col("port_lon") + F.col("_lon_margin") + cell_deg
    listed = (
        boxed
        .withColumn("_lat_cell", F.explode(_span(lat_low, lat_high, cell_deg)))
        .withColumn("_lon_cell", F.explode(_lon_span(lon_low, lon_high, cell_deg)))
    )
    met = dimension_join(
        _with_position_cells(positions, cell_deg), listed, ("_lat_cell", "_lon_cell"),
        spread_by, "inner", max_broadcast_rows, salts,
    )
    in_box = (
        (F.abs(F.col("LAT") - F.col("port_lat")) <= F.col("_lat_margin"))
        & (geo.lon_gap(F.col("LON"), F.col("port_lon")) <= F.col("_lon_margin"))
    )
    distance = geo.haversine_nm(
        F.col("LAT"), F.col("LON"), F.col("port_lat"), F.col("port_lon")
    )
    return (
        met.filter(in_box)
        .withColumn("dist_nm", distance)
        .filter(F.col("dist_nm") <= F.col("_radius"))
        .drop("_lat_cell", "_lon_cell", "_radius", "_lat_margin", "_lon_margin")
    )


def _listed_zones(zones: DataFrame, cell_deg: float) -> DataFrame:
    """Each zone under the grid cells that its bounding box touches, with its edges.

    A zone without a readable ring is listed nowhere.
    """
    def bound(pick, *names: str) -> Column:
        return pick(F.concat(*(F.col("_edges").getField(name) for name in names)))

    boxed = zones.withColumn("_edges", geo.polygon_edges(F.col("geom_wkt"))).withColumns({
        "_west": bound(F.array_min, "ax", "bx"), "_east": bound(F.array_max, "ax", "bx"),
        "_south": bound(F.array_min, "ay", "by"), "_north": bound(F.array_max, "ay", "by")})
    return (
        boxed
        .withColumn("_lat_cell", F.explode(_span(F.col("_south"), F.col("_north"), cell_deg)))
        .withColumn("_lon_cell", F.explode(_lon_span(F.col("_west"), F.col("_east"), cell_deg)))
    )


def _inside_zone() -> Column:
    """The box test first, then the real ring."""
    in_box = F.col("LAT").between(F.col("_south"), F.col("_north")) & F.col("LON").between(
        F.col("_west"), F.col("_east"))
    return in_box & geo.inside_edges(F.col("LON"), F.col("LAT"), F.col("_edges"))


_ZONE_HELPERS = ("_lat_cell", "_lon_cell", "_west", "_east", "_south", "_north", "_edges")


def positions_in_zones(positions: DataFrame, zones: DataFrame, cell_deg: float = CELL_DEG,
                       spread_by: Sequence[str] = ("MMSI", "BaseDateTime"),
                       max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every position paired with each zone (its border included) it lies in.

    `geom_wkt` of a zone is any polygon, with holes or several parts. Zones are met by grid cell,
    as ports are.
    """
    met = dimension_join(
        _with_position_cells(positions, cell_deg), _listed_zones(zones, cell_deg),
        ("_lat_cell", "_lon_cell"), spread_by, "inner", max_broadcast_rows,
    )
    return met.filter(_inside_zone()).drop(*_ZONE_HELPERS)


def zone_of_each(positions: DataFrame, zones: DataFrame, zone: str = "port_name",
                 cell_deg: float = CELL_DEG,
                 max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every position once for each zone it lies in, or once with a null zone; batch or stream.

    The zones have to fit a broadcast, else this fails: a position outside of all zones must be
    told apart in one step for a stream.
    """
    listed = _listed_zones(zones.select(zone, "geom_wkt"), cell_deg).withColumnsRenamed(
        {"_lat_cell": "_zone_lat", "_lon_cell": "_zone_lon"})
    if not fits_broadcast(listed, max_broadcast_rows):
        raise ValueError("the zones are too many for a broadcast")
    placed = _with_position_cells(positions, cell_deg)
    same_cell = ((F.col("_lat_cell") == F.col("_zone_lat"))
                 & (F.col("_lon_cell") == F.col("_zone_lon")))
    return placed.join(F.broadcast(listed), same_cell & _inside_zone(), "left").drop(
        "geom_wkt", "_zone_lat", "_zone_lon", *_ZONE_HELPERS)


def link_zones_to_ports(zones: DataFrame, ports: DataFrame) -> DataFrame:
    """Fill port_ref_id of zones from the port that bears the same name."""
    named = ports.select(F.col("port_name"), F.col("port_id").alias("_port_id"))
    linked = zones.join(named, "port_name", "left")
    current = F.col("port_ref_id") if "port_ref_id" in zones.columns else F.lit(None)
    return linked.withColumn(
        "port_ref_id", F.coalesce(F.col("_port_id"), current.cast("string"))
    ).drop("_port_id")
