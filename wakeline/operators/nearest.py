"""The nearest other vessel of each vessel and minute, and their closest point of approach.

Only the nearest vessel within a radius is named: one row a position, never the pairs of a cell.
Positions are dealt to grid cells with a margin of the radius around each, so a cell holds all that
can be near to its own positions. A cell of one minute has at most one position a vessel, so the fleet
bounds it, however long the history is. Within a cell a plane sweep in the order of latitude ends for
a position as soon as the next latitudes are farther away than what was found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions import geo
from wakeline.operators.latest import latest_by_key
from wakeline.operators.spatial import _lon_span, _span
from wakeline.schema import EARTH_RADIUS_NM
from wakeline.session import ship_package

RADIUS_NM = 2.0
CELL_DEG = 1.0
#: Decimals of a distance in nautical miles by which vessels are compared (about 2 mm).
DIGITS = 6


def _distance(lat_a, lon_a, lat_b, lon_b) -> np.ndarray:
    half_lat, half_lon = np.sin((lat_a - lat_b) / 2), np.sin((lon_a - lon_b) / 2)
    chord = half_lat**2 + np.cos(lat_a) * np.cos(lat_b) * half_lon**2
    return 2 * EARTH_RADIUS_NM * np.arctan2(np.sqrt(chord), np.sqrt(1 - chord))


def sweep(vessel: np.ndarray, lat: np.ndarray, lon: np.ndarray,
          radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of the nearest other vessel or -1, rounded distance) for positions in degrees.

    Equal distances fall to the smaller vessel number. Each place is swept once: of the vessels at
    one place the two smallest stand for all, which is enough to name a nearest one.
    """
    n = len(vessel)
    order = np.lexsort((vessel, lon, lat))
    vessel, lat, lon = vessel[order], np.radians(lat[order]), np.radians(lon[order])
    new = np.append(True, (lat[1:] != lat[:-1]) | (lon[1:] != lon[:-1]))[:n]
    place = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    count = np.diff(first, append=n)
    best = np.full(len(first), np.inf)
    which = np.full(len(first), -1)
    p_lat, p_lon = lat[first], lon[first]
    active, step = np.arange(len(first)), 1
    while len(active):
        still = np.zeros(len(first), bool)
        for sign in (1, -1):
            other = active + sign * step
            inside = (other >= 0) & (other < len(first))
            a, b = active[inside], other[inside]
            gap = np.abs(p_lat[a] - p_lat[b]) * EARTH_RADIUS_NM
            near = gap <= np.minimum(best[a], radius) + 10.0**-DIGITS
            a, b = a[near], b[near]
            still[a] = True
            found = np.round(_distance(p_lat[a], p_lon[a], p_lat[b], p_lon[b]), DIGITS)
            better = (found <= radius) & ((found < best[a]) | (
                (found == best[a]) & (vessel[first[b]] < vessel[first[which[a]]])))
            best[a[better]], which[a[better]] = found[better], b[better]
        active, step = np.flatnonzero(still), step + 1
    row = np.where(which[place] >= 0, first[which[place]], -1)
    distance = np.where(row >= 0, best[place], np.nan)
    # Another vessel at the same place is nearest: the smallest one, or the second for itself.
    shared = count[place] > 1
    mate = first[place] + (first[place] == np.arange(n))
    row = np.where(shared, mate, row)
    distance = np.where(shared, 0.0, distance)
    nearest, away = np.empty(n, np.int64), np.empty(n)
    nearest[order], away[order] = np.where(row >= 0, order[row], -1), distance
    return nearest, away


def _approach() -> dict[str, Column]:
    """Minutes until the closest point of approach, and the distance there, on a local plane."""
    shrink = F.cos(F.radians(F.col("lat")))
    east = (F.pmod(F.col("near_lon") - F.col("lon") + 540.0, F.lit(360.0)) - 180.0) * 60.0 * shrink
    north = (F.col("near_lat") - F.col("lat")) * 60.0

    def speed(prefix: str, part) -> Column:
        return F.col(f"{prefix}sog") * part(F.radians(F.col(f"{prefix}cog"))) / 60.0

    v_east = speed("near_", F.sin) - speed("", F.sin)
    v_north = speed("near_", F.cos) - speed("", F.cos)
    square = v_east * v_east + v_north * v_north
    minutes = F.when(square > 0, F.greatest(
        F.lit(0.0), -(east * v_east + north * v_north) / square)).when(square == 0, F.lit(0.0))
    there = F.sqrt(F.pow(east + v_east * minutes, 2) + F.pow(north + v_north * minutes, 2))
    return {"cpa_minutes": F.round(minutes, 2), "cpa_nm": F.round(there, 3)}


def nearest_vessels(positions: DataFrame, radius_nm: float = RADIUS_NM,
                    cell_deg: float = CELL_DEG, unit: str = "minute") -> DataFrame:
    """(minute, mmsi, near_mmsi, distance_nm, cpa_minutes, cpa_nm), one row a vessel and minute.

    A vessel's newest position in the minute (or other `unit` of time) counts, ties by value. Without another vessel within
    the radius the other columns are null; without a speed or course on either side the approach is.
    """
    ship_package(positions.sparkSession)
    minute = F.date_trunc(unit, F.col("BaseDateTime"))
    rows = latest_by_key(positions.where(
        F.col("MMSI").isNotNull() & geo.valid_position(F.col("LAT"), F.col("LON"))).select(
        minute.alias("minute"), F.col("MMSI").cast("bigint").alias("mmsi"),
        F.col("BaseDateTime").alias("at"), F.col("LAT").cast("double").alias("lat"),
        F.col("LON").cast("double").alias("lon"), F.col("SOG").alias("sog"),
        F.col("COG").alias("cog")), ["minute", "mmsi"], "at")
    around = geo.lon_cells(cell_deg)
    margin = geo.lat_margin(F.lit(float(radius_nm)))
    lat_cells = _span(F.col("lat") - margin, F.col("lat") + margin, cell_deg)
    wide = geo.lon_margin(F.lit(float(radius_nm)), F.col("lat")) + (
        cell_deg if 360.0 % cell_deg else 0.0)
    # Close to a pole every longitude is near.
    wide = F.when(F.abs(F.col("lat")) + margin > 89.0, F.lit(180.0)).otherwise(wide)
    spread = rows.withColumns({
        "own_lat": geo.cell_index(F.col("lat"), cell_deg),
        "own_lon": F.pmod(geo.cell_index(F.col("lon") + 180.0, cell_deg), F.lit(around)),
        "lat_cell": F.explode(lat_cells)}).withColumn(
        "lon_cell", F.explode(_lon_span(F.col("lon") - wide, F.col("lon") + wide, cell_deg)))
    spread = spread.withColumn("own", (F.col("own_lat") == F.col("lat_cell")) & (
        F.col("own_lon") == F.col("lon_cell")))
    names = ("lat", "lon", "sog", "cog")

    def of_cell(table: pa.Table) -> pa.Table:
        lat, lon = (table[name].to_numpy() for name in ("lat", "lon"))
        nearest, away = sweep(table["mmsi"].to_numpy(), lat, lon, radius_nm)
        own = np.flatnonzero(table["own"].to_numpy())
        taken = pa.array(nearest[own], mask=nearest[own] < 0)
        mine = table.take(pa.array(own))
        columns = {name: mine[name] for name in ("minute", "mmsi", *names)}
        columns |= {f"near_{name}": table[name].take(taken) for name in ("mmsi", *names)}
        columns["distance_nm"] = pa.array(away[own], mask=np.isnan(away[own]))
        return pa.table(columns)

    kinds = "minute timestamp, mmsi bigint, " + ", ".join(f"{n} double" for n in names) + (
        ", near_mmsi bigint, " + ", ".join(f"near_{n} double" for n in names)
        + ", distance_nm double")
    found = spread.select("minute", "lat_cell", "lon_cell", "mmsi", *(
        F.col(name).cast("double") for name in names), "own").groupBy(
        "minute", "lat_cell", "lon_cell").applyInArrow(of_cell, kinds)
    return found.select("minute", "mmsi", "near_mmsi", "distance_nm",
                        *(c.alias(n) for n, c in _approach().items()))
