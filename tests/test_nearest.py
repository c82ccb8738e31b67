import math
import random
from datetime import datetime

import numpy as np
import pytest

from tests.helpers import positions, rows
from wakeline.operators.nearest import nearest_vessels, sweep


def miles(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    chord = math.sin((la - lb) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lo - lp) / 2) ** 2
    return round(2 * 3440.065 * math.atan2(math.sqrt(chord), math.sqrt(1 - chord)), 6)


def plain(ships, radius):
    """(vessel, nearest, distance) by comparing all."""
    out = []
    for i, (vessel, *at) in enumerate(ships):
        near = min(((miles(at, b), other) for j, (other, *b) in enumerate(ships) if j != i),
                   default=(math.inf, None))
        out.append((vessel, near[1], near[0]) if near[0] <= radius else (vessel, None, None))
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_sweep_against_all_pairs(seed):
    rng = random.Random(seed)
    n = rng.choice([0, 1, 2, 40, 150])
    ships = [(v, round(rng.uniform(0, 0.3), 2), round(rng.uniform(0, 0.3), 2 + seed % 3))
             for v in rng.sample(range(10_000), n)]
    vessel = np.array([s[0] for s in ships], np.int64)
    nearest, away = sweep(vessel, np.array([s[1] for s in ships]), np.array([s[2] for s in ships]), 2.0)
    got = sorted((s[0], int(vessel[i]) if i >= 0 else None, None if i < 0 else float(d))
                 for s, i, d in zip(ships, nearest, away))
    assert [g[:2] for g in got] == [p[:2] for p in plain(ships, 2.0)]
    assert all(g[2] == p[2] or abs(g[2] - p[2]) < 2e-6 for g, p in zip(got, plain(ships, 2.0)))


def test_many_vessels_at_one_place_are_not_compared_with_each_other():
    n = 200_000
    nearest, away = sweep(np.arange(n), np.zeros(n), np.zeros(n), 1.0)
    assert nearest[0] == 1 and (nearest[1:] == 0).all() and (away == 0).all()


def test_cells_the_antimeridian_and_single_vessels(spark):
    at = "2024-12-25 10:00:00"
    ships = [(1, 0.0, 179.999), (2, 0.0, -179.999), (3, 0.9999, 10.0), (4, 1.0001, 10.0),
             (5, 40.0, 40.0), (6, 89.99, 0.0), (7, 89.99, 179.0), (8, -0.001, -0.001)]
    track = [(v, at, lat, lon) for v, lat, lon in ships]
    # An older position in the same minute, another minute, and repeated rows.
    track += [(5, "2024-12-25 10:00:30", 0.001, 0.001), (3, "2024-12-25 10:01:00", 40.0, 40.0), track[0]]
    found = nearest_vessels(positions(spark, track), 2.0)
    minute = datetime(2024, 12, 25, 10)
    got = [r[1:] for r in rows(found.where(f"minute = '{minute}'").select(
        "minute", "mmsi", "near_mmsi"))]
    assert got == [(1, 2), (2, 1), (3, 4), (4, 3), (5, 8), (6, 7), (7, 6), (8, 5)]
    later = found.where(f"minute <> '{minute}'").first()
    assert (later.mmsi, later.near_mmsi, later.distance_nm, later.cpa_nm) == (3, None, None, None)
    assert nearest_vessels(positions(spark, track[:1]).where("false")).count() == 0


def test_closest_point_of_approach(spark):
    df = positions(spark, [(1, "2024-12-25 10:00:00", 0.0, 0.0), (2, "2024-12-25 10:00:00", 0.0, 0.02)])
    from pyspark.sql import functions as F
    # Head on at ten knots each: 1.2 miles apart, so 3.6 minutes.
    df = df.withColumn("COG", F.when(F.col("MMSI") == 1, 90.0).otherwise(270.0))
    assert {(r.cpa_minutes, r.cpa_nm) for r in nearest_vessels(df).collect()} == {(3.6, 0.0)}
