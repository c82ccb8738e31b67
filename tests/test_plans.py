"""Plans stay of the intended shape: pruned scans, hash lookups, early combination."""

import re

import pytest

from tests.helpers import messages, positions, record
from wakeline.operators import cluster, sessions, stats
from wakeline.operators.cluster import BehaviourModel
from wakeline.operators.latest import latest_by_key
from wakeline.operators.spatial import ports_in_range
from wakeline.plans import kpi
from wakeline.plans.daily import seed_ports
from wakeline.plans.history import clean_history
from wakeline.session import shared_dir
from wakeline.sources import archive
from wakeline_checks import QUERIES


@pytest.fixture(scope="module")
def stored(spark):
    path = shared_dir(spark, "plans")
    archive.write_by_date(positions(spark, [
        (k, f"2024-12-{d} 10:00:00", 29.8, -95.1) for d in (24, 25) for k in range(5)
    ]), path)
    return path


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text: str) -> set[str]:
    found = set()
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        found |= {field.split(":")[0] for field in schema.split(",") if field}
    return found


def test_daily_figures_read_one_day_and_two_columns(spark, stored):
    text = plan(kpi.fleet_daily_kpis(archive.read_days(spark, stored, "2024-12-25"), "2024-12-25"))
    assert read_columns(text) == {"SOG", "VesselType"}
    assert "PartitionFilters: [isnotnull(date" in text
    assert "partial_avg" in text


def test_speed_filter_reaches_the_scan(spark, stored):
    text = plan(kpi.speed_alerts(archive.read_days(spark, stored, "2024-12-25")))
    assert "GreaterThan(SOG,20.0)" in text


def test_grid_counts_before_the_shuffle(spark, stored):
    text = plan(kpi.route_density_grid(archive.read_archive(spark, stored)))
    assert read_columns(text) == {"LAT", "LON"}
    assert "partial_count" in text


def test_port_join_is_a_hash_lookup(spark, stored):
    text = plan(ports_in_range(archive.read_archive(spark, stored), seed_ports(spark)))
    assert "BroadcastHashJoin" in text
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_large_port_list_is_joined_without_broadcast_hint(spark, stored):
    text = plan(ports_in_range(
        archive.read_archive(spark, stored), seed_ports(spark), max_broadcast_rows=0))
    assert "_salt" in text
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_sessions_order_only_bin_rows(spark, stored):
    text = plan(sessions.gap_sessions(
        archive.read_archive(spark, stored), ["MMSI"], "BaseDateTime"))
    above, below = text.split("Window", 1)
    assert "partial_count" in below.split("Exchange", 1)[1]


def test_latest_row_needs_no_window(spark, stored):
    text = plan(latest_by_key(archive.read_archive(spark, stored), ["MMSI"], "BaseDateTime"))
    assert "Window" not in text and "partial_max" in text
    assert text.count("Exchange") == 1


def test_clustering_uses_no_python_workers(spark, stored):
    model = BehaviourModel((0.0,) * 5, (1.0,) * 5, ((0.0,) * 5, (1.0,) * 5))
    features = cluster.behaviour_features(archive.read_archive(spark, stored))
    text = plan(cluster.flag_outliers(cluster.assign_clusters(features, model)))
    assert "Python" not in text
    assert "BroadcastHashJoin" in text


def test_histogram_broadcasts_its_ranges(spark, stored):
    found = stats.histogram(archive.read_archive(spark, stored), ("VesselType",), "SOG")
    text = plan(found)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_outlier_plan_starts_no_job(spark, stored):
    model = BehaviourModel((0.0,) * 5, (1.0,) * 5, ((0.0,) * 5, (1.0,) * 5))
    features = cluster.behaviour_features(archive.read_archive(spark, stored))
    assigned = cluster.assign_clusters(features, model)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "no job expected")
    try:
        cluster.flag_outliers(assigned)
        assert not tracker.getJobIdsForGroup("plans")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_history_parses_each_message_once(spark):
    folder = shared_dir(spark, "topic")
    messages(spark, [record(), record(SOG="3")]).write.parquet(folder)
    found = clean_history(spark.read.parquet(folder))
    assert "from_json" not in plan(found)
    assert found.count() == 1


def test_fine_grid_names_each_cell_once(spark):
    pings = positions(spark, [(1, "2024-12-25 10:00:00", 10.0 + i / 1e5, 20.0)
                              for i in range(3)])
    found = kpi.route_density_grid(pings, grid_cell_deg=0.00001).collect()
    assert [(r["grid_lat"], r["grid_lon"], r["ping_count"]) for r in found] == [(10.0, 20.0, 3)]


def test_months_of_all_years_add_up_to_all_rows(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    dated = lines.where("l_shipdate is not null").count()
    found = QUERIES["t7_months_of_all_years"](spark, "/root/testdata/sf0.001").collect()
    assert sum(r.n for r in found) == dated
    assert {r.year for r in found} == {
        r[0] for r in lines.selectExpr("year(l_shipdate)").distinct().collect()} - {None}
