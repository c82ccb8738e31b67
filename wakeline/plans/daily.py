"""The daily chain: input gate, key figures, behaviour clusters, row gate."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.operators import cluster
from wakeline.operators.cluster import BehaviourModel
from wakeline.operators.latest import upsert
from wakeline.operators.quality import require_rows
from wakeline.plans import kpi
from wakeline.plans.behaviour import behaviour_clusters
from wakeline.schema import (
    ALERT_THRESHOLD_KNOTS,
    ANOMALY_PERCENTILE,
    CLUSTER_COUNT,
    DEFAULT_PORT_RADIUS_NM,
    GRID_STEP_DEG,
    PORT_SCHEMA,
    PORTS,
    TABLE_KEYS,
)
from wakeline.sources import archive, jdbc, models, tables
from wakeline.sources.jdbc import JdbcTarget

log = logging.getLogger("wakeline.daily")


def seed_ports(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The seeded ports, merged by port_id into a stored port table when a path is given."""
    seed = spark.createDataFrame(PORTS, PORT_SCHEMA)
    if path is None:
        return seed
    known = tables.read_table(spark, path, PORT_SCHEMA)
    return upsert(known, seed, ["port_id"], ["port_name", "port_lon", "port_lat", "radius_nm"])


def port_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The ports of a stored table, or the seeded ones without a path."""
    if path is None:
        return seed_ports(spark)
    return spark.read.parquet(path).select(*PORT_SCHEMA.fieldNames())


def all_visits(spark: SparkSession, archive_path: str, results: str, ports: DataFrame,
               port_radius_nm: float = DEFAULT_PORT_RADIUS_NM) -> None:
    """Write the complete port visits of the whole archive beside the daily tables.

    port_dwell_times follows the daily rule, which loses visits; this table has all of them.
    """
    visits = kpi.port_visits(archive.read_archive(spark, archive_path), ports, port_radius_nm)
    archive.write_by_date(visits, f"{results}/port_visits", "kpi_date")


def daily_kpis(spark: SparkSession, archive_path: str, results: str, ports: DataFrame, day: str,
               port_radius_nm: float = DEFAULT_PORT_RADIUS_NM,
               grid_cell_deg: float = GRID_STEP_DEG,
               alert_threshold: float = ALERT_THRESHOLD_KNOTS) -> bool:
    """Write the four result tables of a day; False when the day has no positions.

    Each table reads only its own columns of the day's files, which is cheaper than caching the
    whole day between them.
    """
    positions = archive.read_days(spark, archive_path, day)
    if positions.isEmpty():
        log.warning("no positions on %s", day)
        return False
    both_days = archive.read_day_with_previous(spark, archive_path, day)
    tables.upsert_result(
        kpi.port_dwell_times(both_days, ports, day, port_radius_nm), results, "port_dwell_times",
        [day],
    )
    tables.upsert_result(
        kpi.fleet_daily_kpis(positions, day), results, "fleet_daily_kpis", [day]
    )
    tables.upsert_result(
        kpi.route_density_grid(positions, day, grid_cell_deg), results, "route_density_grid",
        [day],
    )
    alerts = kpi.speed_alerts(positions, alert_threshold).withColumn(
        "alert_date", F.to_date("detected_at")
    )
    tables.replace_table_day(alerts, f"{results}/vessel_speed_alerts", day, "alert_date")
    return True


def daily_clusters(spark: SparkSession, archive_path: str, results: str, model_base: str,
                   day: str, k: int = CLUSTER_COUNT, percent: float = ANOMALY_PERCENTILE,
                   refit: bool = False) -> bool:
    """Write the clustering table of a day; False when no usable position is left."""
    features = cluster.behaviour_features(archive.read_days(spark, archive_path, day))
    if features.isEmpty():
        log.warning("no usable positions on %s", day)
        return False
    scaler, kmeans = models.load_or_fit(features, model_base, refit, k)
    models.save_dated(model_base, kmeans, day)
    model = BehaviourModel.from_fitted(scaler, kmeans)
    rows = behaviour_clusters(features, model, F.current_timestamp(), percent)
    with_geometry = tables.fill_geometry(
        rows.withColumn("geom_wkt", F.lit(None).cast("string")), day
    )
    tables.replace_table_day(with_geometry, f"{results}/vessel_behavior_clusters", day)
    return True


def publish_day(spark: SparkSession, results: str, target: JdbcTarget, day: str) -> None:
    """Copy a day's result tables to a database: upserts, and replaced days for the logs."""
    for table in ("port_dwell_times", "fleet_daily_kpis", "route_density_grid"):
        rows = tables.read_table(spark, f"{results}/{table}").filter(
            F.col("kpi_date") == F.to_date(F.lit(day))
        )
        keys = TABLE_KEYS[table]
        changed = [c for c in rows.columns if c not in keys]
        jdbc.upsert_via_staging(rows, target, table, keys, changed, day)
    for table, date_col, day_col in (
        ("vessel_speed_alerts", "detected_at", "alert_date"),
        ("vessel_behavior_clusters", "kpi_date", "kpi_date"),
    ):
        rows = tables.read_table(spark, f"{results}/{table}").filter(
            F.col(day_col) == F.to_date(F.lit(day))
        )
        columns = [c for c in rows.columns if c != "alert_date"]
        jdbc.replace_day(rows.select(columns), target, table, date_col, day,
                         is_timestamp=date_col != day_col)


def run_day(spark: SparkSession, archive_path: str, results: str, model_base: str,
            ports: DataFrame, day: str, **options) -> dict[str, int]:
    """The whole chain for one day; raises when the input or a required result is missing."""
    archive.require_day(spark, archive_path, day)
    kpi_names = ("port_radius_nm", "grid_cell_deg", "alert_threshold")
    kpi_options = {name: options[name] for name in kpi_names if name in options}
    cluster_options = {
        name: options[name] for name in ("k", "percent", "refit") if name in options
    }
    daily_kpis(spark, archive_path, results, ports, day, **kpi_options)
    daily_clusters(spark, archive_path, results, model_base, day, **cluster_options)
    gated = ("port_dwell_times", "fleet_daily_kpis", "route_density_grid",
             "vessel_behavior_clusters")
    written = {}
    for name in gated:
        path = f"{results}/{name}"
        written[name] = tables.read_table(spark, path) if tables.files.has_files(
            spark, path, ".parquet"
        ) else spark.createDataFrame([], "kpi_date date")
    return require_rows(written, day, ["fleet_daily_kpis", "vessel_behavior_clusters"])

