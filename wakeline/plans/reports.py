"""Report queries over the result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions import geo
from wakeline.schema import ANOMALY_PERCENTILE

# Labels shown in the anomaly split.
ANOMALY_LABEL = "Outlier / Anomaly (Distance > P{percent:g})"
NORMAL_LABEL = "Normal Navigation Profile"


def on_day(df: DataFrame, day: str, date_col: str = "kpi_date") -> DataFrame:
    return df.filter(F.col(date_col) == F.to_date(F.lit(day)))


def _percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(part * 100.0 / whole, digits)


def _mean(name: str, digits: int) -> Column:
    """Mean of stored (already rounded) figures, summed as decimals: exact in any order."""
    return F.round(F.avg(F.col(name).cast("decimal(18,6)")), digits).cast("double")


def _cluster_label() -> Column:
    return F.concat(F.lit("Cluster "), F.col("cluster_id").cast("string"))


def _fleet_status(percent: float) -> Column:
    anomaly = F.lit(ANOMALY_LABEL.format(percent=percent))
    return F.when(F.col("is_anomaly"), anomaly).otherwise(F.lit(NORMAL_LABEL))


def _anomalies() -> Column:
    return F.count_if(F.col("is_anomaly"))


# --- fleet state ------------------------------------------------------------------------------

def fleet_view(state: DataFrame) -> DataFrame:
    """Latest state with lat and lon taken from the point text."""
    return state.select(
        "mmsi", "vessel_name",
        geo.wkt_point_lat(F.col("geom_wkt")).alias("lat"),
        geo.wkt_point_lon(F.col("geom_wkt")).alias("lon"),
        "sog_knots", "cog_degrees", "heading_degrees", "nav_status", "last_updated",
    )


def active_vessels(state: DataFrame) -> DataFrame:
    return state.agg(F.count_distinct("mmsi").alias("active_vessels"))


def map_feed(state: DataFrame) -> DataFrame:
    """Positions for a map, newest first."""
    return state.select("mmsi", "lat", "lon", "last_updated").dropna(subset=["lat", "lon"]).orderBy(
        F.col("last_updated").desc(), "mmsi"
    )


def recent_roster(state: DataFrame, limit: int = 100) -> DataFrame:
    return state.select(
        "mmsi", "vessel_name", "sog_knots", "cog_degrees", "nav_status", "last_updated"
    ).orderBy(F.col("last_updated").desc(), "mmsi").limit(limit)


# --- alerts -----------------------------------------------------------------------------------

def violations(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("speed_violations"))


def alert_log(alerts: DataFrame, limit: int = 100) -> DataFrame:
    return alerts.select(
        "detected_at", "mmsi", "vessel_name", "sog_knots", "threshold_knots", "lat", "lon"
    ).orderBy(
        F.col("detected_at").desc(), "mmsi", "sog_knots", "lat", "lon", "vessel_name"
    ).limit(limit)


# --- port visits and fleet figures ------------------------------------------------------------

def busiest_ports(visits: DataFrame, limit: int = 5) -> DataFrame:
    """The `limit` ports with the longest average stay."""
    return dwell_by_port(visits).limit(limit)


def dwell_by_port(visits: DataFrame) -> DataFrame:
    """Ports with the longest average stay first."""
    return (
        visits.groupBy("port_id")
        .agg(
            _mean("dwell_minutes", 1).alias("avg_dwell_minutes"),
            F.count("*").alias("dwell_events"),
        )
        .orderBy(F.col("avg_dwell_minutes").desc(), "port_id")
    )


def dwell_by_port_and_day(visits: DataFrame) -> DataFrame:
    return (
        visits.groupBy("kpi_date", "port_id")
        .agg(
            F.count("*").alias("completed_dwell_events"),
            _mean("dwell_minutes", 1).alias("avg_dwell_mins"),
        )
        .orderBy("kpi_date", F.col("completed_dwell_events").desc(), "port_id")
    )


def speed_by_type(kpis: DataFrame) -> DataFrame:
    """Per vessel type over all days: pings, mean of the daily means, top speed."""
    return (
        kpis.groupBy("vessel_type")
        .agg(
            F.sum("ping_count").alias("total_pings"),
            _mean("avg_sog", 2).alias("avg_speed"),
            F.max("max_sog").alias("max_speed"),
        )
        .orderBy(F.col("total_pings").desc(), "vessel_type")
    )


def top_types_of_day(kpis: DataFrame, day: str, limit: int = 5) -> DataFrame:
    return on_day(kpis, day).select(
        "kpi_date", "vessel_type", "ping_count",
        F.round("avg_sog", 2).alias("avg_sog_kts"), F.round("max_sog", 2).alias("max_sog_kts"),
    ).orderBy(F.col("ping_count").desc(), "vessel_type").limit(limit)


def pings_per_day(kpis: DataFrame) -> DataFrame:
    return kpis.groupBy("kpi_date").agg(
        F.count("*").alias("type_rows"), F.sum("ping_count").alias("pings")
    )


# --- behaviour clusters -----------------------------------------------------------------------

def cluster_summary(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("cluster_id")
        .agg(
            F.count("*").alias("total_vessels"),
            _anomalies().alias("anomalies"),
            _mean("sog_knots", 2).alias("avg_sog"),
            _mean("distance_to_centroid", 4).alias("avg_dist"),
        )
        .orderBy("cluster_id")
    )


def rows_of_days(clusters: DataFrame) -> DataFrame:
    """Rows and the range of vessels per day, in order of days."""
    return clusters.groupBy("kpi_date").agg(
        F.count("*").alias("rows_of_day"), F.min("mmsi").alias("lowest"),
        F.max("mmsi").alias("highest"),
    ).orderBy("kpi_date")


def labelled_rows(clusters: DataFrame, percent: float = ANOMALY_PERCENTILE) -> DataFrame:
    return clusters.select(
        "mmsi", _cluster_label().alias("cluster_label"),
        _fleet_status(percent).alias("fleet_status"),
    )


def flagged_anomalies(clusters: DataFrame) -> DataFrame:
    return clusters.agg(_anomalies().alias("flagged_anomalies"))


def vessels_per_cluster(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("cluster_id").agg(F.count("*").alias("vessel_count"))
        .orderBy(F.col("vessel_count").desc(), "cluster_id")
        .select("cluster_id", _cluster_label().alias("cluster_label"), "vessel_count")
    )


def cluster_breakdown(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("cluster_id")
        .agg(
            F.count("*").alias("vessels"),
            _anomalies().alias("anomalies_flagged"),
            _mean("sog_knots", 2).alias("avg_speed"),
            _mean("distance_to_centroid", 4).alias("avg_centroid_dist"),
        )
        .orderBy("cluster_id")
    )


def anomaly_split(clusters: DataFrame, percent: float = ANOMALY_PERCENTILE) -> DataFrame:
    return (
        clusters.groupBy("is_anomaly").agg(F.count("*").alias("vessel_count"))
        .orderBy(F.col("is_anomaly").desc())
        .select(_fleet_status(percent).alias("fleet_status"), "vessel_count")
    )


def anomalies_per_cluster(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("cluster_id")
        .agg(
            F.count("*").alias("total_fleet"),
            F.count_if(~F.col("is_anomaly")).alias("normal_vessels"),
            _anomalies().alias("anomalous_vessels"),
        )
        .orderBy("cluster_id")
        .select(
            _cluster_label().alias("cluster_name"), "total_fleet", "normal_vessels",
            "anomalous_vessels",
            _percent(F.col("anomalous_vessels"), F.col("total_fleet")).alias("anomaly_pct"),
        )
    )


def cluster_averages(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("cluster_id")
        .agg(
            _mean("sog_knots", 2).alias("avg_sog_knots"),
            _mean("cog_degrees", 1).alias("avg_cog_degrees"),
            _mean("distance_to_centroid", 4).alias("avg_distance_to_centroid"),
        )
        .orderBy("cluster_id")
        .select(
            _cluster_label().alias("cluster_name"), "avg_sog_knots", "avg_cog_degrees",
            "avg_distance_to_centroid",
        )
    )


def daily_trend(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("kpi_date")
        .agg(F.count("*").alias("total_active_vessels"), _anomalies().alias("anomalous_vessels"))
        .orderBy("kpi_date")
        .select(
            F.col("kpi_date").cast("string").alias("partition_date"),
            "total_active_vessels", "anomalous_vessels",
            _percent(F.col("anomalous_vessels"), F.col("total_active_vessels"))
            .alias("anomaly_rate_pct"),
        )
    )


def top_outliers(clusters: DataFrame, limit: int = 20) -> DataFrame:
    return (
        clusters.filter("is_anomaly")
        .orderBy(F.col("distance_to_centroid").desc(), "mmsi", "kpi_date")
        .limit(limit)
        .select(
            "mmsi", F.col("kpi_date").cast("string").alias("observation_date"), "cluster_id",
            F.round("distance_to_centroid", 4).alias("distance_to_centroid"),
            F.round("sog_knots", 2).alias("sog_knots"),
            F.round("cog_degrees", 1).alias("cog_degrees"),
            F.round("lat", 4).alias("latitude"),
            F.round("lon", 4).alias("longitude"),
            "is_anomaly",
        )
    )


def model_report(clusters: DataFrame) -> DataFrame:
    """Per cluster: size, anomalies, speed and distance ranges, share of the fleet."""
    figures = clusters.groupBy("cluster_id").agg(
        F.count("*").alias("vessel_count"),
        _anomalies().alias("anomaly_count"),
        _mean("sog_knots", 2).alias("avg_sog"),
        F.round(F.min("sog_knots"), 2).alias("min_sog"),
        F.round(F.max("sog_knots"), 2).alias("max_sog"),
        _mean("distance_to_centroid", 4).alias("avg_dist"),
        F.round(F.max("distance_to_centroid"), 4).alias("max_dist"),
    )
    # The window spans the handful of cluster rows left by the aggregation.
    fleet = F.sum("vessel_count").over(Window.partitionBy())
    return figures.select(
        "*",
        _percent(F.col("vessel_count"), fleet, 1).alias("share_pct"),
        _percent(F.col("anomaly_count"), F.col("vessel_count")).alias("anomaly_rate_pct"),
    ).orderBy("cluster_id")


def global_report(clusters: DataFrame) -> DataFrame:
    return clusters.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("mmsi").alias("unique_vessels"),
        F.count_distinct("kpi_date").alias("date_count"),
        F.min("kpi_date").alias("first_date"),
        F.max("kpi_date").alias("last_date"),
        _anomalies().alias("anomaly_count"),
    ).withColumns({
        "nominal_count": F.col("total_rows") - F.col("anomaly_count"),
        "anomaly_pct": _percent(F.col("anomaly_count"), F.col("total_rows")),
    })


def cluster_matrix(clusters: DataFrame, groups: Sequence[str] = ("cluster_id",)) -> DataFrame:
    return (
        clusters.groupBy(*groups)
        .agg(
            F.count("*").alias("fleet_count"),
            _anomalies().alias("anomaly_count"),
            _mean("sog_knots", 2).alias("avg_sog_knots"),
            _mean("cog_degrees", 1).alias("avg_cog_degrees"),
            _mean("distance_to_centroid", 4).alias("avg_distance"),
            F.round(F.max("distance_to_centroid"), 4).alias("max_distance"),
            F.count_if(F.col("geom_wkt").isNotNull()).alias("vessels_with_geom"),
        )
        .withColumn(
            "anomaly_rate_pct", _percent(F.col("anomaly_count"), F.col("fleet_count"))
        )
        .orderBy(*groups)
    )
