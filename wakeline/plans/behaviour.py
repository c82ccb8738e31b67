"""Behaviour clustering for one day or for all days of the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators import cluster
from wakeline.operators.cluster import BehaviourModel
from wakeline.schema import ANOMALY_PERCENTILE


def behaviour_clusters(features: DataFrame, model: BehaviourModel, model_run_ts: Column,
                       percent: float = ANOMALY_PERCENTILE) -> DataFrame:
    """Latest clustered and flagged position per vessel and day.

    Thresholds weigh all pings of a day and cluster, before the reduction to one row per vessel.
    """
    dated = features.withColumn("kpi_date", F.to_date("base_date_time"))
    assigned = cluster.assign_clusters(dated, model)
    flagged = cluster.flag_outliers(assigned, ("kpi_date", "cluster_id"), percent)
    latest = cluster.latest_per_vessel(flagged, ("kpi_date", "mmsi"))
    return cluster.cluster_rows(latest, F.col("kpi_date"), model_run_ts)
