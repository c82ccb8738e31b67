"""Vessel behaviour features, nearest-centroid assignment and outlier flags.

Fitting is MLlib's (distributed StandardScaler and KMeans). Applying a fitted model is plain
column arithmetic, so distances are computed inside code generation without a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions import ais
from wakeline.operators.joins import dimension_join
from wakeline.operators.latest import latest_by_key
from wakeline.operators.stats import percentile_threshold
from wakeline.schema import ANOMALY_PERCENTILE, CLUSTER_COUNT, CLUSTER_SEED
from wakeline.session import materialize

FEATURES = ("sog_knots", "cog_sin", "cog_cos", "lat", "lon")


@dataclass(frozen=True)
class BehaviourModel:
    """Feature means and deviations, and the centroids in scaled space."""

    mean: tuple[float, ...]
    std: tuple[float, ...]
    centers: tuple[tuple[float, ...], ...]

    @classmethod
    def from_fitted(cls, scaler: StandardScalerModel, kmeans: KMeansModel) -> BehaviourModel:
        return cls(
            tuple(float(v) for v in scaler.mean),
            tuple(float(v) for v in scaler.std),
            tuple(tuple(float(v) for v in center) for center in kmeans.clusterCenters()),
        )


def behaviour_features(positions: DataFrame) -> DataFrame:
    """Typed features of positions with a valid speed, course and place."""
    base = positions.select(
        F.col("MMSI").cast("bigint").alias("mmsi"),
        F.col("BaseDateTime").alias("base_date_time"),
        F.col("SOG").cast("double").alias("sog_knots"),
        F.col("COG").cast("double").alias("cog_degrees"),
        F.col("LAT").cast("double").alias("lat"),
        F.col("LON").cast("double").alias("lon"),
    )
    usable = (
        (F.col("mmsi") > 0)
        & F.col("sog_knots").between(0.0, 100.0)
        & F.col("cog_degrees").between(0.0, 360.0)
        & F.col("lat").between(-90.0, 90.0)
        & F.col("lon").between(-180.0, 180.0)
    )
    return base.filter(usable).withColumns(ais.course_encoding(F.col("cog_degrees")))


def assemble(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features)


def fit_scaler(assembled: DataFrame) -> StandardScalerModel:
    return StandardScaler(
        inputCol="features", outputCol="scaled_features", withMean=True, withStd=True
    ).fit(assembled)


def fit_kmeans(scaled: DataFrame, k: int = CLUSTER_COUNT,
               seed: int = CLUSTER_SEED) -> KMeansModel:
    return KMeans(
        k=k, seed=seed, featuresCol="scaled_features", predictionCol="cluster_id"
    ).fit(scaled)


def scaled_columns(model: BehaviourModel,
                   names: Sequence[str] = FEATURES) -> list[Column]:
    """Standardised features; a constant feature (deviation 0) scales to 0."""
    return [
        (F.col(name) - F.lit(mean)) / F.lit(std) if std != 0.0 else F.lit(0.0)
        for name, mean, std in zip(names, model.mean, model.std)
    ]


def assign_clusters(features: DataFrame, model: BehaviourModel) -> DataFrame:
    """Nearest centroid (lowest number on ties) and Euclidean distance to it in scaled space."""
    scaled_names = [f"_s{i}" for i in range(len(FEATURES))]

    def squared(center: Sequence[float]) -> Column:
        return reduce(add, (
            (F.col(n) - F.lit(c)) * (F.col(n) - F.lit(c)) for n, c in zip(scaled_names, center)
        ))

    nearest = F.array_min(F.array(*(
        F.struct(squared(center).alias("_squared"), F.lit(number).alias("cluster_id"))
        for number, center in enumerate(model.centers)
    )))
    # Generated columns keep filters on cluster_id (a join adds one) from repeating the sums.
    return (
        features.withColumns(dict(zip(scaled_names, scaled_columns(model))))
        .select(*features.columns, F.inline(F.array(nearest)))
        .withColumn("distance_to_centroid", F.sqrt("_squared"))
        .drop("_squared")
    )


def flag_outliers(assigned: DataFrame, groups: Sequence[str] = ("cluster_id",),
                  percent: float = ANOMALY_PERCENTILE, few_groups: bool = True) -> DataFrame:
    """Mark rows farther from the centroid than their group's percentile.

    Groups are clusters, or clusters by day: at most some ten thousand, whose thresholds are
    broadcast, so that positions are not shuffled and no job starts here. With few_groups False the
    thresholds are written down first and broadcast only if their size allows it.
    """
    thresholds = percentile_threshold(assigned, groups, "distance_to_centroid", percent)
    if few_groups:
        joined = assigned.join(F.broadcast(thresholds), list(groups), "left")
    else:
        joined = dimension_join(assigned, materialize(thresholds, "thresholds"), groups,
                                ("distance_to_centroid",))
    beyond = F.col("distance_to_centroid") > F.col("threshold_distance")
    return joined.withColumn("is_anomaly", F.coalesce(beyond, F.lit(False)))


def latest_per_vessel(flagged: DataFrame, keys: Sequence[str] = ("mmsi",)) -> DataFrame:
    """The newest flagged row per vessel; equal times fall to the row farthest from its centroid."""
    return latest_by_key(flagged, keys, "base_date_time", ["distance_to_centroid"])


def cluster_rows(latest: DataFrame, kpi_date: Column, model_run_ts: Column) -> DataFrame:
    """Output rows of the clustering table, rounded as they are stored."""
    return latest.select(
        kpi_date.alias("kpi_date"),
        "mmsi",
        F.col("cluster_id").cast("int").alias("cluster_id"),
        F.round("lat", 6).alias("lat"),
        F.round("lon", 6).alias("lon"),
        F.round("sog_knots", 2).alias("sog_knots"),
        F.round("cog_degrees", 2).alias("cog_degrees"),
        F.round("distance_to_centroid", 4).alias("distance_to_centroid"),
        F.col("is_anomaly").cast("boolean").alias("is_anomaly"),
        model_run_ts.cast("timestamp").alias("model_run_ts"),
    )
