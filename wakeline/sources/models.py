"""Reference model storage: load it, or fit and save it when it is missing or unwanted."""

from __future__ import annotations

import uuid

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import DataFrame, SparkSession

from wakeline.operators import cluster
from wakeline.schema import CLUSTER_COUNT, CLUSTER_SEED
from wakeline.sources import files

REFERENCE = "reference"
MODEL = "model"
SCALER = "scaler"


def load_reference(spark: SparkSession,
                   base: str) -> tuple[StandardScalerModel, KMeansModel] | None:
    """The saved pair, or None before the first fit; a pair that cannot be read raises."""
    folder = f"{base}/{REFERENCE}"
    if not files.exists(spark, folder):
        return None
    return (StandardScalerModel.load(f"{folder}/{SCALER}"), KMeansModel.load(f"{folder}/{MODEL}"))


def save_reference(spark: SparkSession, base: str, scaler: StandardScalerModel,
                   kmeans: KMeansModel) -> None:
    """Write both parts beside the pair in use, then exchange the folders by name.

    The pair that was in use stays beside, for readers that have just opened it; older ones go.
    """
    older = [name for name in files.children(spark, base) if name.startswith("replaced-")]
    fresh = f"{base}/{REFERENCE}-{uuid.uuid4().hex}"
    kmeans.write().save(f"{fresh}/{MODEL}")
    scaler.write().save(f"{fresh}/{SCALER}")
    if files.exists(spark, f"{base}/{REFERENCE}"):
        files.rename(spark, f"{base}/{REFERENCE}", f"{base}/replaced-{uuid.uuid4().hex}")
    files.rename(spark, fresh, f"{base}/{REFERENCE}")
    for name in older:
        files.remove(spark, f"{base}/{name}")


def save_dated(base: str, kmeans: KMeansModel, day: str) -> None:
    kmeans.write().overwrite().save(f"{base}/date={day}")


def load_or_fit(features: DataFrame, base: str, refit: bool = False, k: int = CLUSTER_COUNT,
                seed: int = CLUSTER_SEED) -> tuple[StandardScalerModel, KMeansModel]:
    """The reference pair that makes days comparable; fitted once, or again with `refit`."""
    spark = features.sparkSession
    if not refit:
        loaded = load_reference(spark, base)
        if loaded is not None:
            return loaded
    assembled = cluster.assemble(features)
    scaler = cluster.fit_scaler(assembled)
    kmeans = cluster.fit_kmeans(scaler.transform(assembled), k, seed)
    save_reference(spark, base, scaler, kmeans)
    return scaler, kmeans
