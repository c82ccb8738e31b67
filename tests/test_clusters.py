import math

import pytest
from pyspark.sql import functions as F

from tests.helpers import positions, rows
from wakeline.operators import cluster, stats
from wakeline.operators.cluster import BehaviourModel
from wakeline.plans import daily, reports
from wakeline.session import shared_dir
from wakeline.sources import archive, files, models, tables


def fleet(spark, n=400, day="2024-12-25"):
    return positions(spark, [
        (366000000 + i % 50, f"{day} {i % 24:02d}:{i % 60:02d}:00",
         20.0 + (i % 5) * 8 + (i % 7) * 0.1, -100.0 + (i % 5) * 20, float(i % 40), 70)
        for i in range(n)
    ]).withColumn("COG", (F.col("SOG") * 9) % 360)


def test_assignment_equals_mllib(spark):
    features = cluster.behaviour_features(fleet(spark))
    rows_ = cluster.assemble(features)
    scaler = cluster.fit_scaler(rows_)
    scaled = scaler.transform(rows_)
    fitted = cluster.fit_kmeans(scaled)
    expected = {
        (r["mmsi"], r["base_date_time"], r["sog_knots"]): (
            r["cluster_id"],
            math.dist(r["scaled_features"].toArray(), fitted.clusterCenters()[r["cluster_id"]]),
        )
        for r in fitted.transform(scaled).collect()
    }
    found = cluster.assign_clusters(features, BehaviourModel.from_fitted(scaler, fitted))
    for r in found.collect():
        number, distance = expected[(r["mmsi"], r["base_date_time"], r["sog_knots"])]
        assert r["cluster_id"] == number
        assert r["distance_to_centroid"] == pytest.approx(distance, abs=1e-9)


def test_features_keep_only_usable_positions(spark):
    pings = positions(spark, [
        (1, "2024-12-25 10:00:00", 0.0, 0.0, 100.0, 70), (0, "2024-12-25 10:00:00", 0.0, 0.0, 1.0, 70),
        (2, "2024-12-25 10:00:00", 0.0, 0.0, 100.1, 70), (3, "2024-12-25 10:00:00", 0.0, 0.0, None, 70),
        (4, "2024-12-25 10:00:00", 91.0, 0.0, 1.0, 70),
    ])
    assert [r["mmsi"] for r in cluster.behaviour_features(pings).collect()] == [1]


def test_threshold_and_flag(spark):
    df = spark.range(1, 21).select(
        F.lit(0).alias("cluster_id"), F.col("id").cast("double").alias("distance_to_centroid"))
    flagged = cluster.flag_outliers(df)
    assert [r["distance_to_centroid"] for r in flagged.filter("is_anomaly").collect()] == [20.0]
    assert flagged.first()["threshold_distance"] == 19.0


def test_reference_model_is_reused_until_refit(spark):
    base = shared_dir(spark, "models")
    features = cluster.behaviour_features(fleet(spark))
    _, first = models.load_or_fit(features, base, k=3)
    _, again = models.load_or_fit(features.filter("sog_knots < 5"), base, k=5)
    assert len(again.clusterCenters()) == len(first.clusterCenters()) == 3
    _, refit = models.load_or_fit(features, base, refit=True, k=4)
    assert len(refit.clusterCenters()) == 4
    models.load_or_fit(features, base, refit=True, k=2)
    assert sum(name.startswith("replaced-") for name in files.children(spark, base)) == 1
    assert models.load_reference(spark, shared_dir(spark, "none")) is None


def test_unreadable_reference_is_not_replaced(spark):
    base = shared_dir(spark, "models")
    features = cluster.behaviour_features(fleet(spark))
    models.load_or_fit(features, base, k=3)
    scaler = f"{base}/{models.REFERENCE}/{models.SCALER}"
    files.rename(spark, scaler, f"{base}/aside")
    with pytest.raises(Exception):
        models.load_or_fit(features, base, k=3)
    files.rename(spark, f"{base}/aside", scaler)
    assert models.load_reference(spark, base) is not None


def test_breakdown_keeps_all_clusters(spark):
    found = spark.range(24).selectExpr(
        "id % 12 as cluster_id", "id = 3 as is_anomaly", "1.5D as sog_knots",
        "0.5D as distance_to_centroid")
    assert reports.cluster_breakdown(found).count() == 12
    assert reports.vessels_per_cluster(found).count() == 12
    label = reports.anomaly_split(found, 90.0).first()["fleet_status"]
    assert label == "Outlier / Anomaly (Distance > P90)"


def test_daily_chain(spark):
    base = shared_dir(spark, "day")
    path, results, model_base = f"{base}/archive", f"{base}/results", f"{base}/models"
    archive.write_by_date(fleet(spark).unionByName(fleet(spark, day="2024-12-24")), path)
    ports = daily.seed_ports(spark)
    counts = daily.run_day(spark, path, results, model_base, ports, "2024-12-25")
    assert counts["vessel_behavior_clusters"] == 50 and counts["fleet_daily_kpis"] == 1
    again = daily.run_day(spark, path, results, model_base, ports, "2024-12-25", percent=90.0)
    assert again == counts
    clusters = tables.read_table(spark, f"{results}/vessel_behavior_clusters")
    assert clusters.filter(F.col("geom_wkt").isNull()).count() == 0
    assert reports.global_report(clusters).first()["unique_vessels"] == 50
    assert not daily.daily_kpis(spark, path, results, ports, "2024-12-30")
    assert not daily.daily_clusters(spark, path, results, model_base, "2024-12-30")


def test_five_numbers(spark):
    df = spark.createDataFrame([(0, float(v)) for v in (1, 2, 2, 4, 10)], "c INT, v DOUBLE")
    assert rows(stats.five_numbers(df, ["c"], "v")) == [(0, 5, 1.0, 2.0, 2.0, 4.0, 10.0)]


def test_histogram_edges(spark):
    df = spark.createDataFrame(
        [(0, v) for v in (0.0, 1.0, 2.0, 3.0, 3.0)] + [(1, 7.0)] * 4, "c INT, v DOUBLE")
    found = rows(stats.histogram(df, ["c"], "v", 3).select("c", "bin", "value_count"))
    assert found == [(0, 0, 1), (0, 1, 1), (0, 2, 3), (1, 1, 4)]
    area = stats.histogram(df, ["c"], "v", 3).filter("c = 0").agg(F.sum("density")).first()[0]
    assert area == pytest.approx(1.0)
