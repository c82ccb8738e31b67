"""Small hand-made inputs."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.schema import MESSAGE_SCHEMA, RAW_FIELDS

GOOD = {
    "MMSI": "366000001", "BaseDateTime": "2024-12-25T10:00:00", "LAT": "29.8", "LON": "-95.1",
    "SOG": "10.0", "COG": "90.0", "Heading": "91", "VesselName": "ALPHA", "IMO": "IMO9000001",
    "CallSign": "WX1", "VesselType": "70", "Status": "0", "Length": "100.0", "Width": "20.0",
    "Draft": "5.0", "Cargo": "71", "TransceiverClass": "A",
}


def record(**changes) -> dict:
    return {**GOOD, **changes}


def messages(spark: SparkSession, values) -> DataFrame:
    """Messages from records (sent as JSON) and texts (sent as they are)."""
    rows = [
        ("k", value if value is None or isinstance(value, str) else json.dumps(value),
         0, offset, datetime(2024, 12, 25) + timedelta(seconds=offset))
        for offset, value in enumerate(values)
    ]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def positions(spark: SparkSession, rows) -> DataFrame:
    """Typed positions from (mmsi, 'yyyy-mm-dd hh:mm:ss', lat, lon[, sog[, type]]) tuples."""
    full = [(*row, *(10.0, 70)[len(row) - 4:]) for row in rows]
    df = spark.createDataFrame(
        full, "MMSI BIGINT, t STRING, LAT DOUBLE, LON DOUBLE, SOG DOUBLE, VesselType INT"
    )
    return df.select(
        "MMSI", F.to_timestamp("t").alias("BaseDateTime"), "LAT", "LON", "SOG",
        F.lit(45.0).alias("COG"), F.lit(None).cast("double").alias("Heading"),
        F.lit("ALPHA").alias("VesselName"), "VesselType", F.lit(0).alias("Status"),
    ).withColumn("date", F.to_date("BaseDateTime"))


def raw_frame(spark: SparkSession, records) -> DataFrame:
    schema = ", ".join(f"{name} STRING" for name in RAW_FIELDS)
    return spark.createDataFrame([[r.get(n) for n in RAW_FIELDS] for r in records], schema)


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
