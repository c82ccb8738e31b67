"""Checks of parsing, cleaning, derived columns and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeline_checks import views
from wakeline_checks.registry import oracle, query, rounded
from wakeline.functions import ais, geo, text
from wakeline.operators import clean
from wakeline.operators.attributes import recover_attributes, vessel_reference
from wakeline.operators.dedup import drop_duplicates
from wakeline.plans.history import clean_history, typed_history, valid_history
from wakeline.schema import (
    CORRUPT,
    DOUBLE_FIELDS,
    INT_FIELDS,
    RAW_FIELDS,
    VESSEL_ATTRIBUTES,
)
from wakeline.session import shared_dir
from wakeline.sources.messages import parse_messages
from wakeline.streaming.pipeline import StreamPaths, backfill
from wakeline.streaming.positions import clean_batch

_TEXTS = ", ".join(f"raw_{name} AS {name}" for name in RAW_FIELDS)
_TIME = "CAST(BaseDateTime AS VARCHAR) AS BaseDateTime"


def _parsed(spark, sf_dir):
    return parse_messages(views.messages(spark, sf_dir))


def _tagged(spark, sf_dir):
    return clean.tag_positions(_parsed(spark, sf_dir))


def _accepted(spark, sf_dir):
    return clean.accepted(_tagged(spark, sf_dir))


@query("p1_parse_json", oracle(
    f"SELECT kafka_partition, kafka_offset, {_TEXTS}, broken AS is_corrupt FROM parsed", "parsed"))
def parse_json(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "kafka_partition", "kafka_offset", *RAW_FIELDS,
        F.col(CORRUPT).isNotNull().alias("is_corrupt"),
    )


@query("p2_split_dead_letters", oracle(
    "SELECT kafka_partition, kafka_offset, kafka_offset IS NOT NULL AS has_text"
    " FROM parsed WHERE broken", "parsed"))
def split_dead_letters(spark, sf_dir):
    return clean.dead_letters(_tagged(spark, sf_dir)).select(
        "kafka_partition", "kafka_offset", F.col(CORRUPT).isNotNull().alias("has_text")
    )


@query("p3_drop_headers", oracle(
    "SELECT kafka_offset, raw_MMSI AS MMSI FROM tagged"
    " WHERE outcome <> 'header' AND outcome <> 'dead_letter'", "tagged"))
def drop_headers(spark, sf_dir):
    return _tagged(spark, sf_dir).filter(
        ~F.col("outcome").isin(clean.HEADER, clean.DEAD_LETTER)
    ).select("kafka_offset", "MMSI")


@query("p4_trim_identity", oracle(
    "SELECT kafka_offset, trim(raw_MMSI) AS MMSI FROM parsed"
    " WHERE raw_MMSI IS NOT NULL", "parsed"))
def trim_identity(spark, sf_dir):
    return _parsed(spark, sf_dir).select("kafka_offset", F.trim("MMSI").alias("MMSI")).filter(
        F.col("MMSI").isNotNull()
    )


@query("p5_identity_format", oracle(
    "SELECT outcome, trim(raw_MMSI) AS mmsi, count(*) AS row_count FROM tagged"
    " WHERE outcome IN ('mmsi_missing', 'mmsi_invalid') GROUP BY outcome, trim(raw_MMSI)",
    "tagged"))
def identity_format(spark, sf_dir):
    return (
        _tagged(spark, sf_dir).filter(F.col("outcome").isin("mmsi_missing", "mmsi_invalid"))
        .groupBy("outcome", F.trim("MMSI").alias("mmsi"))
        .agg(F.count("*").alias("row_count"))
    )


_BLANKS = ", ".join(
    f"nullif(trim(raw_{name}), '') AS {name}" for name in RAW_FIELDS if name != "MMSI"
)


@query("p6_blank_to_null", oracle(f"SELECT kafka_offset, {_BLANKS} FROM parsed", "parsed"))
def blank_to_null(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "kafka_offset",
        *(text.blank_to_null(F.col(n)).alias(n) for n in RAW_FIELDS if n != "MMSI"),
    )


_CAST_FIELDS = ("MMSI", *DOUBLE_FIELDS, *INT_FIELDS)


@query("p7_typed_casts", oracle(
    f"SELECT kafka_offset, {', '.join(_CAST_FIELDS)} FROM typed", "typed"))
def typed_casts(spark, sf_dir):
    typed = clean.typed_fields()
    return _parsed(spark, sf_dir).select(
        "kafka_offset", *(typed[n].alias(n) for n in _CAST_FIELDS)
    )


@query("p8_timestamp_parse", oracle(f"SELECT kafka_offset, {_TIME} FROM typed", "typed"))
def timestamp_parse(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "kafka_offset", clean.typed_fields()["BaseDateTime"].alias("BaseDateTime")
    )


@query("p9_timestamp_rejects", oracle(
    "SELECT kafka_offset, MMSI FROM tagged WHERE outcome = 'timestamp_invalid'", "tagged"))
def timestamp_rejects(spark, sf_dir):
    return _tagged(spark, sf_dir).filter(F.col("outcome") == "timestamp_invalid").select(
        "kafka_offset", F.col("typed_MMSI").alias("MMSI")
    )


@query("p10_position_rejects", oracle(
    "SELECT kafka_offset, MMSI, LAT, LON, outcome FROM tagged"
    " WHERE outcome LIKE 'position%'", "tagged"))
def position_rejects(spark, sf_dir):
    return _tagged(spark, sf_dir).filter(F.col("outcome").startswith("position")).select(
        "kafka_offset", *(F.col(f"typed_{n}").alias(n) for n in ("MMSI", "LAT", "LON")), "outcome"
    )


_SHOWN = ", ".join(
    "CASE WHEN outcome LIKE 'mmsi%' THEN {} ELSE CAST({} AS VARCHAR) END AS {}".format(
        "trim(raw_MMSI)" if name == "MMSI" else f"raw_{name}", name, name
    )
    for name in RAW_FIELDS
)


@query("p11_rejects_as_text", oracle(
    "SELECT CAST(kafka_partition AS VARCHAR) AS kafka_partition,"
    " CAST(kafka_offset AS VARCHAR) AS kafka_offset,"
    f" CAST(kafka_timestamp AS VARCHAR) AS kafka_timestamp, {_SHOWN}, outcome AS reject_reason"
    " FROM tagged WHERE outcome NOT IN ('clean', 'header', 'dead_letter')", "tagged"))
def rejects_as_text(spark, sf_dir):
    return clean.rejects(_tagged(spark, sf_dir))


@query("p12_null_sentinels", oracle(
    "SELECT kafka_offset, SOG, COG, Heading FROM accepted", "accepted"))
def null_sentinels(spark, sf_dir):
    return _accepted(spark, sf_dir).select("kafka_offset", "SOG", "COG", "Heading")


@query("p13_category_defaults", oracle(
    "SELECT kafka_offset, VesselName, IMO, CallSign, TransceiverClass FROM accepted",
    "accepted"))
def category_defaults(spark, sf_dir):
    return _accepted(spark, sf_dir).select(
        "kafka_offset", "VesselName", "IMO", "CallSign", "TransceiverClass"
    )


@query("p14_optional_ranges", oracle(
    "SELECT MMSI, CAST(BaseDateTime AS VARCHAR) AS BaseDateTime, SOG, COG, Heading FROM ("
    "SELECT *, CASE WHEN SOG >= 102.2 THEN NULL ELSE SOG - 10 END AS s FROM pos) AS p"
    " WHERE (s IS NULL OR s >= 0) AND (COG IS NULL OR (COG >= 0 AND COG < 360))"
    " AND (Heading IS NULL OR (Heading >= 0 AND Heading < 360))", "pos"))
def optional_ranges(spark, sf_dir):
    shifted = ais.known_sog(F.col("SOG")) - 10.0
    return views.positions(spark, sf_dir).filter(
        ais.optional_ranges(shifted, F.col("COG"), F.col("Heading"))
    ).select("MMSI", "BaseDateTime", "SOG", "COG", "Heading")


_PARTS = (
    f"{rounded('SOG * 1.852e0', 6)} AS speed_kmh, CAST(CAST(BaseDateTime AS DATE) AS VARCHAR)"
    " AS date, CAST(year(BaseDateTime) AS INTEGER) AS year,"
    " CAST(month(BaseDateTime) AS INTEGER) AS month, CAST(day(BaseDateTime) AS INTEGER) AS day,"
    " CAST(hour(BaseDateTime) AS INTEGER) AS hour,"
    " CAST(dayofweek(BaseDateTime) + 1 AS INTEGER) AS day_of_week,"
    " CAST(quarter(BaseDateTime) AS INTEGER) AS quarter"
)


@query("p15_derived_columns", oracle(f"SELECT kafka_offset, {_PARTS} FROM accepted", "accepted"))
def derived_columns(spark, sf_dir):
    return clean.add_time_parts(_accepted(spark, sf_dir)).select(
        "kafka_offset", F.round("speed_kmh", 6).alias("speed_kmh"), "date", "year", "month",
        "day", "hour", "day_of_week", "quarter",
    )


@query("p33_select_rename_literal", oracle(
    "SELECT MMSI AS mmsi, LAT AS lat, LON AS lon, 'ais' AS feed FROM pos", "pos"))
def select_rename_literal(spark, sf_dir):
    return views.positions(spark, sf_dir).select(
        F.col("MMSI").alias("mmsi"), F.col("LAT").alias("lat"), F.col("LON").alias("lon"),
        F.lit("ais").alias("feed"),
    )


@query("u1_union_by_name", oracle(
    "SELECT CAST(MMSI AS VARCHAR) AS MMSI, CAST(LAT AS VARCHAR) AS LAT, NULL AS port_id FROM pos"
    " UNION ALL SELECT CAST(MMSI AS VARCHAR), NULL, port_id FROM inport", "pos", "inport"))
def union_by_name(spark, sf_dir):
    from wakeline.operators.spatial import ports_in_range

    positions = views.positions(spark, sf_dir)
    inside = ports_in_range(positions, views.ports(spark))
    return clean.union_as_text(
        positions.select("MMSI", "LAT"), inside.select("MMSI", "port_id")
    )


@query("u4_batch_dedup", oracle(
    "SELECT MMSI, CAST(BaseDateTime AS VARCHAR) AS BaseDateTime, LAT, LON,"
    " min(kafka_offset) AS kafka_offset FROM accepted GROUP BY MMSI, BaseDateTime, LAT, LON",
    "accepted"))
def batch_dedup(spark, sf_dir):
    return drop_duplicates(
        _accepted(spark, sf_dir).select("MMSI", "BaseDateTime", "LAT", "LON", "kafka_offset"),
        ["MMSI", "BaseDateTime", "LAT", "LON"], ["kafka_offset"],
    )


@query("x10_batch_clean", oracle(
    "SELECT kafka_partition, kafka_offset, MMSI, CAST(BaseDateTime AS VARCHAR) AS BaseDateTime,"
    " LAT, LON, SOG, COG, Heading, VesselName, IMO, CallSign, VesselType, Status, Length, Width,"
    " Draft, Cargo, TransceiverClass FROM unique_rows", "unique_rows"))
def batch_clean(spark, sf_dir):
    clean_rows = clean_batch(views.messages(spark, sf_dir)).clean
    return clean_rows.select("kafka_partition", "kafka_offset", *RAW_FIELDS)


@query("a10_row_accounting", oracle(
    "SELECT outcome, count(*) AS row_count FROM tagged GROUP BY outcome", "tagged"))
def row_accounting(spark, sf_dir):
    return clean.outcome_counts(_tagged(spark, sf_dir))


@query("a10_counts_of_the_write", oracle(
    "SELECT outcome, count(*) AS row_count FROM tagged GROUP BY outcome", "tagged"))
def counts_of_the_write(spark, sf_dir):
    """The counts that a backfill observes while it writes, without a pass of their own."""
    counts = backfill(views.messages(spark, sf_dir), StreamPaths(shared_dir(spark, "counted")))
    return spark.createDataFrame([(k, n) for k, n in counts.items() if n],
                                 "outcome string, row_count bigint")


# --- full-history cleaning --------------------------------------------------------------------

_KNOWN = "IMO IS NOT NULL AND upper(trim(IMO)) <> 'IMO0000000'"
_HISTORY = (
    "SELECT DISTINCT trim(raw_MMSI) AS MMSI, BaseDateTime, LAT, LON,"
    " CASE WHEN SOG >= 102.2 THEN NULL ELSE SOG END AS SOG,"
    " CASE WHEN COG >= 360 THEN NULL ELSE COG END AS COG,"
    " CASE WHEN Heading = 511 THEN NULL ELSE Heading END AS Heading, VesselName,"
    f" CASE WHEN {_KNOWN} THEN IMO END AS IMO, CallSign, VesselType, Status, Length, Width,"
    " Draft, Cargo, TransceiverClass FROM tagged WHERE outcome = 'clean'"
)
_REFERENCE = "SELECT MMSI, " + ", ".join(
    f"arg_min({c}, BaseDateTime) FILTER ({c} IS NOT NULL) AS {c}" for c in VESSEL_ATTRIBUTES
) + " FROM history GROUP BY MMSI"


def _history_oracle(select: str) -> str:
    return oracle(
        "SELECT * FROM (SELECT 1) AS one", "tagged"
    ).removesuffix(" SELECT * FROM (SELECT 1) AS one") + (
        f", history AS ({_HISTORY}), reference AS ({_REFERENCE}) {select}"
    )


def _history_rows(spark, sf_dir):
    from wakeline.plans.history import DUPLICATE_KEY

    parsed = parse_messages(views.messages(spark, sf_dir), with_metadata=False)
    return drop_duplicates(valid_history(typed_history(parsed)), DUPLICATE_KEY)


@query("a9_first_known_attribute", _history_oracle("SELECT * FROM reference"))
def first_known_attribute(spark, sf_dir):
    return vessel_reference(_history_rows(spark, sf_dir))


_FILLED = ", ".join(
    f"coalesce(h.{c}, r.{c}) AS {c}" if c in VESSEL_ATTRIBUTES
    else ("CAST(h.BaseDateTime AS VARCHAR) AS BaseDateTime" if c == "BaseDateTime"
          else f"h.{c} AS {c}")
    for c in RAW_FIELDS
)


@query("j4_recover_attributes", _history_oracle(
    f"SELECT {_FILLED} FROM history AS h LEFT JOIN reference AS r ON h.MMSI = r.MMSI"))
def recovered_attributes(spark, sf_dir):
    return recover_attributes(_history_rows(spark, sf_dir))


_HISTORY_OUT = ", ".join(
    f"coalesce(h.{c}, r.{c}, 'UNKNOWN') AS {c}"
    if c in ("VesselName", "IMO", "CallSign", "TransceiverClass")
    else f"coalesce(h.{c}, r.{c}) AS {c}" if c in VESSEL_ATTRIBUTES
    else "CAST(h.BaseDateTime AS VARCHAR) AS BaseDateTime" if c == "BaseDateTime"
    else f"h.{c} AS {c}"
    for c in RAW_FIELDS
)
_HISTORY_PARTS = _PARTS.replace("SOG * 1.852e0", "h.SOG * 1.852e0").replace(
    "BaseDateTime", "h.BaseDateTime"
).replace(", 6)", ", 2)")


@query("e5_clean_history", _history_oracle(
    f"SELECT {_HISTORY_OUT}, {_HISTORY_PARTS} FROM history AS h"
    " LEFT JOIN reference AS r ON h.MMSI = r.MMSI"))
def full_history(spark, sf_dir):
    return clean_history(views.messages(spark, sf_dir))


@query("s2_keyed_messages", oracle(
    "SELECT MMSI AS key, concat('{', "
    + ", ',', ".join(
        f"'\"{n}\":', coalesce('\"' || {n} || '\"', 'null')" for n in RAW_FIELDS
    )
    + ", '}') AS value FROM raw", "raw"))
def keyed_messages(spark, sf_dir):
    return views.keyed(spark, sf_dir)


@query("p17_vessel_type_label", oracle(
    "SELECT vessel_type, count(*) AS row_count FROM labelled GROUP BY vessel_type", "labelled"))
def vessel_type_label(spark, sf_dir):
    label = ais.vessel_type_label(F.col("VesselType")).alias("vessel_type")
    return views.positions(spark, sf_dir).groupBy(label).agg(F.count("*").alias("row_count"))


@query("p24_grid_snap", oracle(
    "SELECT MMSI, CAST(BaseDateTime AS VARCHAR) AS BaseDateTime, "
    f"{rounded('round(LAT / 0.05e0) * 0.05e0', 4)} + 0.0 AS grid_lat,"
    f" {rounded('round(LON / 0.05e0) * 0.05e0', 4)} + 0.0 AS grid_lon FROM pos", "pos"))
def grid_snap(spark, sf_dir):
    return views.positions(spark, sf_dir).select(
        "MMSI", "BaseDateTime",
        geo.grid_value(geo.grid_rank(F.col("LAT"), 0.05), 0.05).alias("grid_lat"),
        geo.grid_value(geo.grid_rank(F.col("LON"), 0.05), 0.05).alias("grid_lon"),
    )
