"""Schemas of every table, and the fixed reference values the rules depend on."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

CORRUPT = "_corrupt_record"

# Names and groups of the source fields.
RAW_FIELDS = (
    "MMSI", "BaseDateTime", "LAT", "LON", "SOG", "COG", "Heading", "VesselName", "IMO",
    "CallSign", "VesselType", "Status", "Length", "Width", "Draft", "Cargo", "TransceiverClass",
)
DOUBLE_FIELDS = ("LAT", "LON", "SOG", "COG", "Heading", "Length", "Width", "Draft")
INT_FIELDS = ("VesselType", "Status", "Cargo")
CATEGORY_FIELDS = ("VesselName", "IMO", "CallSign", "TransceiverClass")
VESSEL_ATTRIBUTES = (
    "VesselName", "IMO", "CallSign", "VesselType", "Length", "Width", "Draft", "Cargo",
    "TransceiverClass",
)
MESSAGE_METADATA = ("kafka_partition", "kafka_offset", "kafka_timestamp")


def _struct(*pairs) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in pairs])


RAW_SCHEMA = _struct(*((name, StringType()) for name in RAW_FIELDS))
PARSE_SCHEMA = _struct(*((name, StringType()) for name in (*RAW_FIELDS, CORRUPT)))

MESSAGE_SCHEMA = _struct(
    ("key", StringType()),
    ("value", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
)

_TYPED = {
    "MMSI": LongType(),
    "BaseDateTime": TimestampType(),
    **{name: DoubleType() for name in DOUBLE_FIELDS},
    **{name: IntegerType() for name in INT_FIELDS},
}
CLEAN_SCHEMA = _struct(
    ("kafka_partition", IntegerType()),
    ("kafka_offset", LongType()),
    ("kafka_timestamp", TimestampType()),
    *((name, _TYPED.get(name, StringType())) for name in RAW_FIELDS),
    ("speed_kmh", DoubleType()),
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("day", IntegerType()),
    ("hour", IntegerType()),
    ("day_of_week", IntegerType()),
    ("quarter", IntegerType()),
    ("date", DateType()),
)

REJECT_SCHEMA = _struct(
    *((name, StringType()) for name in (*MESSAGE_METADATA, *RAW_FIELDS, "reject_reason"))
)

PORT_SCHEMA = _struct(
    ("port_id", StringType()),
    ("port_name", StringType()),
    ("port_lon", DoubleType()),
    ("port_lat", DoubleType()),
    ("radius_nm", DoubleType()),
)

ZONE_SCHEMA = _struct(
    ("port_name", StringType()),
    ("zone_type", StringType()),
    ("country_code", StringType()),
    ("geom_wkt", StringType()),
)

FLEET_STATE_SCHEMA = _struct(
    ("mmsi", LongType()),
    ("vessel_name", StringType()),
    ("lon", DoubleType()),
    ("lat", DoubleType()),
    ("geom_wkt", StringType()),
    ("sog_knots", DoubleType()),
    ("cog_degrees", DoubleType()),
    ("heading_degrees", DoubleType()),
    ("nav_status", StringType()),
    ("event_ts", TimestampType()),
    ("last_updated", TimestampType()),
)

CLUSTER_SCHEMA = _struct(
    ("kpi_date", DateType()),
    ("mmsi", LongType()),
    ("cluster_id", IntegerType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("sog_knots", DoubleType()),
    ("cog_degrees", DoubleType()),
    ("distance_to_centroid", DoubleType()),
    ("is_anomaly", BooleanType()),
    ("model_run_ts", TimestampType()),
    ("geom_wkt", StringType()),
)

# Business keys of the result tables: the columns an upsert matches on.
TABLE_KEYS = {
    "active_fleet_state": ("mmsi",),
    "vessel_speed_alerts": ("mmsi", "detected_at"),
    "port_dwell_times": ("kpi_date", "mmsi", "port_id", "entry_ts"),
    "fleet_daily_kpis": ("kpi_date", "vessel_type"),
    "route_density_grid": ("kpi_date", "grid_lat", "grid_lon"),
    "vessel_behavior_clusters": ("kpi_date", "mmsi", "model_run_ts"),
}

# ---------------------------------------------------------------------------
# Thresholds and sentinels of the AIS rules.
# ---------------------------------------------------------------------------
SOG_UNAVAILABLE = 102.2
COG_UNAVAILABLE = 360.0
HEADING_UNAVAILABLE = 511.0
IMO_UNAVAILABLE = "IMO0000000"
UNKNOWN = "UNKNOWN"
KNOT_IN_KMH = 1.852
TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"
EARTH_RADIUS_NM = 3440.065
NM_PER_DEGREE = 60.0
BOX_MARGIN = 1.2
COS_FLOOR = 0.01
DEFAULT_PORT_RADIUS_NM = 3.0
SESSION_GAP_SECONDS = 7200
GRID_STEP_DEG = 0.05
ALERT_THRESHOLD_KNOTS = 20.0
ALERT_TYPE = "SPEED_VIOLATION"
CLUSTER_COUNT = 5
CLUSTER_SEED = 42
ANOMALY_PERCENTILE = 95.0
WATERMARK = "10 minutes"
MAX_RECORDS_PER_FILE = 1_000_000
MAX_OFFSETS_PER_TRIGGER = 500_000
LIVE_TRIGGER_SECONDS = 2

# ---------------------------------------------------------------------------
# AIS vessel type codes and their names.
# ---------------------------------------------------------------------------
VESSEL_TYPES = {
    0: "Not available / Default",
    20: "Wing in Ground",
    30: "Fishing",
    31: "Towing",
    32: "Towing: length exceeds 200m or breadth exceeds 25m",
    33: "Dredging or underwater ops",
    34: "Diving ops",
    35: "Military ops",
    36: "Sailing",
    37: "Pleasure Craft",
    40: "High Speed Craft (HSC)",
    50: "Pilot Vessel",
    51: "Search and Rescue vessel",
    52: "Tug",
    53: "Port Tender",
    54: "Anti-pollution equipment",
    55: "Law Enforcement",
    56: "Spare - Local Vessel",
    57: "Spare - Local Vessel",
    58: "Medical Transport",
    60: "Passenger",
    70: "Cargo",
    71: "Cargo - Hazard A",
    72: "Cargo - Hazard B",
    73: "Cargo - Hazard C",
    74: "Cargo - Hazard D",
    79: "Cargo - No additional info",
    80: "Tanker",
    81: "Tanker - Hazard A",
    82: "Tanker - Hazard B",
    83: "Tanker - Hazard C",
    84: "Tanker - Hazard D",
    89: "Tanker - No additional info",
    90: "Other Type",
}

# ---------------------------------------------------------------------------
# Seeded ports (id, name, lon, lat, radius in nautical miles).
# ---------------------------------------------------------------------------
PORTS = [
    ("US_HOU", "Port of Houston", -95.100, 29.800, 5.0),
    ("US_SAN", "Port of San Diego", -117.200, 32.700, 3.5),
    ("US_PEV", "Port Everglades", -80.120, 26.090, 3.0),
    ("US_FOU", "Port Fourchon", -90.200, 29.110, 4.0),
    ("US_SEA", "Port of Seattle", -122.350, 47.600, 3.5),
    ("US_NYC", "Port of New York & New Jersey", -74.050, 40.670, 4.5),
    ("US_NOR", "Port of New Orleans", -90.060, 29.930, 4.0),
    ("EG_PSD", "Port Said", 32.300, 31.250, 3.0),
    ("EG_SUZ", "Suez Port", 32.560, 29.970, 3.0),
    ("EG_ALY", "Alexandria Port", 29.880, 31.190, 3.0),
]

# ---------------------------------------------------------------------------
# Seeded port zones (name, type, country, rectangle as WKT, lon first).
# ---------------------------------------------------------------------------
ZONES = [
    ("Port Said", "port", "EG",
     "POLYGON((32.25 31.20, 32.35 31.20, 32.35 31.30, 32.25 31.30, 32.25 31.20))"),
    ("Suez Port", "port", "EG",
     "POLYGON((32.52 29.95, 32.60 29.95, 32.60 30.05, 32.52 30.05, 32.52 29.95))"),
    ("Alexandria Port", "port", "EG",
     "POLYGON((29.85 31.17, 29.95 31.17, 29.95 31.23, 29.85 31.23, 29.85 31.17))"),
]
