"""Registered queries: a Spark callable each, and the DuckDB text it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from wakeline_checks import views
from wakeline.schema import RAW_FIELDS
from wakeline.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, which both engines print alike."""
    texts = {
        field.name: F.col(field.name).cast("string")
        for field in df.schema.fields
        if isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType))
    }
    return df.withColumns(texts) if texts else df


def run_job(spark: SparkSession, *arguments: str) -> None:
    """A job of the command line, in this session."""
    from wakeline.__main__ import build_parser, run

    run(spark, build_parser().parse_args(list(arguments)))


def query(key: str, oracle: str | None = None):
    """Register a query; without an oracle only its rows are checked."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(function(configure(spark), sf_dir))

        run.__name__ = key
        run.__doc__ = function.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return function

    return register


def rounded(expression: str, digits: int) -> str:
    """Halves away from zero on the decimal value, as Spark rounds doubles."""
    decimal = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(round({decimal}, {digits}) AS DOUBLE)"


def mean(column: str, digits: int) -> str:
    """Mean of a stored figure over exact decimals."""
    return rounded(f"avg(CAST({column} AS DECIMAL(18, 6)))", digits)


# --- named steps of the oracle texts ----------------------------------------------------------

_DOUBLES = ("LAT", "LON", "SOG", "COG", "Heading", "Length", "Width", "Draft")
_INTS = ("VesselType", "Status", "Cargo")


def _typed_text(name: str) -> str:
    blank = f"nullif(trim(raw_{name}), '')"
    if name == "MMSI":
        return "TRY_CAST(trim(raw_MMSI) AS BIGINT)"
    if name == "BaseDateTime":
        return f"try_strptime({blank}, '%Y-%m-%dT%H:%M:%S')"
    if name in _DOUBLES:
        return f"TRY_CAST({blank} AS DOUBLE)"
    if name in _INTS:
        return f"TRY_CAST(TRY_CAST({blank} AS DOUBLE) AS INTEGER)"
    return blank


_META = "kafka_partition, kafka_offset, kafka_timestamp"

_IN_BOX = (
    "abs(LAT - port_lat) <= radius_nm / 60 * 1.2e0 AND abs(LON - port_lon) <="
    " radius_nm / (60 * greatest(cos(radians(abs(port_lat))), 0.01e0)) * 1.2e0"
)
_CHORD = (
    "(pow(sin(radians(LAT - port_lat) / 2), 2) + cos(radians(port_lat)) * cos(radians(LAT))"
    " * pow(sin(radians(LON - port_lon) / 2), 2))"
)
DISTANCE = f"(2 * 3440.065e0 * atan2(sqrt({_CHORD}), sqrt(1 - {_CHORD})))"

_SECONDS = "CAST(floor(epoch({})) AS BIGINT)"


def seconds(expression: str) -> str:
    return _SECONDS.format(expression)


def _sessions(source: str, keys: str, prefix: str) -> dict[str, str]:
    """Row-level gap sessions in three steps: previous time, session number, visit."""
    return {
        f"{prefix}_lagged": (
            f"SELECT *, lag(BaseDateTime) OVER (PARTITION BY {keys} ORDER BY BaseDateTime)"
            f" AS prev_ts FROM {source}"
        ),
        f"{prefix}_numbered": (
            "SELECT *, CAST(sum(CASE WHEN prev_ts IS NULL OR "
            f"{seconds('BaseDateTime')} - {seconds('prev_ts')} > 7200 THEN 1 ELSE 0 END) OVER"
            f" (PARTITION BY {keys} ORDER BY BaseDateTime ROWS BETWEEN UNBOUNDED PRECEDING AND"
            f" CURRENT ROW) AS BIGINT) AS session_id FROM {prefix}_lagged"
        ),
        f"{prefix}_visits": (
            f"SELECT {keys}, session_id, min(BaseDateTime) AS entry_ts,"
            " max(BaseDateTime) AS exit_ts, count(*) AS ping_count, "
            + rounded(
                f"({seconds('max(BaseDateTime)')} - {seconds('min(BaseDateTime)')}) / 60.0e0", 2
            )
            + f" AS dwell_minutes FROM {prefix}_numbered GROUP BY {keys}, session_id"
        ),
    }


# A fixed behaviour model stands for a saved reference model, so that assignment can be compared.
MODEL_MEAN = (25.0, 0.0, 0.0, 32.0, -60.0)
MODEL_STD = (20.0, 0.7, 0.7, 5.0, 60.0)
MODEL_CENTERS = (
    (-0.8, 0.0, 0.0, 0.0, 0.0),
    (0.5, 1.0, 0.0, -0.5, 1.5),
    (0.5, -1.0, 0.0, 0.5, -0.5),
    (2.0, 0.0, 1.0, 0.0, -0.5),
    (1.0, 0.0, -1.0, 2.0, -1.0),
)
_FEATURES = ("sog_knots", "cog_sin", "cog_cos", "lat", "lon")


def _squared(center: tuple[float, ...]) -> str:
    return " + ".join(f"(s{i} - ({c!r}e0)) * (s{i} - ({c!r}e0))" for i, c in enumerate(center))


STEPS: dict[str, str] = {
    "raw": views.RAW_SQL,
    "pos": views.POSITIONS_SQL,
    "ports": views.PORTS_SQL,
    "parsed": (
        f"SELECT {_META}, broken, "
        + ", ".join(f"CASE WHEN broken THEN NULL ELSE {n} END AS raw_{n}" for n in RAW_FIELDS)
        + " FROM raw"
    ),
    "typed": "SELECT *, " + ", ".join(f"{_typed_text(n)} AS {n}" for n in RAW_FIELDS)
             + " FROM parsed",
    "tagged": (
        "SELECT *, CASE WHEN broken THEN 'dead_letter' WHEN raw_MMSI = 'MMSI' THEN 'header'"
        " WHEN raw_MMSI IS NULL THEN 'mmsi_missing'"
        " WHEN NOT regexp_full_match(trim(raw_MMSI), '[0-9]{9}') THEN 'mmsi_invalid'"
        " WHEN BaseDateTime IS NULL THEN 'timestamp_invalid'"
        " WHEN LAT NOT BETWEEN -90 AND 90 OR LON NOT BETWEEN -180 AND 180"
        " THEN 'position_out_of_range'"
        " WHEN LAT IS NULL OR LON IS NULL THEN 'position_missing' ELSE 'clean' END AS outcome"
        " FROM typed"
    ),
    "accepted": (
        f"SELECT {_META}, MMSI, BaseDateTime, LAT, LON,"
        " CASE WHEN SOG >= 102.2 THEN NULL ELSE SOG END AS SOG,"
        " CASE WHEN COG >= 360 THEN NULL ELSE COG END AS COG,"
        " CASE WHEN Heading = 511 THEN NULL ELSE Heading END AS Heading,"
        " coalesce(VesselName, 'UNKNOWN') AS VesselName,"
        " CASE WHEN IMO IS NULL OR IMO = 'IMO0000000' THEN 'UNKNOWN' ELSE IMO END AS IMO,"
        " coalesce(CallSign, 'UNKNOWN') AS CallSign, VesselType, Status, Length, Width, Draft,"
        " Cargo, coalesce(TransceiverClass, 'UNKNOWN') AS TransceiverClass"
        " FROM tagged WHERE outcome = 'clean'"
    ),
    "unique_rows": (
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY MMSI, BaseDateTime"
        f" ORDER BY kafka_timestamp, kafka_partition, kafka_offset) AS rn FROM accepted) AS r"
        " WHERE rn = 1"
    ),
    "inport": (
        f"SELECT pos.*, port_id, port_lat, port_lon, {DISTANCE} AS dist_nm FROM pos, ports"
        f" WHERE {_IN_BOX} AND {DISTANCE} <= radius_nm"
    ),
    **_sessions("inport", "MMSI, port_id", "all"),
    "runs": "SELECT inport.*, CAST(date + k AS DATE) AS kpi_date FROM inport,"
            " (VALUES (0), (1)) AS r(k)",
    **_sessions("runs", "kpi_date, MMSI, port_id", "day"),
    "last_seen": "SELECT MMSI, date AS kpi_date, max(BaseDateTime) AS day_last_ping FROM pos"
                 " GROUP BY MMSI, date",
    "dwell": (
        "SELECT v.kpi_date, v.MMSI AS mmsi, port_id, entry_ts, exit_ts, dwell_minutes"
        " FROM day_visits AS v LEFT JOIN last_seen AS l"
        " ON v.MMSI = l.MMSI AND v.kpi_date = l.kpi_date"
        " WHERE CAST(exit_ts AS DATE) = v.kpi_date AND NOT ("
        f"{seconds('CAST(v.kpi_date AS TIMESTAMP)')} + 86399 - {seconds('exit_ts')} < 7200"
        " AND (day_last_ping IS NULL OR day_last_ping <= exit_ts))"
    ),
    "names": "SELECT * FROM (VALUES (30, 'Fishing (30)'), (36, 'Sailing (36)'),"
             " (70, 'Cargo (70)'), (80, 'Tanker (80)')) AS n(code, label)",
    "labelled": (
        "SELECT pos.*, CASE WHEN VesselType IS NULL THEN 'Unknown'"
        " ELSE coalesce(label, concat('Type ', CAST(VesselType AS VARCHAR))) END AS vessel_type"
        " FROM pos LEFT JOIN names ON VesselType = code"
    ),
    "kpis": (
        "SELECT date AS kpi_date, vessel_type, "
        f"{rounded('avg(SOG)', 2)} AS avg_sog, {rounded('min(SOG)', 2)} AS min_sog,"
        f" {rounded('max(SOG)', 2)} AS max_sog,"
        f" {rounded('coalesce(stddev_samp(SOG), 0)', 2)} AS stddev_sog, count(*) AS ping_count"
        " FROM labelled WHERE SOG >= 0 AND SOG < 102.2 GROUP BY date, vessel_type"
    ),
    "alerts": (
        "SELECT BaseDateTime AS detected_at, MMSI AS mmsi, VesselName AS vessel_name,"
        f" {rounded('SOG', 2)} AS sog_knots, {rounded('LAT', 6)} AS lat, {rounded('LON', 6)}"
        " AS lon, CAST(Status AS VARCHAR) AS nav_status, 'SPEED_VIOLATION' AS alert_type,"
        " 20.0e0 AS threshold_knots FROM pos WHERE SOG > 20"
    ),
    "features": (
        "SELECT MMSI AS mmsi, BaseDateTime AS base_date_time, SOG AS sog_knots,"
        " COG AS cog_degrees, LAT AS lat, LON AS lon, sin(radians(COG)) AS cog_sin,"
        " cos(radians(COG)) AS cog_cos FROM pos WHERE MMSI > 0 AND SOG BETWEEN 0 AND 100"
        " AND COG BETWEEN 0 AND 360 AND LAT BETWEEN -90 AND 90 AND LON BETWEEN -180 AND 180"
    ),
    "scaled": "SELECT *, " + ", ".join(
        f"({name} - ({mean!r}e0)) / {std!r}e0 AS s{i}"
        for i, (name, mean, std) in enumerate(zip(_FEATURES, MODEL_MEAN, MODEL_STD))
    ) + " FROM features",
    "distances": "SELECT *, " + ", ".join(
        f"{_squared(center)} AS d{i}" for i, center in enumerate(MODEL_CENTERS)
    ) + " FROM scaled",
    "assigned": (
        "SELECT *, CAST(base_date_time AS DATE) AS kpi_date,"
        " CASE WHEN d0 = least(d0, d1, d2, d3, d4) THEN 0"
        " WHEN d1 = least(d0, d1, d2, d3, d4) THEN 1 WHEN d2 = least(d0, d1, d2, d3, d4) THEN 2"
        " WHEN d3 = least(d0, d1, d2, d3, d4) THEN 3 ELSE 4 END AS cluster_id,"
        " sqrt(least(d0, d1, d2, d3, d4)) AS distance_to_centroid FROM distances"
    ),
    "thresholds": (
        "SELECT kpi_date, cluster_id, quantile_disc(distance_to_centroid, 0.95)"
        " AS threshold_distance FROM assigned GROUP BY kpi_date, cluster_id"
    ),
    "flagged": (
        "SELECT a.*, threshold_distance,"
        " coalesce(a.distance_to_centroid > threshold_distance, false) AS is_anomaly"
        " FROM assigned AS a JOIN thresholds AS t"
        " ON a.kpi_date = t.kpi_date AND a.cluster_id = t.cluster_id"
    ),
    "clusters": (
        f"SELECT kpi_date, mmsi, cluster_id, {rounded('lat', 6)} AS lat, {rounded('lon', 6)}"
        f" AS lon, {rounded('sog_knots', 2)} AS sog_knots, {rounded('cog_degrees', 2)}"
        f" AS cog_degrees, {rounded('distance_to_centroid', 4)} AS distance_to_centroid,"
        " is_anomaly, concat('POINT(', CAST(lon AS VARCHAR), ' ', CAST(lat AS VARCHAR), ')')"
        " AS geom_wkt FROM (SELECT *, row_number() OVER (PARTITION BY kpi_date, mmsi"
        " ORDER BY base_date_time DESC, distance_to_centroid DESC) AS rn FROM flagged) AS f"
        " WHERE rn = 1"
    ),
    "state": (
        "SELECT mmsi, vessel_name, lat, lon, sog_knots, cog_degrees, heading_degrees, nav_status,"
        " event_ts FROM (SELECT MMSI AS mmsi, VesselName AS vessel_name, LAT AS lat, LON AS lon,"
        " SOG AS sog_knots, COG AS cog_degrees, Heading AS heading_degrees,"
        " CAST(Status AS VARCHAR) AS nav_status, BaseDateTime AS event_ts, row_number() OVER"
        " (PARTITION BY MMSI ORDER BY BaseDateTime DESC) AS rn FROM unique_rows) AS s"
        " WHERE rn = 1"
    ),
}

_NEEDS = {
    "parsed": ["raw"], "typed": ["parsed"], "tagged": ["typed"], "accepted": ["tagged"],
    "unique_rows": ["accepted"], "inport": ["pos", "ports"],
    "all_lagged": ["inport"], "all_numbered": ["all_lagged"], "all_visits": ["all_numbered"],
    "runs": ["inport"], "day_lagged": ["runs"], "day_numbered": ["day_lagged"],
    "day_visits": ["day_numbered"], "last_seen": ["pos"], "dwell": ["day_visits", "last_seen"],
    "labelled": ["pos", "names"], "kpis": ["labelled"], "alerts": ["pos"], "features": ["pos"],
    "scaled": ["features"], "distances": ["scaled"], "assigned": ["distances"],
    "thresholds": ["assigned"], "flagged": ["assigned", "thresholds"], "clusters": ["flagged"],
    "state": ["unique_rows"],
}


def oracle(select: str, *steps: str) -> str:
    """A statement over the named steps and everything they build on."""
    ordered: list[str] = []

    def add(step: str) -> None:
        for needed in _NEEDS.get(step, []):
            add(needed)
        if step not in ordered:
            ordered.append(step)

    for step in steps:
        add(step)
    if not ordered:
        return select
    return "WITH " + ", ".join(f"{s} AS ({STEPS[s]})" for s in ordered) + f" {select}"
