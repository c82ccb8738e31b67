"""AIS views over the `events` test table, as SQL that both Spark and DuckDB read.

The test tables hold no ship positions, so both engines derive the same ones: raw text rows with
injected faults (`RAW_SQL`) and typed positions (`POSITIONS_SQL`). Speeds are whole quarters of a
knot, so that sums do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.plans.daily import seed_ports
from wakeline.schema import PORTS, RAW_FIELDS
from wakeline.session import configure
from wakeline.sources.messages import to_messages

_PORT_ROWS = ", ".join(
    f"({number}, {round(lon * 1000)}, {round(lat * 1000)})"
    for number, (_, _, lon, lat, _) in enumerate(PORTS)
)

PORTS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    "('{}', '{}', CAST({} AS DOUBLE), CAST({} AS DOUBLE), CAST({} AS DOUBLE))".format(
        port_id, name, lon, lat, radius
    )
    for port_id, name, lon, lat, radius in PORTS
) + ") AS p(port_id, port_name, port_lon, port_lat, radius_nm)"


def _events_sql(with_copies: bool) -> str:
    columns = "event_id AS e, user_id AS u, event_type AS t, value AS v, ts"
    copies = (
        f" UNION ALL SELECT {columns}, 1 AS copy FROM events WHERE event_id % 20 = 0"
        if with_copies else ""
    )
    return f"SELECT {columns}, 0 AS copy FROM events{copies}"


def _fields_sql() -> dict[str, str]:
    lat = "CAST(lat_milli + (e * 37) % 101 - 50 AS DOUBLE) / 1000"
    lon = "CAST(lon_milli + (e * 53) % 101 - 50 AS DOUBLE) / 1000"
    return {
        "MMSI": "CAST(366000000 + u AS STRING)",
        "BaseDateTime": "replace(CAST(CAST(date_trunc('second', ts) AS TIMESTAMP) AS STRING),"
                        " ' ', 'T')",
        "LAT": f"printf('%.3f', {lat})",
        "LON": f"printf('%.3f', {lon})",
        "SOG": "printf('%.2f', CAST(floor(v * 4) AS DOUBLE) / 4)",
        "COG": "CAST((e * 7) % 400 AS STRING)",
        "Heading": "CASE WHEN e % 10 = 0 THEN '511' ELSE CAST((e * 7) % 360 AS STRING) END",
        "VesselName": "CASE WHEN e % 13 = 0 THEN '   '"
                      " ELSE concat('VESSEL ', CAST(u AS STRING)) END",
        "IMO": "CASE WHEN e % 17 = 0 THEN 'IMO0000000' WHEN e % 19 = 0 THEN ''"
               " ELSE concat('IMO', CAST(9000000 + u AS STRING)) END",
        "CallSign": "CASE WHEN e % 23 = 0 THEN NULL ELSE concat('WX', CAST(u AS STRING)) END",
        "VesselType": "CASE WHEN e % 50 = 0 THEN '99' WHEN t = 'click' THEN '70'"
                      " WHEN t = 'view' THEN '30.0' WHEN t = 'purchase' THEN '80'"
                      " WHEN t = 'signup' THEN '36' ELSE '' END",
        "Status": "CASE WHEN e % 29 = 0 THEN 'x' ELSE CAST(e % 16 AS STRING) END",
        "Length": "CASE WHEN e % 11 = 0 THEN NULL"
                  " ELSE printf('%.1f', CAST(20 + u % 300 AS DOUBLE)) END",
        "Width": "printf('%.1f', CAST(5 + u % 40 AS DOUBLE))",
        "Draft": "CASE WHEN e % 3 = 0 THEN printf('%.1f', CAST(u % 15 AS DOUBLE)) ELSE ' ' END",
        "Cargo": "CASE WHEN e % 2 = 0 THEN CAST(70 + u % 10 AS STRING) ELSE NULL END",
        "TransceiverClass": "CASE WHEN e % 31 = 0 THEN '' WHEN u % 2 = 0 THEN 'A' ELSE 'B' END",
    }


def _faulty_sql() -> dict[str, str]:
    fields = _fields_sql()
    identity, time, lat = fields["MMSI"], fields["BaseDateTime"], fields["LAT"]
    fields["MMSI"] = (
        "CASE WHEN e % 73 = 0 THEN 'MMSI' WHEN e % 67 = 0 THEN NULL"
        f" WHEN e % 83 = 0 THEN CAST(36600000 + u AS STRING) WHEN e % 7 = 0 THEN"
        f" concat(' ', {identity}, ' ') ELSE {identity} END"
    )
    fields["BaseDateTime"] = f"CASE WHEN e % 79 = 0 THEN 'zz' ELSE {time} END"
    fields["LAT"] = (
        f"CASE WHEN e % 89 = 0 THEN '  ' WHEN e % 71 = 0 THEN '95.000' ELSE {lat} END"
    )
    return fields


def _select_sql(fields: dict[str, str], extra: str, with_copies: bool) -> str:
    listed = ", ".join(f"{text} AS {name}" for name, text in fields.items())
    return (
        f"SELECT {extra}{listed} FROM ({_events_sql(with_copies)}) AS ev"
        f" JOIN (VALUES {_PORT_ROWS}) AS home(idx, lon_milli, lat_milli) ON u % 10 = idx"
    )


RAW_SQL = _select_sql(
    _faulty_sql(),
    "CAST(u % 3 AS INT) AS kafka_partition, CAST(e * 2 + copy AS BIGINT) AS kafka_offset,"
    " CAST(date_trunc('second', ts) AS TIMESTAMP) AS kafka_timestamp, e % 97 = 0 AS broken, ",
    True,
)


def _typed_sql() -> dict[str, str]:
    """The same readings as typed values, straight from the event columns."""
    return {
        "MMSI": "CAST(366000000 + u AS BIGINT)",
        "BaseDateTime": "CAST(date_trunc('second', ts) AS TIMESTAMP)",
        "LAT": "CAST(lat_milli + (e * 37) % 101 - 50 AS DOUBLE) / 1000",
        "LON": "CAST(lon_milli + (e * 53) % 101 - 50 AS DOUBLE) / 1000",
        "SOG": "CAST(floor(v * 4) AS DOUBLE) / 4",
        "COG": "CAST((e * 7) % 400 AS DOUBLE)",
        "Heading": "CAST(CASE WHEN e % 10 = 0 THEN 511 ELSE (e * 7) % 360 END AS DOUBLE)",
        "VesselName": "CASE WHEN e % 13 <> 0 THEN concat('VESSEL ', CAST(u AS STRING)) END",
        "IMO": "CASE WHEN e % 17 = 0 THEN 'IMO0000000' WHEN e % 19 <> 0"
               " THEN concat('IMO', CAST(9000000 + u AS STRING)) END",
        "CallSign": "CASE WHEN e % 23 <> 0 THEN concat('WX', CAST(u AS STRING)) END",
        "VesselType": "CAST(CASE WHEN e % 50 = 0 THEN 99 WHEN t = 'click' THEN 70"
                      " WHEN t = 'view' THEN 30 WHEN t = 'purchase' THEN 80"
                      " WHEN t = 'signup' THEN 36 END AS INT)",
        "Status": "CAST(CASE WHEN e % 29 <> 0 THEN e % 16 END AS INT)",
        "Length": "CAST(CASE WHEN e % 11 <> 0 THEN 20 + u % 300 END AS DOUBLE)",
        "Width": "CAST(5 + u % 40 AS DOUBLE)",
        "Draft": "CAST(CASE WHEN e % 3 = 0 THEN u % 15 END AS DOUBLE)",
        "Cargo": "CAST(CASE WHEN e % 2 = 0 THEN 70 + u % 10 END AS INT)",
        "TransceiverClass": "CASE WHEN e % 31 = 0 THEN NULL WHEN u % 2 = 0 THEN 'A' ELSE 'B' END",
    }


POSITIONS_SQL = _select_sql(_typed_sql(), "CAST(ts AS DATE) AS date, ", False)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows with message metadata and a flag for those to be sent broken."""
    return spark.sql(
        RAW_SQL.replace("FROM events", "FROM {events}"), events=_events(spark, sf_dir)
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows as topic messages; broken ones are cut in the middle of the JSON text."""
    rows = raw(spark, sf_dir)
    body = F.to_json(F.struct(*RAW_FIELDS))
    value = F.when(F.col("broken"), F.substring(body, 1, 20)).otherwise(body)
    return rows.select(
        F.trim("MMSI").alias("key"),
        value.alias("value"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows through the publisher."""
    return to_messages(raw(spark, sf_dir).select(*RAW_FIELDS))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed positions, readings beyond the sentinels included, no faulty rows."""
    return spark.sql(
        POSITIONS_SQL.replace("FROM events", "FROM {events}"), events=_events(spark, sf_dir)
    )


def ports(spark: SparkSession) -> DataFrame:
    return seed_ports(spark)
