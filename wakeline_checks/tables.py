"""Checks of sources, sinks and keyed tables; written data goes to the session's shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeline_checks import views
from wakeline_checks.kpis import _inside, _positions
from wakeline_checks.registry import mean, oracle, query, rounded, run_job
from wakeline.operators.latest import replace_day, upsert
from wakeline.operators.quality import day_counts
from wakeline.plans import kpi
from wakeline.plans.basics import union_all
from wakeline.schema import FLEET_STATE_SCHEMA, PORT_SCHEMA, RAW_FIELDS, TABLE_KEYS
from wakeline.session import materialize, shared_dir
from wakeline.sources import archive, csv_archive, files, tables
from wakeline.streaming.pipeline import fleet_state
from wakeline.streaming.positions import DUPLICATE_KEY, FIRST_MESSAGE, clean_batch
from wakeline.streaming.sinks import ArchiveSink, FleetStateSink, fleet_updates

_WHEN = "CAST(BaseDateTime AS VARCHAR) AS BaseDateTime"


def _written_csv(spark, sf_dir) -> list[str]:
    folder = shared_dir(spark, "csv")
    rows = views.raw(spark, sf_dir).select(*RAW_FIELDS)
    rows.write.option("header", True).option("escape", '"').csv(folder)
    return [f"{folder}/{n}" for n in files.children(spark, folder) if n.endswith(".csv")]


_STRIPPED = ", ".join(f"coalesce(trim({n}), '') AS {n}" for n in RAW_FIELDS)


@query("s1_csv_archive_scan", oracle(
    f"SELECT {_STRIPPED} FROM raw WHERE MMSI IS NOT NULL AND trim(MMSI) NOT IN ('', 'MMSI')",
    "raw"))
def csv_scan(spark, sf_dir):
    return csv_archive.read_archive(spark, _written_csv(spark, sf_dir)).drop(csv_archive.FILE)


@query("s3_archive_row_total", oracle(
    "SELECT count(*) AS row_count FROM raw"
    " WHERE MMSI IS NOT NULL AND trim(MMSI) NOT IN ('', 'MMSI')", "raw"))
def csv_rows(spark, sf_dir):
    """Rows over all files, as the gate counts them per file."""
    rows = csv_archive.read_archive(spark, _written_csv(spark, sf_dir))
    per_file = rows.groupBy(csv_archive.FILE).agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("row_count"))


@query("s22_csv_round_trip",
       "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, sf_dir):
    customers = views.table(spark, sf_dir, "customer")
    folder = shared_dir(spark, "csv-copy")
    customers.write.option("header", True).csv(folder)
    return spark.read.schema(customers.schema).option("header", True).csv(folder)


_BATCHES = 4


_POSITION = [name for name in RAW_FIELDS if name != "BaseDateTime"]
_ARCHIVED = (
    f"SELECT kafka_offset, {_WHEN}, {', '.join(_POSITION)},"
    " CAST(CAST(BaseDateTime AS DATE) AS VARCHAR) AS date FROM unique_rows"
)


def _archived_batches(spark, sf_dir) -> str:
    """Four batches, the last one again after a restart, which a new sink stands for."""
    folder = shared_dir(spark, "archive")
    # Written once: each batch, and each look at the days of one, would clean all messages anew.
    rows = materialize(clean_batch(views.messages(spark, sf_dir)).clean, "clean")
    part = F.pmod(F.xxhash64("MMSI", "BaseDateTime"), F.lit(_BATCHES))
    sink = ArchiveSink(folder)
    for number in range(_BATCHES):
        sink(rows.filter(part == number), number)
    ArchiveSink(folder)(rows.filter(part == _BATCHES - 1), 0)
    return folder


@query("s7_archive_batches", oracle(_ARCHIVED, "unique_rows"))
def archived_batches(spark, sf_dir):
    """The repeated batch must not add rows."""
    return archive.read_archive(spark, _archived_batches(spark, sf_dir)).select(
        "kafka_offset", "BaseDateTime", *_POSITION, "date")


@query("s7_archive_compacted", oracle(_ARCHIVED, "unique_rows"))
def compacted_archive(spark, sf_dir):
    """One day stored twice over and compacted: each key once, the other days untouched."""
    folder = _archived_batches(spark, sf_dir)
    day = archive.read_days(spark, folder, "2024-01-15")
    archive.append_by_date(day, folder)
    archive.compact_day(spark, folder, "2024-01-15", DUPLICATE_KEY, FIRST_MESSAGE)
    return archive.read_archive(spark, folder).select(
        "kafka_offset", "BaseDateTime", *_POSITION, "date")


def _archived(spark, sf_dir) -> str:
    folder = shared_dir(spark, "days")
    archive.write_by_date(_positions(spark, sf_dir), folder)
    return folder


@query("s9_overwrite_by_date", oracle(
    f"SELECT MMSI, {_WHEN}, LAT, LON, CAST(date AS VARCHAR) AS date FROM pos", "pos"))
def overwritten_days(spark, sf_dir):
    """Written, then one day written again: the day is replaced, the others stay."""
    folder = _archived(spark, sf_dir)
    again = _positions(spark, sf_dir).filter(F.col("date") == F.to_date(F.lit("2024-01-10")))
    archive.write_by_date(again, folder)
    return archive.read_archive(spark, folder).select("MMSI", "BaseDateTime", "LAT", "LON", "date")


@query("s10_read_one_day", oracle(
    f"SELECT MMSI, {_WHEN}, LAT, LON FROM pos WHERE date = DATE '2024-01-15'", "pos"))
def one_day(spark, sf_dir):
    return archive.read_days(spark, _archived(spark, sf_dir), "2024-01-15").select(
        "MMSI", "BaseDateTime", "LAT", "LON"
    )


@query("s11_day_with_previous", oracle(
    "SELECT CAST(date AS VARCHAR) AS date, count(*) AS row_count FROM pos"
    " WHERE date BETWEEN DATE '2023-12-31' AND DATE '2024-01-01' GROUP BY date", "pos"))
def day_with_previous(spark, sf_dir):
    """The first day of the data: its previous day does not exist."""
    both = archive.read_day_with_previous(spark, _archived(spark, sf_dir), "2024-01-01")
    return both.groupBy("date").agg(F.count("*").alias("row_count"))


_FIGURES = ("avg_sog", "min_sog", "max_sog", "stddev_sog", "ping_count")
_IN_PORT_KPIS = (
    "in_port_kpis AS (SELECT date AS kpi_date, vessel_type, {avg} AS avg_sog, {low} AS min_sog,"
    " {high} AS max_sog, {dev} AS stddev_sog, count(*) AS ping_count FROM labelled"
    " WHERE SOG >= 0 AND SOG < 102.2 AND (MMSI, BaseDateTime, LAT, LON) IN"
    " (SELECT (MMSI, BaseDateTime, LAT, LON) FROM inport) GROUP BY date, vessel_type)"
)


def _in_port_oracle(select: str) -> str:
    from wakeline_checks.registry import rounded

    step = _IN_PORT_KPIS.format(
        avg=rounded("avg(SOG)", 2), low=rounded("min(SOG)", 2), high=rounded("max(SOG)", 2),
        dev=rounded("coalesce(stddev_samp(SOG), 0)", 2),
    )
    marker = " SELECT 1"
    return oracle("SELECT 1", "kpis", "inport").removesuffix(marker) + f", {step} {select}"


_MERGED = (
    "SELECT CAST(coalesce(k.kpi_date, p.kpi_date) AS VARCHAR) AS kpi_date,"
    " coalesce(k.vessel_type, p.vessel_type) AS vessel_type, "
    + ", ".join(f"coalesce(p.{c}, k.{c}) AS {c}" for c in _FIGURES)
    + " FROM kpis AS k FULL JOIN in_port_kpis AS p"
    " ON k.kpi_date = p.kpi_date AND k.vessel_type = p.vessel_type"
)


def _kpi_pair(spark, sf_dir):
    """All figures, and the figures of in-port positions as a correction of them."""
    return (
        kpi.fleet_daily_kpis(_positions(spark, sf_dir)),
        kpi.fleet_daily_kpis(_inside(spark, sf_dir)),
    )


@query("s14_upsert", _in_port_oracle(_MERGED))
def upserted(spark, sf_dir):
    table, updates = _kpi_pair(spark, sf_dir)
    return upsert(table, updates, TABLE_KEYS["fleet_daily_kpis"])


@query("s14_upsert_stored", _in_port_oracle(_MERGED))
def upserted_stored(spark, sf_dir):
    """The same on a stored table, with the update applied twice."""
    table, updates = _kpi_pair(spark, sf_dir)
    base = shared_dir(spark, "results")
    for rows in (table, updates, updates):
        tables.upsert_result(rows, base, "fleet_daily_kpis")
    return tables.read_table(spark, f"{base}/fleet_daily_kpis").select(table.columns)


_REPLACED = (
    "SELECT CAST(kpi_date AS VARCHAR) AS kpi_date, vessel_type, " + ", ".join(_FIGURES)
    + " FROM (SELECT * FROM kpis WHERE kpi_date <> DATE '2024-01-15' UNION ALL BY NAME"
    " SELECT * FROM in_port_kpis WHERE kpi_date = DATE '2024-01-15') AS t"
)


@query("s15_replace_day", _in_port_oracle(_REPLACED))
def replaced_day(spark, sf_dir):
    table, updates = _kpi_pair(spark, sf_dir)
    return replace_day(table, updates, "kpi_date", "2024-01-15")


@query("s15_replace_day_stored", _in_port_oracle(_REPLACED))
def replaced_day_stored(spark, sf_dir):
    table, updates = _kpi_pair(spark, sf_dir)
    path = shared_dir(spark, "replace")
    tables.upsert_table(table, path, TABLE_KEYS["fleet_daily_kpis"])
    tables.replace_table_day(updates, path, "2024-01-15")
    return tables.read_table(spark, path).select(table.columns)


_STATE = (
    "SELECT mmsi, vessel_name, lat, lon, sog_knots, cog_degrees, heading_degrees, nav_status,"
    " CAST(event_ts AS VARCHAR) AS event_ts FROM state"
)
_STATE_COLUMNS = (
    "mmsi", "vessel_name", "lat", "lon", "sog_knots", "cog_degrees", "heading_degrees",
    "nav_status", "event_ts",
)


@query("w1_latest_per_vessel", oracle(_STATE, "state"))
def latest_state(spark, sf_dir):
    return fleet_updates(clean_batch(views.messages(spark, sf_dir)).clean).select(*_STATE_COLUMNS)


def _stored_state(spark, sf_dir):
    """Afternoon positions first, then the older morning ones: newer rows must stay."""
    folder = shared_dir(spark, "state")
    rows = clean_batch(views.messages(spark, sf_dir)).clean
    sink = FleetStateSink(folder)
    for number, part in enumerate((F.col("hour") >= 12, F.col("hour") < 12)):
        sink(rows.filter(part), number)
    for day in archive.stored_days(spark, folder, "written_on"):
        tables.compact_changes(spark, folder, day, FLEET_STATE_SCHEMA, ["mmsi"], "event_ts",
                               "written_on")
    return fleet_state(spark, folder)


@query("s16_latest_state_merge", oracle(_STATE, "state"))
def merged_state(spark, sf_dir):
    return _stored_state(spark, sf_dir).select(*_STATE_COLUMNS)


@query("s16_state_from_snapshot", oracle(_STATE, "state"))
def state_from_snapshot(spark, sf_dir):
    """Changes of many days, a snapshot over the older half: the state of snapshot and later days."""
    folder = shared_dir(spark, "snapshot")
    rows = clean_batch(views.messages(spark, sf_dir)).clean.withColumn("written_on", F.col("date"))
    archive.append_by_date(fleet_updates(rows, "written_on"), folder, "written_on")
    days = sorted(archive.stored_days(spark, folder, "written_on"))
    for day in days[:len(days) // 2][-2:]:
        tables.snapshot_state(spark, folder, day, FLEET_STATE_SCHEMA, ["mmsi"], "event_ts")
    return fleet_state(spark, folder).select(*_STATE_COLUMNS)


@query("p30_point_view", oracle(
    "SELECT mmsi, vessel_name, lat, lon, sog_knots, cog_degrees, heading_degrees, nav_status"
    " FROM state", "state"))
def point_view(spark, sf_dir):
    """The view over the stored state, coordinates taken back out of the point text."""
    from wakeline.plans import reports

    return reports.fleet_view(_stored_state(spark, sf_dir)).drop("last_updated")


@query("l3_recent_roster", oracle(
    "SELECT mmsi, vessel_name, sog_knots, cog_degrees, nav_status,"
    " CAST(event_ts AS VARCHAR) AS last_updated FROM state"
    " ORDER BY event_ts DESC, mmsi LIMIT 100", "state"))
def roster(spark, sf_dir):
    from wakeline.plans import reports

    state = latest_state(spark, sf_dir).withColumn("last_updated", F.col("event_ts"))
    return reports.recent_roster(state)


@query("p32_map_feed", oracle(
    "SELECT mmsi, lat, lon, CAST(event_ts AS VARCHAR) AS last_updated FROM state"
    " ORDER BY event_ts DESC, mmsi", "state"))
def map_feed(spark, sf_dir):
    from wakeline.plans import reports

    state = latest_state(spark, sf_dir).withColumn("last_updated", F.col("event_ts"))
    return reports.map_feed(state)


@query("s25_seeded_ports_in_use", oracle(
    "SELECT p.port_id, port_name, port_lon, port_lat, radius_nm, count(MMSI) AS pings"
    " FROM ports AS p LEFT JOIN (SELECT port_id, MMSI FROM inport) AS i"
    " ON p.port_id = i.port_id GROUP BY ALL", "ports", "inport"))
def seeded_ports(spark, sf_dir):
    """Ports seeded twice into a stored dimension, then read back and counted against pings."""
    from wakeline.plans.daily import seed_ports

    path = shared_dir(spark, "ports")
    seed_ports(spark, path).write.parquet(path)
    dimension = seed_ports(spark, path).select(*PORT_SCHEMA.fieldNames())
    pings = _inside(spark, sf_dir).groupBy("port_id").agg(F.count("*").alias("pings"))
    return dimension.join(pings, "port_id", "left").fillna(0, ["pings"])


@query("a27_rows_per_table_and_day", oracle(
    "SELECT 'fleet_daily_kpis' AS table_name, CAST(kpi_date AS VARCHAR) AS kpi_date,"
    " count(*) AS row_count FROM kpis GROUP BY kpi_date UNION ALL"
    " SELECT 'port_dwell_times', CAST(kpi_date AS VARCHAR), count(*) FROM dwell"
    " GROUP BY kpi_date", "kpis", "dwell"))
def rows_per_table(spark, sf_dir):
    positions = _positions(spark, sf_dir)
    return day_counts({
        "fleet_daily_kpis": kpi.fleet_daily_kpis(positions),
        "port_dwell_times": kpi.port_dwell_times(positions, views.ports(spark)),
    })


# --- jobs -------------------------------------------------------------------------------------

_DAY = "2024-01-15"


def _daily_results(spark, sf_dir, *jobs: str) -> str:
    """Jobs of the command line for one day over a stored archive."""
    base = shared_dir(spark, "daily")
    archive.write_by_date(_positions(spark, sf_dir), f"{base}/archive")
    for job in jobs:
        models = ["--models", f"{base}/models"] if job != "kpis" else []
        run_job(spark, job, "--archive", f"{base}/archive", "--results", base,
                "--exec-date", _DAY, *models)
    return base


@query("e2_daily_kpis", oracle(
    f"SELECT 'visits' AS table_name, CAST(count(*) AS BIGINT) AS row_count, {mean('dwell_minutes', 4)}"
    f" AS figure FROM dwell WHERE kpi_date = DATE '{_DAY}' UNION ALL"
    f" SELECT 'fleet', count(*), {mean('avg_sog', 4)} FROM kpis WHERE kpi_date = DATE '{_DAY}'"
    f" UNION ALL SELECT 'alerts', count(*), {mean('sog_knots', 4)} FROM alerts"
    f" WHERE CAST(detected_at AS DATE) = DATE '{_DAY}'", "dwell", "kpis", "alerts"))
def daily_kpis_job(spark, sf_dir):
    """The kpis job run twice for a day, its tables read back."""
    base = _daily_results(spark, sf_dir, "kpis", "kpis")
    parts = (("visits", "port_dwell_times", "dwell_minutes"),
             ("fleet", "fleet_daily_kpis", "avg_sog"),
             ("alerts", "vessel_speed_alerts", "sog_knots"))
    return union_all([
        tables.read_table(spark, f"{base}/{table}").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count"),
            F.round(F.avg(F.col(figure).cast("decimal(18,6)")), 4).cast("double").alias("figure"))
        for name, table, figure in parts])


@query("e3_daily_clusters", oracle(
    f"SELECT mmsi, {rounded('lat', 6)} AS lat, {rounded('lon', 6)} AS lon, true AS has_geometry"
    " FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY base_date_time DESC) AS rn"
    f" FROM features WHERE CAST(base_date_time AS DATE) = DATE '{_DAY}') AS f WHERE rn = 1",
    "features"))
def daily_clusters_job(spark, sf_dir):
    base = _daily_results(spark, sf_dir, "clusters", "clusters")
    return tables.read_table(spark, f"{base}/vessel_behavior_clusters").select(
        "mmsi", "lat", "lon", F.col("geom_wkt").isNotNull().alias("has_geometry"))


@query("e4_daily_chain", oracle(
    "SELECT 'port_dwell_times' AS table_name, count(*) AS row_count FROM dwell"
    f" WHERE kpi_date = DATE '{_DAY}' UNION ALL SELECT 'fleet_daily_kpis', count(*) FROM kpis"
    f" WHERE kpi_date = DATE '{_DAY}' UNION ALL SELECT 'vessel_behavior_clusters',"
    " count(DISTINCT mmsi) FROM features"
    f" WHERE CAST(base_date_time AS DATE) = DATE '{_DAY}'", "dwell", "kpis", "features"))
def daily_chain(spark, sf_dir):
    base = _daily_results(spark, sf_dir, "day")
    names = ("port_dwell_times", "fleet_daily_kpis", "vessel_behavior_clusters")
    return day_counts({name: tables.read_table(spark, f"{base}/{name}") for name in names}).select(
        "table_name", "row_count")
