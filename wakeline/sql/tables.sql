-- Tables the publish job and the JDBC sinks write. Staging tables are made from them when needed.
-- Point columns hold WKT text; a database with a geometry type can derive one in a view.

CREATE TABLE IF NOT EXISTS active_fleet_state (
    mmsi BIGINT PRIMARY KEY,
    vessel_name TEXT,
    lon DOUBLE PRECISION,
    lat DOUBLE PRECISION,
    geom_wkt TEXT,
    sog_knots DOUBLE PRECISION,
    cog_degrees DOUBLE PRECISION,
    heading_degrees DOUBLE PRECISION,
    nav_status TEXT,
    event_ts TIMESTAMP,
    last_updated TIMESTAMP
);

CREATE TABLE IF NOT EXISTS vessel_speed_alerts (
    detected_at TIMESTAMP NOT NULL,
    mmsi BIGINT NOT NULL,
    vessel_name TEXT,
    sog_knots DOUBLE PRECISION,
    lat DOUBLE PRECISION,
    lon DOUBLE PRECISION,
    nav_status TEXT,
    alert_type TEXT,
    threshold_knots DOUBLE PRECISION,
    UNIQUE (mmsi, detected_at)
);

CREATE TABLE IF NOT EXISTS port_dwell_times (
    kpi_date DATE NOT NULL,
    mmsi BIGINT NOT NULL,
    port_id TEXT NOT NULL,
    entry_ts TIMESTAMP NOT NULL,
    exit_ts TIMESTAMP,
    dwell_minutes DOUBLE PRECISION,
    UNIQUE (kpi_date, mmsi, port_id, entry_ts)
);

CREATE TABLE IF NOT EXISTS fleet_daily_kpis (
    kpi_date DATE NOT NULL,
    vessel_type TEXT NOT NULL,
    avg_sog DOUBLE PRECISION,
    min_sog DOUBLE PRECISION,
    max_sog DOUBLE PRECISION,
    stddev_sog DOUBLE PRECISION,
    ping_count BIGINT,
    UNIQUE (kpi_date, vessel_type)
);

CREATE TABLE IF NOT EXISTS route_density_grid (
    kpi_date DATE NOT NULL,
    grid_lat DOUBLE PRECISION NOT NULL,
    grid_lon DOUBLE PRECISION NOT NULL,
    ping_count BIGINT,
    UNIQUE (kpi_date, grid_lat, grid_lon)
);

CREATE TABLE IF NOT EXISTS vessel_behavior_clusters (
    kpi_date DATE NOT NULL,
    mmsi BIGINT NOT NULL,
    cluster_id INTEGER,
    lat DOUBLE PRECISION,
    lon DOUBLE PRECISION,
    sog_knots DOUBLE PRECISION,
    cog_degrees DOUBLE PRECISION,
    distance_to_centroid DOUBLE PRECISION,
    is_anomaly BOOLEAN,
    model_run_ts TIMESTAMP,
    geom_wkt TEXT
);
