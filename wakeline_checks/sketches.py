"""Checks of stored sketches, congestion windows and visits of a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeline.operators import sketches
from wakeline.operators.spatial import ports_in_range
from wakeline.plans.congestion import port_congestion, port_slots
from wakeline.session import shared_dir
from wakeline.streaming.visits import stream_port_visits
from wakeline_checks import views
from wakeline_checks.clusters import _assigned
from wakeline_checks.kpis import _inside, _positions
from wakeline_checks.registry import mean, oracle, query, seconds
from wakeline_checks.streams import drain, own_session


def _stored(df, spark, name: str):
    folder = shared_dir(spark, name)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


@query("a7_threshold_over_range", oracle(
    "SELECT cluster_id, count(*) AS n, true AS within_rank_error FROM assigned GROUP BY 1",
    "assigned"))
def threshold_over_range(spark, sf_dir):
    """One threshold a cluster over all days from the days' sketches, held against the exact rank."""
    rows = _assigned(spark, sf_dir).select("kpi_date", "cluster_id", "distance_to_centroid")
    days = _stored(sketches.quantile_sketches(
        rows, ("kpi_date", "cluster_id"), "distance_to_centroid"), spark, "quantiles")
    found = sketches.merged_quantiles(days, ["cluster_id"], 0.95)
    ranks = rows.join(found, "cluster_id").groupBy("cluster_id", "n").agg(
        (F.count_if(F.col("distance_to_centroid") <= F.col("threshold")) / F.count("*")).alias("r"),
        (F.count_if(F.col("distance_to_centroid") < F.col("threshold")) / F.count("*")).alias("l"))
    error = F.lit(0.0266) + 1 / F.col("n")
    return ranks.select("cluster_id", "n", (
        (F.col("r") >= 0.95 - error) & (F.col("l") <= 0.95 + error)).alias("within_rank_error"))


@query("a11_vessels_of_two_ranges", oracle(
    "SELECT port_id, count(*) FILTER (a) AS in_first, count(*) FILTER (b) AS in_second,"
    " count(*) FILTER (a AND b) AS in_both FROM (SELECT port_id, MMSI,"
    " bool_or(date < '2024-01-15') AS a, bool_or(date >= '2024-01-15') AS b FROM inport"
    " GROUP BY 1, 2) GROUP BY 1", "inport"))
def vessels_of_two_ranges(spark, sf_dir):
    """Vessels of each port before and from a day on, and those of both, from daily sketches."""
    days = _stored(sketches.member_sketches(
        _inside(spark, sf_dir), ("date", "port_id"), "MMSI"), spark, "members")
    middle = F.to_date(F.lit("2024-01-15"))
    return sketches.members_of_both(days, ["port_id"], F.col("date") < middle,
                                    F.col("date") >= middle)


_SLOT = f"CAST(floor({seconds('BaseDateTime')} / 900) AS BIGINT)"
_CONGESTION = oracle(
    "SELECT port_id, CAST(make_timestamp(w * 900000000) AS VARCHAR) AS window_start,"
    " active_vessels_count, avg_speed_knots, CASE WHEN active_vessels_count >= 3 THEN 'HIGH'"
    " WHEN active_vessels_count >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS congestion_risk FROM ("
    f"SELECT port_id, {_SLOT} - k AS w, count(DISTINCT MMSI) AS active_vessels_count,"
    f" {mean('SOG', 2)} AS avg_speed_knots FROM inport, (VALUES (0), (1), (2), (3)) AS s(k)"
    " GROUP BY 1, 2)", "inport")
_LEVELS = ((3, "HIGH"), (2, "MEDIUM"))


@query("g3_port_congestion", _CONGESTION)
def congestion(spark, sf_dir):
    """Sliding windows by merged sketches; so few vessels are counted without error."""
    slots = _stored(port_slots(_inside(spark, sf_dir)), spark, "slots")
    return port_congestion(slots, levels=_LEVELS)


@query("g3_port_congestion_exact", _CONGESTION)
def congestion_exact(spark, sf_dir):
    return port_congestion(port_slots(_inside(spark, sf_dir), exact=True), levels=_LEVELS,
                           exact=True)


_END = f"{seconds('exit_ts')} + 7200"


@query("a4_port_visits_streamed", oracle(
    "SELECT MMSI, port_id, CAST(entry_ts AS VARCHAR) AS entry_ts, CAST(exit_ts AS VARCHAR)"
    f" AS exit_ts, ping_count, dwell_minutes FROM all_visits WHERE {_END} <= (SELECT"
    f" max({seconds('BaseDateTime')}) - 600 FROM inport)", "all_visits"))
def streamed_visits(spark, sf_dir):
    """Visits of three micro-batches in order of time, as far as the watermark has passed them."""
    own, base = own_session(spark), shared_dir(spark, "visits")
    positions = _positions(own, sf_dir).select("MMSI", "BaseDateTime", "LAT", "LON")
    cuts = positions.select(F.unix_timestamp("BaseDateTime").alias("s")).approxQuantile(
        "s", [1 / 3, 2 / 3], 0.01)
    place = sum(((F.unix_timestamp("BaseDateTime") >= cut).cast("int") for cut in cuts), F.lit(0))
    for number in range(len(cuts) + 1):
        positions.filter(place == number).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = own.readStream.schema(positions.schema).option("maxFilesPerTrigger", 1).parquet(
        f"{base}/in")
    drain(own, stream_port_visits(ports_in_range(stream, views.ports(own)),
                                  watermark="600 seconds"), "append", base)
    return spark.read.parquet(f"{base}/table").drop("batch_id")
