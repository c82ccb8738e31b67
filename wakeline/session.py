"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from wakeline.sources import files

# Runtime settings every job relies on. Partition counts and memory stay with the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Start-time settings. Recording the Python call site of every column expression costs more than
# building the plans themselves.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# State lives off-heap and is uploaded as change logs, so it may outgrow executor memory.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession, streaming: bool = False) -> SparkSession:
    """Apply the runtime settings to a session that somebody else started."""
    for key, value in {**RUNTIME_CONF, **(STREAMING_CONF if streaming else {})}.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, streaming: bool = False) -> SparkSession:
    """Start (or reuse) a session; master, memory and parallelism come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in STATIC_CONF.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate(), streaming)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application, as --py-files would.

    Only what runs Python in tasks needs it: state processors and functions over Arrow tables.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted((root / "wakeline").rglob("*.py")):
            archive.write(path, path.relative_to(root))
    target = f"{shared_dir(spark, 'package')}/wakeline.zip"
    files.write_bytes(spark, target, packed.getvalue())
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


_INTERMEDIATES: list[str] = []


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for a written intermediate that every executor can reach.

    The cluster names the parent in spark.checkpoint.dir; where it is unset, a folder below the
    session's warehouse takes its place.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        parent = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    return f"{parent.rstrip('/')}/wakeline-{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back: computed once, plan cut.

    The files outlive any executor. remove_intermediates() deletes them when the job is done.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    _INTERMEDIATES.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_intermediates(spark: SparkSession) -> None:
    """Delete what materialize() has written; results that still read it must be stored by now."""
    while _INTERMEDIATES:
        files.remove(spark, _INTERMEDIATES.pop())
