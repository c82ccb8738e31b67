"""Result tables as Parquet: upsert by key, replace one day, and state as appended changes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wakeline.functions.geo import point_wkt
from wakeline.operators import latest
from wakeline.schema import TABLE_KEYS
from wakeline.session import materialize
from wakeline.sources import files
from wakeline.sources.archive import read_archive, replace_files, stored_days


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A result table, or an empty one of the given schema before its first write."""
    if schema is not None and not files.has_files(spark, path, ".parquet"):
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _write_days(df: DataFrame, path: str, date_col: str) -> None:
    (df.hint("rebalance", F.col(date_col)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path))


def _on_days(df: DataFrame, date_col: str, days: Sequence[str]) -> DataFrame:
    """The rows, which fail the job that writes them if one belongs to another day."""
    wanted = F.col(date_col).isin(*(F.to_date(F.lit(day)) for day in days))
    stray = F.raise_error(F.concat(
        F.lit(f"row outside of {', '.join(days)}: "),
        F.coalesce(F.col(date_col).cast("string"), F.lit("no day"))))
    return df.withColumn(date_col, F.when(wanted, F.col(date_col)).otherwise(
        stray.cast(df.schema[date_col].dataType)))


def upsert_table(updates: DataFrame, path: str, keys: Sequence[str],
                 update_cols: Sequence[str] | None = None, date_col: str = "kpi_date",
                 days: Sequence[str] | None = None) -> None:
    """Upsert into a table kept in one folder per day.

    Only the days of the updates are read and rewritten. A caller that knows them names them, and
    a row of any other day makes the write fail; otherwise the updates are written down first and
    their days read from there. The staged write replaces a day's folder when the job has
    succeeded.
    """
    spark = updates.sparkSession
    if days is not None:
        updates = _on_days(updates, date_col, days)
        wanted = [date.fromisoformat(day) for day in days]
    else:
        updates = materialize(updates, "updates")
        wanted = [row[0] for row in updates.select(date_col).distinct().collect()]
    existing = read_archive(spark, path, wanted, date_col)
    if existing is None:
        existing = spark.createDataFrame([], updates.schema)
    _write_days(latest.upsert(existing.select(*updates.columns), updates, keys, update_cols),
                path, date_col)


def upsert_result(updates: DataFrame, base: str, table: str,
                  days: Sequence[str] | None = None) -> None:
    """Upsert a result table by its business key; all other columns are overwritten."""
    upsert_table(updates, f"{base.rstrip('/')}/{table}", TABLE_KEYS[table], days=days)


def replace_table_day(rows: DataFrame, path: str, day: str, date_col: str = "kpi_date") -> None:
    """Exchange all rows of one day; without new rows the day's folder is removed.

    File names differ from job to job, so an unchanged folder means that there was no row.
    """
    spark = rows.sparkSession
    folder = f"{path.rstrip('/')}/{date_col}={day}"
    before = files.children(spark, folder)
    _write_days(rows.filter(F.col(date_col) == F.to_date(F.lit(day))), path, date_col)
    if before and files.children(spark, folder) == before:
        files.remove(spark, folder)


def fill_geometry(df: DataFrame, day: str | None = None, date_col: str = "kpi_date") -> DataFrame:
    """Set geom_wkt from lon and lat where it is missing, for one day or for all."""
    missing = F.col("geom_wkt").isNull()
    if day is not None:
        missing = missing & (F.col(date_col) == F.to_date(F.lit(day)))
    return df.withColumn(
        "geom_wkt",
        F.when(missing, point_wkt(F.col("lon"), F.col("lat"))).otherwise(F.col("geom_wkt")),
    )


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    """The days of the finished snapshots of a change table, ascending."""
    base = f"{path.rstrip('/')}/_snapshot"
    days = [name.removeprefix("as_of=") for name in files.children(spark, base)]
    return [day for day in days if files.exists(spark, f"{base}/as_of={day}/_SUCCESS")]


def _state_rows(spark: SparkSession, path: str, schema: StructType, date_col: str,
                upto: str | None = None) -> DataFrame:
    """The newest snapshot and the changes of the days after it, up to `upto`."""
    snapshots = [day for day in _snapshots(spark, path) if upto is None or day <= upto]
    if not snapshots and upto is None:
        return read_table(spark, path, schema).select(*schema.fieldNames())
    as_of = snapshots[-1] if snapshots else ""
    days = [date.fromisoformat(day) for day in sorted(stored_days(spark, path, date_col))
            if as_of < day and (upto is None or day <= upto)]
    changes = read_archive(spark, path, days, date_col) if days else None
    parts = [spark.read.schema(schema).parquet(f"{path.rstrip('/')}/_snapshot/as_of={as_of}")
             ] if as_of else []
    if changes is not None:
        parts.append(changes.select(*schema.fieldNames()))
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def latest_state(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str],
                 newer_by: str, date_col: str = "written_on") -> DataFrame:
    """The newest row per key of a table to which only changes were appended.

    Reads the newest snapshot and the folders of the days after it, not the changes ever made.
    """
    rows = _state_rows(spark, path, schema, date_col)
    return latest.latest_by_key(rows, keys, newer_by)


def snapshot_state(spark: SparkSession, path: str, upto: str, schema: StructType,
                   keys: Sequence[str], newer_by: str, date_col: str = "written_on") -> None:
    """Store the state after all changes written up to a day, from the snapshot before it.

    Changes lie in the folder of the day they were written on, so a day that is over by more than
    a day gets no further ones, however late the positions are; a later day is refused.
    """
    last = spark.range(1).select(F.date_sub(F.current_date(), 2).alias("d")).first()["d"]
    if date.fromisoformat(upto) > last:
        raise ValueError(f"changes may still be written on {upto}; {last} is the last closed day")
    if upto in _snapshots(spark, path):
        return
    rows = latest.latest_by_key(_state_rows(spark, path, schema, date_col, upto), keys, newer_by)
    base = f"{path.rstrip('/')}/_snapshot"
    rows.write.mode("overwrite").parquet(f"{base}/as_of={upto}")
    # The one before stays for readers that have just opened it.
    for day in _snapshots(spark, path)[:-2]:
        files.remove(spark, f"{base}/as_of={day}")


def compact_changes(spark: SparkSession, path: str, day: str, schema: StructType,
                    keys: Sequence[str], newer_by: str, date_col: str) -> None:
    """Keep the newest change per key of a day; the state read stays the same."""
    old = files.children(spark, f"{path.rstrip('/')}/{date_col}={day}")
    rows = read_archive(spark, path, [date.fromisoformat(day)], date_col)
    if rows is None:
        return
    newest = latest.latest_by_key(
        rows.select(*schema.fieldNames(), date_col), [*keys, date_col], newer_by)
    replace_files(materialize(newest, "compact"), path, day, old, date_col)
