"""The date-partitioned Parquet archive of cleaned positions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.operators.dedup import drop_duplicates
from wakeline.operators.quality import GateError
from wakeline.schema import MAX_RECORDS_PER_FILE
from wakeline.session import materialize
from wakeline.sources import files

def write_by_date(df: DataFrame, path: str, date_col: str = "date", mode: str = "overwrite",
                  max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Write one folder per date.

    Rows are rebalanced by date: adaptive execution merges small dates and splits a date that
    holds most of the rows over several tasks. Only the dates present are overwritten.
    """
    (df.hint("rebalance", F.col(date_col)).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records)
     .partitionBy(date_col).parquet(path))


def append_by_date(df: DataFrame, path: str, date_col: str = "date",
                   max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Add rows to the folders of their dates.

    The files appear when the job commits, one after the other: a reader that lists the folders at
    that moment can see some of them. Jobs over a day run when the stream has left it.
    """
    write_by_date(df, path, date_col, "append", max_records)


def stored_days(spark: SparkSession, path: str, date_col: str = "date") -> set[str]:
    """The days, as folder names spell them, that have a folder."""
    head = f"{date_col}="
    return {name.removeprefix(head) for name in files.children(spark, path)
            if name.startswith(head)}


def append_new(df: DataFrame, path: str, keys: Sequence[str], date_col: str = "date",
               max_records: int = MAX_RECORDS_PER_FILE,
               compare: set[str] | None = None) -> None:
    """Append the rows whose key is not stored yet; stored rows are never replaced.

    Only the key columns of the dates at hand are read, of these only the days in `compare` where
    it is given. Dates are few; keys stay distributed.
    """
    spark = df.sparkSession
    if files.has_files(spark, path, ".parquet"):
        days = [row[0] for row in df.select(date_col).distinct().collect()]
        if compare is not None:
            days = [day for day in days if _folder_day(day) in compare]
        stored = read_archive(spark, path, days, date_col) if days else None
        if stored is not None:
            df = df.join(stored.select(*keys), list(keys), "left_anti").select(*df.columns)
    append_by_date(df, path, date_col, max_records)


def _folder_day(day: date | None) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if day is None else str(day)


def replace_files(staged: DataFrame, path: str, day: str, old: Sequence[str],
                  date_col: str = "date", max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Exchange the files of a day that were listed before `staged` was read from them.

    The new files are added before the old ones go, and only these go: what a stream adds to the day
    meanwhile stays. A failure in between leaves rows twice, which the next compaction mends; a
    reader in between sees them twice, so readers run before or after.
    """
    append_by_date(staged, path, date_col, max_records)
    folder = f"{path.rstrip('/')}/{date_col}={day}"
    for name in old:
        files.remove(staged.sparkSession, f"{folder}/{name}")


def compact_day(spark: SparkSession, path: str, day: str, keys: Sequence[str],
                prefer: Sequence[str] = (), date_col: str = "date",
                max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Rewrite a date as few files with one row per key.

    The rows are written to the shared folder first and stay there until the new files stand. Rows
    added to the date while this runs are neither lost nor compacted.
    """
    old = files.children(spark, f"{path.rstrip('/')}/{date_col}={day}")
    rows = read_archive(spark, path, [date.fromisoformat(day)], date_col)
    if rows is None:
        return
    staged = materialize(drop_duplicates(rows, keys, prefer), "compact")
    replace_files(staged, path, day, old, date_col, max_records)


def write_marker(spark: SparkSession, path: str, batch_id: int, run: str = "") -> None:
    """Audit row of a finished micro-batch, in one folder beside the data, not read back.

    `run` tells the batches of one start of the stream from those of another.
    """
    spark.createDataFrame([(run, int(batch_id))], "run string, batch_id bigint").coalesce(
        1).write.mode("append").json(f"{path.rstrip('/')}/_batch_markers")


def read_archive(spark: SparkSession, path: str, days: Sequence[date] | None = None,
                 date_col: str = "date") -> DataFrame | None:
    """All stored rows, or those of some dates, whose folders alone are listed.

    None if there is no folder of those dates.
    """
    base = path.rstrip("/")
    if days is None:
        return spark.read.parquet(base)
    names = sorted({_folder_day(day) for day in days})
    folders = [f"{base}/{date_col}={name}" for name in names]
    found = [folder for folder in folders if files.has_files(spark, folder, ".parquet")]
    return spark.read.option("basePath", base).parquet(*found) if found else None


def read_days(spark: SparkSession, path: str, first_day: str, last_day: str | None = None,
              date_col: str = "date") -> DataFrame:
    """Positions of a range of days; the filter reaches the folder listing."""
    last = last_day or first_day
    wanted = F.col(date_col).between(F.to_date(F.lit(first_day)), F.to_date(F.lit(last)))
    return read_archive(spark, path).filter(wanted)


def read_day_with_previous(spark: SparkSession, path: str, day: str,
                           date_col: str = "date") -> DataFrame:
    """A day and the day before it; a missing previous day is simply empty."""
    before = (date.fromisoformat(day) - timedelta(days=1)).isoformat()
    return read_days(spark, path, before, day, date_col)


def require_day(spark: SparkSession, path: str, day: str, date_col: str = "date") -> None:
    """Raise unless the folder of the day holds Parquet files."""
    folder = f"{path.rstrip('/')}/{date_col}={day}"
    if not files.has_files(spark, folder, ".parquet"):
        raise GateError(f"{folder} is missing or holds no Parquet file")
