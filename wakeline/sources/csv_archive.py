"""CSV archives of raw positions."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wakeline.functions.text import strip_all
from wakeline.operators.quality import GateError
from wakeline.schema import RAW_FIELDS
from wakeline.sources import files

FILE = "source_file"
HEADER_READERS = 32


@dataclass(frozen=True)
class ArchiveListing:
    """Which of the expected files can be read; the others are skipped, with the reason."""

    readable: dict[tuple[str, ...], list[str]]
    missing: list[str]
    empty: list[str]
    without_mmsi: list[str]


def list_archive(spark: SparkSession, paths: Sequence[str]) -> ArchiveListing:
    """Group files by their header line, so that each layout is read by column name."""
    readable: dict[tuple[str, ...], list[str]] = defaultdict(list)
    missing, empty, without_mmsi = [], [], []

    def header_line(path: str) -> str | None:
        return (files.first_line(spark, path) or "") if files.exists(spark, path) else None

    # One small read per file, many at a time: the wait is for the store, not for this process.
    with ThreadPool(HEADER_READERS) as readers:
        lines = readers.map(inheritable_thread_target(spark)(header_line), paths)
    for path, line in zip(paths, lines):
        if line is None:
            missing.append(path)
            continue
        if not line:
            empty.append(path)
            continue
        header = tuple(next(csv.reader([line.lstrip("\ufeff")])))
        if "MMSI" in header:
            readable[header].append(path)
        else:
            without_mmsi.append(path)
    return ArchiveListing(dict(readable), missing, empty, without_mmsi)


def _read_layout(spark: SparkSession, header: Sequence[str], paths: Sequence[str],
                 multi_line: bool) -> DataFrame:
    schema = StructType([StructField(name, StringType(), True) for name in header])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(list(paths))
    )
    # Short rows are padded and blanks kept as empty text; longer rows lose the surplus.
    values = {name: F.coalesce(strip_all(F.col(name)), F.lit("")) for name in header}
    return rows.select(
        *(values[name].alias(name) if name in header else F.lit("").alias(name)
          for name in RAW_FIELDS),
        F.col("_metadata.file_path").alias(FILE),
    ).filter((F.col("MMSI") != "") & (F.col("MMSI") != "MMSI"))


def read_archive(spark: SparkSession, paths: Sequence[str],
                 multi_line: bool = False) -> DataFrame:
    """Raw text positions of all readable files, with the file each row came from.

    `multi_line` allows line breaks inside quotes, at the price of one task per file.
    """
    listing = list_archive(spark, paths)
    empty_schema = StructType(
        [StructField(name, StringType(), True) for name in (*RAW_FIELDS, FILE)]
    )
    rows = spark.createDataFrame([], empty_schema)
    for header, group in listing.readable.items():
        part = _read_layout(spark, header, group, multi_line)
        rows = rows.unionByName(part)
    return rows


def require_archive_rows(spark: SparkSession, paths: Sequence[str]) -> dict[str, int]:
    """Rows per file; raises, naming missing and empty files, when there is no row at all."""
    counted = read_archive(spark, paths).groupBy(FILE).agg(F.count("*").alias("row_count"))
    counts = {row[FILE]: row["row_count"] for row in counted.collect()}
    if not counts:
        listing = list_archive(spark, paths)
        no_rows = [path for group in listing.readable.values() for path in group]
        raise GateError(
            "no positions in any archive file; "
            f"missing: {listing.missing}; empty: {listing.empty}; "
            f"without MMSI column: {listing.without_mmsi}; without rows: {no_rows}"
        )
    return counts
