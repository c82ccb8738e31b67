"""Gates that stop a job when its input or output is not there."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """A data gate was not passed."""


def day_counts(tables: Mapping[str, DataFrame], date_col: str = "kpi_date") -> DataFrame:
    """Rows per table and day, for all tables in one job."""
    counted = [
        df.groupBy(F.col(date_col).alias("kpi_date")).agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "kpi_date", "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def require_rows(tables: Mapping[str, DataFrame], day: str, required: Sequence[str],
                 date_col: str = "kpi_date") -> dict[str, int]:
    """Rows of one day per table; raises when a required table has none."""
    of_day = {
        name: df.filter(F.col(date_col) == F.to_date(F.lit(day))) for name, df in tables.items()
    }
    found = {row["table_name"]: row["row_count"] for row in day_counts(of_day, date_col).collect()}
    counts = {name: found.get(name, 0) for name in tables}
    empty = [name for name in required if counts[name] == 0]
    if empty:
        raise GateError(f"no rows for {day} in {', '.join(empty)}")
    return counts
