"""Small general-purpose reports: filtered counts, words, best of a group, month tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def filtered_counts(df: DataFrame, condition: Column, group: str) -> DataFrame:
    """Rows per group among those that meet a condition, in group order."""
    return (
        df.filter(condition).groupBy(group).agg(F.count("*").alias("v")).orderBy(group)
    )


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of each whitespace-separated word over all texts."""
    words = df.select(F.explode(F.split(F.col(text), r"\s")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("occurrences"))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def most_frequent(df: DataFrame, group: str, weight: str | None = None) -> DataFrame:
    """The group (or groups, when equal) with the most rows, or the greatest sum of `weight`.

    The greatest count is one row, which is joined back to the counts of the groups.
    """
    rows = F.count("*") if weight is None else F.sum(weight)
    counts = df.groupBy(group).agg(rows.alias("row_count"))
    greatest = counts.agg(F.max("row_count").alias("row_count"))
    return counts.join(greatest, "row_count").select(group, "row_count")


def years_of(df: DataFrame, ts: str) -> list[int]:
    """The years that occur in a date column, ascending: a handful of numbers."""
    found = df.select(F.year(ts).alias("year")).where("year is not null").distinct()
    return sorted(row["year"] for row in found.collect())


def month_table(df: DataFrame, ts: str, years: Sequence[int] | None = None) -> DataFrame:
    """Rows per month, one column per year; the years of the table where none are named.

    Combined before the shuffle. Rows without a date are left out.
    """
    years = years_of(df, ts) if years is None else years
    return df.where(F.col(ts).isNotNull()).groupBy(F.month(ts).alias("month")).agg(
        F.count("*").alias("n_all"),
        *(F.count_if(F.year(ts) == year).alias(f"n_{year}") for year in years))


def month_counts(df: DataFrame, ts: str) -> DataFrame:
    """Rows of each year and month that occurs, whatever the years; rows without a date are left
    out."""
    return df.where(F.col(ts).isNotNull()).groupBy(
        F.year(ts).alias("year"), F.month(ts).alias("month")).agg(F.count("*").alias("n"))


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    """Delimited text with a header line and every value quoted."""
    df.write.options(header=True, sep=sep, quoteAll=True).csv(path)


def read_delimited(spark: SparkSession, path: str, schema: StructType,
                   sep: str = ";") -> DataFrame:
    return spark.read.schema(schema).options(header=True, sep=sep).csv(path)


def per_day(table: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """A month table divided by the days of each month, whole rows per day."""
    if years is None:
        years = [int(c[2:]) for c in table.columns if c.startswith("n_") and c[2:].isdigit()]

    def days(year: int) -> Column:
        first = F.make_date(F.lit(year), F.col("month"), F.lit(1))
        return F.dayofmonth(F.last_day(first))

    return table.select("month", *(
        F.floor(F.col(f"n_{y}") / days(y)).cast("bigint").alias(f"per_day_{y}") for y in years
    ))
