"""Checks of the general reports on the order tables and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeline_checks import views
from wakeline_checks.registry import query
from wakeline.plans import basics
from wakeline.session import shared_dir


@query("t1_delimited_text",
       "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def delimited_text(spark, sf_dir):
    """Semicolon-separated text with quotes and a header, written and read as typed columns."""
    columns = ["p_partkey", "p_name", "p_brand", "p_size"]
    parts = views.table(spark, sf_dir, "part").select(*columns)
    folder = shared_dir(spark, "delimited")
    basics.write_delimited(parts, folder)
    return basics.read_delimited(spark, folder, parts.schema)


@query("t2_filtered_counts",
       "SELECT p_size, count(*) AS v FROM part WHERE p_retailprice < 1000.0 GROUP BY p_size")
def filtered_counts(spark, sf_dir):
    parts = views.table(spark, sf_dir, "part")
    return basics.filtered_counts(parts, F.col("p_retailprice") < 1000.0, "p_size")


@query("t3_word_count",
       "SELECT word, count(*) AS occurrences FROM (SELECT unnest(regexp_split_to_array(text,"
       " '\\s')) AS word FROM documents) AS w GROUP BY word")
def word_count(spark, sf_dir):
    return basics.word_counts(views.table(spark, sf_dir, "documents"), "text")


@query("t6_busiest_nation",
       "WITH c AS (SELECT s_nationkey, count(*) AS row_count FROM lineitem JOIN supplier"
       " ON l_suppkey = s_suppkey GROUP BY s_nationkey)"
       " SELECT n_name, row_count FROM c JOIN nation ON s_nationkey = n_nationkey"
       " WHERE row_count = (SELECT max(row_count) FROM c)")
def busiest_nation(spark, sf_dir):
    """Shipments are counted by supplier first, so only counts meet the other tables."""
    lines = views.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"))
    suppliers = views.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    counts = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    best = basics.most_frequent(counts, "s_nationkey", "n")
    nations = views.table(spark, sf_dir, "nation")
    return best.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "n_name", "row_count"
    )


# DuckDB takes the years from the table as well: one column for each year that occurs.
_DATED = (
    "SELECT CAST(month(l_shipdate) AS INTEGER) AS month, year(l_shipdate) AS y, count(*) AS n,"
    " CAST(floor(count(*) / day(last_day(any_value(l_shipdate)))) AS BIGINT) AS per_day"
    " FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2"
)


def _side_by_side(prefix: str, value: str) -> str:
    return (f"FROM (PIVOT (SELECT month, '{prefix}' || y AS name, {value} AS v FROM ({_DATED}))"
            " ON name USING coalesce(CAST(sum(v) AS BIGINT), 0) GROUP BY month)")


@query("t7_months_side_by_side",
       f"SELECT m.*, n_all {_side_by_side('n_', 'n')} AS m JOIN (SELECT month, CAST(sum(n) AS"
       f" BIGINT) AS n_all FROM ({_DATED}) GROUP BY month) AS a ON m.month = a.month")
def months(spark, sf_dir):
    """One column for each year of the table, and one for all; the counts add up to all rows."""
    return basics.month_table(views.table(spark, sf_dir, "lineitem"), "l_shipdate")


@query("t7_rows_per_day", f"SELECT * {_side_by_side('per_day_', 'per_day')}")
def rows_per_day(spark, sf_dir):
    return basics.per_day(months(spark, sf_dir))


@query("t7_months_of_all_years",
       "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER)"
       " AS month, count(*) AS n FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2")
def months_of_all_years(spark, sf_dir):
    """Every year of the table, one row per month."""
    return basics.month_counts(views.table(spark, sf_dir, "lineitem"), "l_shipdate")
