"""JDBC tables: sub-query reads, appends, and statements for upsert and day replacement.

Statements run through the driver class that the JDBC URL names, so that a database needs no
Python client. Bulk rows always travel from the executors through Spark's own JDBC writer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    properties: Mapping[str, str]


# Point columns are taken apart inside the database; longitude is X.
PORT_QUERY = (
    "SELECT port_id, port_name, ST_X(geom) AS port_lon, ST_Y(geom) AS port_lat, radius_nm "
    "FROM port_reference"
)


def read_query(spark: SparkSession, target: JdbcTarget, query: str,
               partitioning: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of a query that runs in the database.

    `partitioning` takes Spark's partitionColumn, lowerBound, upperBound and numPartitions for
    results that are more than one task should read.
    """
    reader = spark.read.format("jdbc").option("url", target.url).option(
        "dbtable", f"({query}) wakeline_query"
    ).options(**target.properties)
    return reader.options(**(partitioning or {})).load()


def append_rows(df: DataFrame, target: JdbcTarget, table: str, max_connections: int = 8,
                sort_by: Sequence[str] = ()) -> None:
    """Append rows over at most max_connections connections.

    Only the result rows are moved to that many tasks; what computes them keeps its parallelism.
    Sorting inside each write task gives every transaction the same lock order.
    """
    limited = df.repartition(max_connections)
    if sort_by:
        limited = limited.sortWithinPartitions(*sort_by)
    limited.write.format("jdbc").option("url", target.url).option("dbtable", table).options(
        **target.properties
    ).mode("append").save()


def staging_name(table: str, run: str = "") -> str:
    """Staging table of one target and run (a day or a batch), so that two runs do not meet."""
    return f"stg_{table}_{run.replace('-', '')}" if run else f"stg_{table}"


def create_staging_sql(staging: str, target: str, columns: Sequence[str]) -> str:
    return (
        f"CREATE TABLE IF NOT EXISTS {staging} AS "
        f"SELECT {', '.join(columns)} FROM {target} WHERE 1 = 0"
    )


def upsert_sql(target: str, staging: str, columns: Sequence[str], keys: Sequence[str],
               update_cols: Sequence[str], newer_by: str | None = None) -> str:
    """Move staged rows into the target; matching keys are overwritten (when not older).

    A write task repeated after its commit leaves copies in the staging table; they count once.
    """
    listed = ", ".join(columns)
    changes = ", ".join(f"{c} = EXCLUDED.{c}" for c in update_cols)
    guard = f" WHERE {target}.{newer_by} <= EXCLUDED.{newer_by}" if newer_by else ""
    return (
        f"INSERT INTO {target} ({listed}) SELECT DISTINCT {listed} FROM {staging} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {changes}{guard}"
    )


def delete_day_sql(table: str, date_col: str, is_timestamp: bool = False) -> str:
    """Delete statement with one parameter, the day."""
    column = f"DATE({date_col})" if is_timestamp else date_col
    return f"DELETE FROM {table} WHERE {column} = ?"


def execute(spark: SparkSession, target: JdbcTarget,
            statements: Sequence[tuple[str, Sequence[str]]]) -> None:
    """Run statements in one transaction; dates are passed as java.sql.Date."""
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for key, value in target.properties.items():
        settings.setProperty(key, value)
    if "driver" in target.properties:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(
            target.properties["driver"]
        )
    connection = jvm.java.sql.DriverManager.getConnection(target.url, settings)
    try:
        connection.setAutoCommit(False)
        for text, days in statements:
            statement = connection.prepareStatement(text)
            for position, day in enumerate(days, start=1):
                statement.setDate(position, jvm.java.sql.Date.valueOf(day))
            statement.executeUpdate()
            statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _via_staging(df: DataFrame, target: JdbcTarget, table: str, run: str, keys: Sequence[str],
                 move: Sequence[tuple[str, Sequence[str]]]) -> None:
    """Fill a staging table, run the moving statements in one transaction, drop the table."""
    spark = df.sparkSession
    staging = staging_name(table, run)
    execute(spark, target, [
        (create_staging_sql(staging, table, df.columns), ()),
        (f"TRUNCATE TABLE {staging}", ()),
    ])
    try:
        append_rows(df, target, staging, sort_by=keys)
        execute(spark, target, move)
    finally:
        execute(spark, target, [(f"DROP TABLE IF EXISTS {staging}", ())])


def upsert_via_staging(df: DataFrame, target: JdbcTarget, table: str, keys: Sequence[str],
                       update_cols: Sequence[str], run: str = "",
                       newer_by: str | None = None) -> None:
    """Insert new keys and overwrite known ones; readers see all of it or nothing."""
    statement = upsert_sql(
        table, staging_name(table, run), df.columns, keys, update_cols, newer_by
    )
    _via_staging(df, target, table, run, keys, [(statement, ())])


def replace_day(df: DataFrame, target: JdbcTarget, table: str, date_col: str, day: str,
                is_timestamp: bool = False) -> None:
    """Exchange one day's rows; deletion and insertion are one transaction."""
    listed = ", ".join(df.columns)
    _via_staging(df, target, table, day, (), [
        (delete_day_sql(table, date_col, is_timestamp), (day,)),
        (f"INSERT INTO {table} ({listed}) SELECT DISTINCT {listed}"
         f" FROM {staging_name(table, day)}", ()),
    ])
