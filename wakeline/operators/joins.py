"""Equi-joins against a dimension that stay balanced when one key dominates the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 20_000
BROADCAST_BYTES = 32_000_000
MIN_SALTS = 16


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                   max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a dimension has at most max_rows rows and max_bytes bytes as text.

    Reads no more than max_rows rows plus one.
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    found = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return found["n"] <= max_rows and found["b"] <= max_bytes


def salts_for(spark: SparkSession) -> int:
    """Salts that spread one key over half of the shuffle's tasks."""
    return max(MIN_SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)


def salted_join(facts: DataFrame, dim: DataFrame, on: Sequence[str], spread_by: Sequence[str],
                how: str = "left", salts: int | None = None) -> DataFrame:
    """Join where the facts of one key spread over `salts` tasks.

    The salt is a hash of fact columns, so a retried task sends each row to the same place.
    Adaptive execution still turns this into a broadcast join when the dimension turns out small.
    """
    salts = salts or salts_for(facts.sparkSession)
    salted_facts = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    every_salt = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    salted_dim = dim.withColumn("_salt", every_salt)
    return salted_facts.join(salted_dim, [*on, "_salt"], how).drop("_salt")


def dimension_join(facts: DataFrame, dim: DataFrame, on: Sequence[str], spread_by: Sequence[str],
                   how: str = "left", max_rows: int = BROADCAST_ROWS,
                   salts: int | None = None) -> DataFrame:
    """Broadcast a dimension whose size was checked; otherwise join with salted keys."""
    if fits_broadcast(dim, max_rows):
        return facts.join(F.broadcast(dim), list(on), how)
    return salted_join(facts, dim, on, spread_by, how, salts)
