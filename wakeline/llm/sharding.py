"""Rendezvous hashing of record keys over weighted shards, in DataFrame functions only.

Each (key, shard) pair gets a pseudo-random score that depends on nothing else; the shard with the
highest score takes the record. Removing or adding a shard leaves the other scores as they are, so
records move only out of the removed shard or into the new one. A shard of weight w wins
w / sum(weights) of the keys (score -w / ln(u) for u uniform in (0, 1)).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows numbered by one task at a time; the number of buckets grows with the table.
BUCKET_ROWS = 20_000


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard number 0..len(weights)-1 of a key; a null key is a key like any other.

    Equal scores (same hash) go to the higher shard number.
    """
    if not weights or any(not weight > 0 for weight in weights):
        raise ValueError("every shard needs a weight above zero")
    key = F.coalesce(key.cast("string"), F.lit("\u0000null"))
    scores = []
    for shard, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
        uniform = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        scores.append(F.struct((F.lit(-float(weight)) / F.log(uniform)).alias("score"),
                               F.lit(shard).alias("shard")))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return best.getField("shard")


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus one for the record's end."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null counts as no bytes."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def with_slots(rows: DataFrame, shard: str, order: Sequence[str],
               bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, as column `slot`.

    A shard is cut into buckets by a hash of the ordering columns, so that no task sorts a whole
    shard. A bucket's first number is the sum of the counts before it. Rows equal in every
    ordering column share a bucket; which of them comes first makes no difference to the result.
    """
    buckets = max(1, -(-rows.count() // bucket_rows))
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = placed.groupBy(shard, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(shard).alias("_shard"), F.col("_bucket").alias("_number"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(shard, "_bucket").orderBy(*order)
    numbered = placed.withColumn("_rank", F.row_number().over(within) - 1)
    joined = numbered.join(
        starts, (F.col(shard) == F.col("_shard")) & (F.col("_bucket") == F.col("_number")))
    return joined.withColumn("slot", (F.col("_start") + F.col("_rank")).cast("bigint")).drop(
        "_bucket", "_shard", "_number", "_start", "_rank")


def shard_documents(docs: DataFrame, weights: Sequence[float],
                    grown: Sequence[float] | None = None, key: str = "doc_id",
                    text: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Assign every row to a shard by its key alone (law `key`).

    Returns (key, size, text_crc32, law, shard, slot, grown_shard). `grown` holds the weights after
    adding shards; rows move only into the added ones. Null keys form one key, null texts have size
    1 and CRC 0, repeated rows each get a slot, extra columns are ignored, an empty table gives an
    empty result.
    """
    grown = list(grown) if grown is not None else [*weights, 1.0]
    rows = docs.select(
        F.col(key),
        text_size(F.col(text)).alias("size"),
        text_crc32(F.col(text)).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), weights).alias("shard"),
        shard_of(F.col(key), grown).alias("grown_shard"),
    )
    return with_slots(rows, "shard", [key, "size", "text_crc32"], bucket_rows).select(
        key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
