"""Stable vessel attributes recovered from a vessel's other rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.operators.joins import dimension_join
from wakeline.schema import VESSEL_ATTRIBUTES
from wakeline.session import materialize


def vessel_reference(positions: DataFrame, key: str = "MMSI", ts: str = "BaseDateTime",
                     columns: Sequence[str] = VESSEL_ATTRIBUTES) -> DataFrame:
    """Per vessel the earliest known value of each attribute (smallest value on equal times)."""
    return positions.groupBy(key).agg(*(
        F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(ts), F.col(c)))).getField(c).alias(c)
        for c in columns
    ))


def recover_attributes(positions: DataFrame, key: str = "MMSI", ts: str = "BaseDateTime",
                       columns: Sequence[str] = VESSEL_ATTRIBUTES,
                       max_broadcast_vessels: int = 100_000, salts: int | None = None) -> DataFrame:
    """Fill missing attributes of a position from its vessel's reference row.

    The reference is written first, so its size is known: a fleet of usual size is broadcast and
    the positions are not shuffled; a larger one is joined with the rows of a vessel salted.
    """
    reference = materialize(vessel_reference(positions, key, ts, columns).select(
        key, *(F.col(c).alias(f"_ref_{c}") for c in columns)
    ), "vessel-reference")
    joined = dimension_join(
        positions, reference, [key], [key, ts], "left", max_broadcast_vessels, salts
    )
    return joined.select(*(
        F.coalesce(F.col(c), F.col(f"_ref_{c}")).alias(c) if c in columns else F.col(c)
        for c in positions.columns
    ))
