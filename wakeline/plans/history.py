"""Full-history cleaning of raw messages in one batch, with recovered vessel attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions import ais, geo, text
from wakeline.operators.attributes import recover_attributes
from wakeline.operators.clean import add_time_parts, null_sentinels
from wakeline.operators.dedup import drop_duplicates
from wakeline.schema import CATEGORY_FIELDS, DOUBLE_FIELDS, INT_FIELDS, RAW_FIELDS, UNKNOWN
from wakeline.session import materialize
from wakeline.sources.messages import parse_messages

DUPLICATE_KEY = ("MMSI", "BaseDateTime", "LAT", "LON")


def typed_history(parsed: DataFrame) -> DataFrame:
    """Headers dropped, blanks removed from identity texts, fields typed, sentinels removed.

    Unlike the stream, the identity number stays text and the placeholder IMO becomes NULL, so
    that another row of the vessel may supply it.
    """
    named = ("MMSI", *CATEGORY_FIELDS)
    typed = {}
    for name in RAW_FIELDS:
        value = F.col(name)
        if name in named:
            value = text.blank_to_null(value)
        elif name == "BaseDateTime":
            value = text.to_instant(value, None)
        elif name in DOUBLE_FIELDS:
            value = text.to_double(value)
        elif name in INT_FIELDS:
            value = text.to_int(value)
        typed[name] = value
    rows = parsed.filter(F.upper(F.trim("MMSI")) != "MMSI").select(
        *(value.alias(name) for name, value in typed.items())
    )
    return null_sentinels(rows).withColumn("IMO", ais.known_imo(F.col("IMO")))


def valid_history(typed: DataFrame) -> DataFrame:
    return typed.filter(
        ais.is_mmsi(F.col("MMSI"))
        & F.col("BaseDateTime").isNotNull()
        & geo.valid_position(F.col("LAT"), F.col("LON"))
        & ais.optional_ranges(F.col("SOG"), F.col("COG"), F.col("Heading"))
    )


def clean_history(messages: DataFrame) -> DataFrame:
    """Cleaned, de-duplicated and completed positions of all messages."""
    parsed = parse_messages(messages, with_metadata=False)
    # Written once: the vessel reference and the rows it completes read columns, not messages.
    unique = materialize(
        drop_duplicates(valid_history(typed_history(parsed)), DUPLICATE_KEY), "unique-history")
    complete = add_time_parts(recover_attributes(unique), round_speed=True)
    return complete.withColumns(
        {name: F.coalesce(F.col(name), F.lit(UNKNOWN)) for name in CATEGORY_FIELDS}
    )
