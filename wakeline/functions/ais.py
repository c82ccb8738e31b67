"""AIS field rules as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.schema import (
    CATEGORY_FIELDS,
    COG_UNAVAILABLE,
    HEADING_UNAVAILABLE,
    IMO_UNAVAILABLE,
    KNOT_IN_KMH,
    SOG_UNAVAILABLE,
    UNKNOWN,
    VESSEL_TYPES,
)

def is_mmsi(column: Column) -> Column:
    return column.rlike("^[0-9]{9}$")


def known_heading(column: Column) -> Column:
    return F.when(column != HEADING_UNAVAILABLE, column)


def known_sog(column: Column) -> Column:
    return F.when(column < SOG_UNAVAILABLE, column)


def known_cog(column: Column) -> Column:
    return F.when(column < COG_UNAVAILABLE, column)


def known_imo(column: Column) -> Column:
    """NULL for the placeholder number, in any letter case."""
    return F.when(F.upper(F.trim(column)) != IMO_UNAVAILABLE, column)


def category_defaults() -> dict[str, Column]:
    """UNKNOWN for missing category texts and for the placeholder IMO number."""
    filled = {}
    for name in CATEGORY_FIELDS:
        value = F.col(name)
        known = F.trim(value) != ""
        if name == "IMO":
            known = known & (value != IMO_UNAVAILABLE)
        filled[name] = F.when(known, value).otherwise(F.lit(UNKNOWN))
    return filled


def time_parts(ts: Column, sog: Column, round_speed: bool = False) -> dict[str, Column]:
    """Speed in km/h and the calendar parts kept with every archived position."""
    kmh = sog * KNOT_IN_KMH
    return {
        "speed_kmh": F.round(kmh, 2) if round_speed else kmh,
        "date": F.to_date(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "quarter": F.quarter(ts),
    }


def valid_speed(sog: Column) -> Column:
    return (sog >= 0.0) & (sog < SOG_UNAVAILABLE)


def optional_ranges(sog: Column, cog: Column, heading: Column) -> Column:
    """Out-of-range optional readings disqualify a row; missing readings do not."""
    return (
        (sog.isNull() | (sog >= 0.0))
        & (cog.isNull() | ((cog >= 0.0) & (cog < 360.0)))
        & (heading.isNull() | ((heading >= 0.0) & (heading < 360.0)))
    )


def vessel_type_label(code: Column) -> Column:
    """'name (code)' for listed codes, 'Type code' for others, 'Unknown' for NULL."""
    names = F.create_map(
        *chain.from_iterable(
            (F.lit(number), F.lit(f"{name} ({number})")) for number, name in VESSEL_TYPES.items()
        )
    )
    other = F.concat(F.lit("Type "), code.cast("string"))
    return F.when(code.isNull(), F.lit("Unknown")).otherwise(
        F.coalesce(F.try_element_at(names, code), other)
    )


def course_encoding(cog: Column) -> dict[str, Column]:
    """Course as a point on the unit circle, so that 359 and 1 degrees are close."""
    return {"cog_sin": F.sin(F.radians(cog)), "cog_cos": F.cos(F.radians(cog))}
