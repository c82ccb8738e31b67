"""Cleaning as one narrow pass: each row gets an outcome, branches are filters on it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions import ais, geo, text
from wakeline.schema import (
    CORRUPT,
    DOUBLE_FIELDS,
    INT_FIELDS,
    MESSAGE_METADATA,
    RAW_FIELDS,
)

OUTCOME = "outcome"
TYPED = "typed_"
CLEAN = "clean"
DEAD_LETTER = "dead_letter"
HEADER = "header"
#: Typed fields that the rules look at.
JUDGED = ("BaseDateTime", "LAT", "LON")
REJECTS = (
    "mmsi_missing", "mmsi_invalid", "timestamp_invalid", "position_missing",
    "position_out_of_range",
)


@dataclass(frozen=True)
class CleanResult:
    """The branches of one cleaning pass; all of them are lazy filters on `tagged`."""

    tagged: DataFrame
    clean: DataFrame
    rejects: DataFrame
    dead_letters: DataFrame


def typed_fields() -> dict[str, Column]:
    """Trimmed and typed value of every raw text field."""
    typed = {"MMSI": F.trim(F.col("MMSI")).try_cast("bigint")}
    for name in RAW_FIELDS[1:]:
        value = text.blank_to_null(F.col(name))
        if name == "BaseDateTime":
            value = text.to_instant(value)
        elif name in DOUBLE_FIELDS:
            value = text.to_double(value)
        elif name in INT_FIELDS:
            value = text.to_int(value)
        typed[name] = value
    return typed


def _typed(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add typed fields (prefix typed_) as generated columns.

    Filters on the outcome then compare finished values instead of repeating the casts, and the
    optimizer does not multiply them out.
    """
    values = typed_fields()
    typed = F.struct(*(values[name].alias(f"{TYPED}{name}") for name in names))
    return df.select("*", F.inline(F.array(typed)))


def _outcome(columns: Sequence[str]) -> Column:
    """The outcome of rows that have the typed fields in JUDGED."""
    mmsi = F.trim(F.col("MMSI"))
    lat, lon = F.col(f"{TYPED}LAT"), F.col(f"{TYPED}LON")
    has_corrupt = CORRUPT in columns
    outcome = F.when(F.col(CORRUPT).isNotNull() if has_corrupt else F.lit(False),
                     F.lit(DEAD_LETTER))
    return (
        outcome
        .when(F.col("MMSI") == "MMSI", F.lit(HEADER))
        .when(mmsi.isNull(), F.lit("mmsi_missing"))
        .when(~ais.is_mmsi(mmsi), F.lit("mmsi_invalid"))
        .when(F.col(f"{TYPED}BaseDateTime").isNull(), F.lit("timestamp_invalid"))
        .when(geo.valid_position(lat, lon), F.lit(CLEAN))
        .when(lat.between(-90.0, 90.0) | lat.isNull(),
              F.when(lon.between(-180.0, 180.0) | lon.isNull(), F.lit("position_missing"))
              .otherwise(F.lit("position_out_of_range")))
        .otherwise(F.lit("position_out_of_range"))
    )


def tag_positions(parsed: DataFrame) -> DataFrame:
    """Add the typed fields (prefix typed_) and the row's `outcome`; no row is lost."""
    return _typed(parsed, RAW_FIELDS).withColumn(OUTCOME, _outcome(parsed.columns))


def _metadata(df: DataFrame) -> list[str]:
    return [name for name in MESSAGE_METADATA if name in df.columns]


def dead_letters(tagged: DataFrame) -> DataFrame:
    """Messages that were not JSON objects, with their original text."""
    return tagged.filter(F.col(OUTCOME) == DEAD_LETTER).select(
        *_metadata(tagged), *RAW_FIELDS, CORRUPT
    )


def rejects(tagged: DataFrame) -> DataFrame:
    """Rows that failed a rule, every column as text, with the reason.

    Identity failures keep the text as it came; later failures show the values as read.
    """
    by_identity = F.col(OUTCOME).startswith("mmsi")
    shown = [
        F.when(by_identity, F.trim(F.col(name)) if name == "MMSI" else F.col(name))
        .otherwise(F.col(f"{TYPED}{name}").cast("string")).alias(name)
        for name in RAW_FIELDS
    ]
    return tagged.filter(F.col(OUTCOME).isin(*REJECTS)).select(
        *(F.col(name).cast("string").alias(name) for name in _metadata(tagged)),
        *shown,
        F.col(OUTCOME).alias("reject_reason"),
    )


def parsed_dead_letters(parsed: DataFrame) -> DataFrame:
    """The dead letters of parsed messages, without typing the fields of any row."""
    lost = parsed.filter(F.col(CORRUPT).isNotNull())
    return dead_letters(lost.withColumn(OUTCOME, F.lit(DEAD_LETTER)))


def parsed_rejects(parsed: DataFrame) -> DataFrame:
    """The rejects of parsed messages; what no rule looks at is typed for rejected rows alone."""
    judged = _typed(parsed, JUDGED).withColumn(OUTCOME, _outcome(parsed.columns))
    rejected = judged.filter(F.col(OUTCOME).isin(*REJECTS))
    return rejects(_typed(rejected, [name for name in RAW_FIELDS if name not in JUDGED]))


def null_sentinels(df: DataFrame) -> DataFrame:
    """AIS 'not available' readings become NULL."""
    return df.withColumns({
        "Heading": ais.known_heading(F.col("Heading")),
        "SOG": ais.known_sog(F.col("SOG")),
        "COG": ais.known_cog(F.col("COG")),
    })


def fill_categories(df: DataFrame) -> DataFrame:
    return df.withColumns(ais.category_defaults())


def add_time_parts(df: DataFrame, round_speed: bool = False) -> DataFrame:
    return df.withColumns(ais.time_parts(F.col("BaseDateTime"), F.col("SOG"), round_speed))


def accepted(tagged: DataFrame) -> DataFrame:
    """Rows that passed every rule: typed, sentinels removed, categories filled."""
    kept = tagged.filter(F.col(OUTCOME) == CLEAN).select(
        *_metadata(tagged), *(F.col(f"{TYPED}{n}").alias(n) for n in RAW_FIELDS)
    )
    return fill_categories(null_sentinels(kept))


def clean_positions(parsed: DataFrame,
                    stage: Callable[[DataFrame], DataFrame] | None = None) -> CleanResult:
    """All branches of the cleaning rules for parsed text rows (batch or stream).

    `clean` is not yet de-duplicated and has no calendar parts: batch and stream differ there. A
    batch that uses several branches may have the tagged rows written down first, by `stage`.
    """
    tagged = tag_positions(parsed)
    if CORRUPT not in tagged.columns:
        tagged = tagged.withColumn(CORRUPT, F.lit(None).cast("string"))
    if stage is not None:
        tagged = stage(tagged)
    return CleanResult(tagged, accepted(tagged), rejects(tagged), dead_letters(tagged))


def outcome_counts(tagged: DataFrame) -> DataFrame:
    """Row accounting: one count per outcome; the counts add up to the input."""
    return tagged.groupBy(OUTCOME).agg(F.count("*").alias("row_count"))


def outcome_metrics() -> list[Column]:
    """The same counts as metrics to observe while the tagged rows are written, by outcome."""
    return [F.count_if(F.col(OUTCOME) == name).alias(name)
            for name in (CLEAN, HEADER, DEAD_LETTER, *REJECTS)]


def union_as_text(*branches: DataFrame) -> DataFrame:
    """Union differently typed branches by name, every column as text, gaps as NULL."""
    as_text = [df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))
               for df in branches]
    result = as_text[0]
    for df in as_text[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result
