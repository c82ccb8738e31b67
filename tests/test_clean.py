from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import messages, record, rows
from wakeline.operators import clean
from wakeline.operators.attributes import recover_attributes, vessel_reference
from wakeline.operators.dedup import drop_duplicates
from wakeline.plans.history import clean_history
from wakeline.schema import CLEAN_SCHEMA, REJECT_SCHEMA, RAW_FIELDS
from wakeline.sources.messages import parse_messages, to_messages, topic_options
from wakeline.streaming.positions import clean_batch, clean_stream


def outcomes(spark, values):
    tagged = clean.tag_positions(parse_messages(messages(spark, values)))
    return [r["outcome"] for r in tagged.orderBy("kafka_offset").collect()]


@pytest.mark.parametrize("value, expected", [
    ('{"MMSI":', "dead_letter"),
    ("[]", "dead_letter"),
    ('"str"', "dead_letter"),
    (None, "mmsi_missing"),
    ("", "mmsi_missing"),
    ('{"X":1}', "mmsi_missing"),
    (record(MMSI="MMSI"), "header"),
    (record(MMSI="12345678"), "mmsi_invalid"),
    (record(MMSI="1234567890"), "mmsi_invalid"),
    (record(MMSI="12345678a"), "mmsi_invalid"),
    (record(MMSI="  "), "mmsi_invalid"),
    (record(MMSI=" 366000001 "), "clean"),
    (record(BaseDateTime="zz"), "timestamp_invalid"),
    (record(BaseDateTime=None), "timestamp_invalid"),
    (record(LAT="90", LON="-180"), "clean"),
    (record(LAT="90.01"), "position_out_of_range"),
    (record(LAT=None, LON="5"), "position_missing"),
    (record(LAT=None, LON="200"), "position_out_of_range"),
    (record(LAT="95", LON=None), "position_out_of_range"),
    (record(LAT="x"), "position_missing"),
    (record(LAT="NaN"), "position_out_of_range"),
    ('{"MMSI":123456789,"BaseDateTime":"2024-12-25T10:00:00","LAT":{"a":1},"LON":"1"}',
     "position_missing"),
])
def test_outcome(spark, value, expected):
    assert outcomes(spark, [value]) == [expected]


def test_every_row_has_one_outcome(spark):
    values = [record(), record(MMSI="MMSI"), "{", None, record(LAT="99"), record(MMSI="1")] * 3
    result = clean_batch(messages(spark, values))
    counted = {r["outcome"]: r["row_count"] for r in clean.outcome_counts(result.tagged).collect()}
    assert sum(counted.values()) == len(values)
    assert counted["header"] == 3
    assert result.rejects.count() == 9
    assert result.dead_letters.count() == 3
    assert result.clean.count() == 1


def test_typed_and_derived_values(spark):
    values = [record(BaseDateTime="2024-12-29T10:15:00", SOG="10", VesselType="31.0",
                     Status="x", Heading="511", COG="360", IMO="IMO0000000", VesselName="  ")]
    row = clean_batch(messages(spark, values)).clean.first()
    assert row["MMSI"] == 366000001
    assert row["BaseDateTime"] == datetime(2024, 12, 29, 10, 15)
    assert row["speed_kmh"] == pytest.approx(18.52)
    assert (row["day_of_week"], row["quarter"], row["hour"], row["day"]) == (1, 4, 10, 29)
    assert row["VesselType"] == 31 and row["Status"] is None
    assert row["Heading"] is None and row["COG"] is None
    assert row["IMO"] == "UNKNOWN" and row["VesselName"] == "UNKNOWN"


@pytest.mark.parametrize("field, text, expected", [
    ("SOG", "102.2", None), ("SOG", "102.1", 102.1), ("COG", "359.9", 359.9),
    ("Heading", "510", 510.0), ("SOG", "", None),
])
def test_sentinels(spark, field, text, expected):
    row = clean_batch(messages(spark, [record(**{field: text})])).clean.first()
    assert row[field] == expected


def test_schemas(spark):
    result = clean_batch(messages(spark, [record()]))
    assert [(f.name, f.dataType) for f in result.clean.schema] == [
        (f.name, f.dataType) for f in CLEAN_SCHEMA
    ]
    assert result.rejects.columns == REJECT_SCHEMA.fieldNames()
    assert {t for _, t in result.rejects.dtypes} == {"string"}


def test_duplicate_keys_of_batch_and_history(spark):
    twice = [record(), record(LAT="29.9"), record()]
    assert clean_batch(messages(spark, twice)).clean.count() == 1
    assert clean_history(messages(spark, twice)).count() == 2


def test_cleaning_is_idempotent(spark):
    """Clean rows sent again as messages are accepted unchanged."""
    first = clean_batch(messages(spark, [record(), record(MMSI="366000002", Heading="511")])).clean
    texts = first.select(*(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) if c == "BaseDateTime"
        else F.col(c).cast("string").alias(c) for c in RAW_FIELDS
    ))
    sent = to_messages(texts).select(
        "key", "value", F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
    again = clean_batch(sent).clean
    assert rows(again.select(*RAW_FIELDS)) == rows(first.select(*RAW_FIELDS))


def test_survivor_does_not_depend_on_partitioning(spark):
    values = [record(VesselName=f"N{i}") for i in range(40)]
    kept = set()
    for parts in (1, 7):
        df = messages(spark, values).repartition(parts)
        kept.add(clean_batch(df).clean.first()["VesselName"])
    assert kept == {"N0"}


def test_drop_duplicates_prefers_smallest(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 9, "z")], "k INT, o INT, v STRING")
    assert rows(drop_duplicates(df, ["k"], ["o"])) == [(1, 2, "b"), (2, 9, "z")]


def test_attributes_take_earliest_known_value(spark):
    df = spark.createDataFrame(
        [("v", 1, None), ("v", 2, "A"), ("v", 3, "B"), ("w", 1, None)],
        "MMSI STRING, BaseDateTime INT, VesselName STRING",
    )
    assert rows(vessel_reference(df, columns=["VesselName"])) == [("v", "A"), ("w", None)]
    assert rows(recover_attributes(df, columns=["VesselName"])) == [
        ("v", 1, "A"), ("v", 2, "A"), ("v", 3, "B"), ("w", 1, None)
    ]


def test_history_keeps_text_identity_and_fills_imo(spark):
    values = [record(IMO="IMO0000000", Draft=""),
              record(BaseDateTime="2024-12-25T11:00:00", IMO="IMO7", Draft="4.5", SOG="10.01")]
    result = clean_history(messages(spark, values)).orderBy("BaseDateTime").collect()
    assert [r["MMSI"] for r in result] == ["366000001"] * 2
    assert [r["IMO"] for r in result] == ["IMO7", "IMO7"]
    assert [r["Draft"] for r in result] == [4.5, 4.5]
    assert result[1]["speed_kmh"] == 18.54


def test_history_drops_impossible_optional_readings(spark):
    values = [record(SOG="-1"), record(COG="-5"), record(Heading="400"), record(SOG=None)]
    assert clean_history(messages(spark, values)).count() == 1


def test_parser_runs_once_per_row(spark):
    accepted = clean.accepted(clean.tag_positions(parse_messages(messages(spark, [record()]))))
    plan = accepted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_topic_options():
    stream = topic_options("h:9092", "t", True)
    assert stream["startingOffsets"] == "earliest"
    assert stream["maxOffsetsPerTrigger"] == "500000" and stream["failOnDataLoss"] == "false"
    assert topic_options("h:9092", "t", False)["endingOffsets"] == "latest"


def _generators(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Generate " in line]


def test_side_branches_of_a_stream_type_few_fields(spark):
    """As the branches of the tagged rows, but dead letters are typed nowhere, rejects late."""
    values = [record(), record(MMSI="MMSI"), "{", None, "", "[]", record(LAT="99"), record(LAT="x"),
              record(MMSI=" 1 ", SOG=" 7 "), record(BaseDateTime="zz", SOG=" 7 ", Heading="x"),
              record(LAT=None, LON="200"), '{"MMSI": "366000001", "SOG"', record(MMSI=None)] * 2
    sent = messages(spark, values)
    whole = clean.clean_positions(parse_messages(sent))
    stream = clean_stream(sent)
    for got, want in ((stream.rejects, whole.rejects), (stream.dead_letters, whole.dead_letters)):
        assert got.schema == want.schema
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert want.count() > 5
    assert not any("typed_" in line for line in _generators(stream.dead_letters))
    early = [line for line in _generators(stream.rejects) if "typed_LAT" in line]
    assert early and not any("typed_SOG" in line for line in early)
