from datetime import timedelta

import pytest
from trip_rows import CANONICAL, at

from sievelake.operators.classify import classify, curated, quarantined, stamp, where_fired
from sievelake.profiles import QUARANTINE, TRIPS, VALID, WARNING, Profile, Rule

NOON = at("01 12:00")
LATER = at("01 12:20")
DAY = timedelta(days=1)


def trip(pickup=NOON, dropoff=LATER, distance=2.0, start=100, end=200, fare=15.0, total=20.0):
    return (pickup, dropoff, distance, start, end, fare, total)


CASES = {
    "valid": (trip(), [], [], VALID),
    "negative distance": (trip(distance=-1.0), ["NEGATIVE_TRIP_DISTANCE"], [], QUARANTINE),
    "dropoff first": (trip(LATER, NOON), ["INVALID_TIME_RANGE"], [], QUARANTINE),
    "zero distance": (trip(distance=0.0), [], ["ZERO_TRIP_DISTANCE"], WARNING),
    "negative zero distance": (trip(distance=-0.0), [], ["ZERO_TRIP_DISTANCE"], WARNING),
    "negative fare": (trip(fare=-5.0), [], ["NEGATIVE_FARE_AMOUNT"], WARNING),
    "negative total": (trip(total=-5.0), [], ["NEGATIVE_TOTAL_AMOUNT"], WARNING),
    "both severities": (
        trip(LATER, NOON, distance=0.0, fare=-5.0),
        ["INVALID_TIME_RANGE"],
        ["ZERO_TRIP_DISTANCE", "NEGATIVE_FARE_AMOUNT"],
        QUARANTINE,
    ),
    "no pickup": (trip(pickup=None), ["MISSING_PICKUP_DATETIME"], [], QUARANTINE),
    "no dropoff": (trip(dropoff=None), ["MISSING_DROPOFF_DATETIME"], [], QUARANTINE),
    "no pickup place": (trip(start=None), ["MISSING_PICKUP_LOCATION"], [], QUARANTINE),
    "no dropoff place": (trip(end=None), ["MISSING_DROPOFF_LOCATION"], [], QUARANTINE),
    "everything missing": (
        (None,) * 7,
        [
            "MISSING_PICKUP_DATETIME", "MISSING_DROPOFF_DATETIME",
            "MISSING_PICKUP_LOCATION", "MISSING_DROPOFF_LOCATION",
        ],
        [],
        QUARANTINE,
    ),
    "amounts unknown": (trip(distance=None, fare=None, total=None), [], [], VALID),
    "distance not a number": (trip(distance=float("nan")), [], [], VALID),
    "no time at all": (trip(NOON, NOON), [], [], VALID),
    "exactly a day": (trip(NOON, NOON + DAY), [], [], VALID),
    "a second over": (trip(NOON, NOON + DAY + timedelta(seconds=1)), [], ["TRIP_OVER_24_HOURS"], WARNING),
    # Both sides are cut to whole seconds first: 12:00:00.9 to 12:00:01.0 a day later counts a second over.
    "cut to seconds": (
        trip(NOON + timedelta(milliseconds=900), NOON + DAY + timedelta(seconds=1)),
        [],
        ["TRIP_OVER_24_HOURS"],
        WARNING,
    ),
    "part of a second": (trip(NOON, NOON + DAY + timedelta(milliseconds=900)), [], [], VALID),
}


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(name, *case[0]) for name, case in CASES.items()]
    df = classify(spark.createDataFrame(rows, f"name STRING, {CANONICAL}"))
    return {row["name"]: row for row in df.collect()}


@pytest.mark.parametrize("name", CASES)
def test_case(classified, name):
    row = classified[name]
    _, quarantine, warning, status = CASES[name]
    assert row["quarantine_reasons"] == quarantine
    assert row["warning_reasons"] == warning
    assert row["validation_status"] == status


@pytest.mark.parametrize("rule", TRIPS.rules, ids=lambda rule: rule.code)
def test_rows_of_one_rule(spark, rule):
    rows = [(name, *case[0]) for name, case in CASES.items()]
    found = where_fired(spark.createDataFrame(rows, f"name STRING, {CANONICAL}"), rule.code)
    wanted = {name for name, case in CASES.items() if rule.code in case[1] + case[2]}
    assert wanted and {row["name"] for row in found.collect()} == wanted


def test_unknown_rule_is_refused(spark):
    with pytest.raises(KeyError):
        where_fired(spark.createDataFrame([], CANONICAL), "NO_SUCH_RULE")


def test_split_loses_nothing(spark):
    df = classify(spark.createDataFrame([case[0] for case in CASES.values()], CANONICAL))
    assert curated(df).count() + quarantined(df).count() == len(CASES)
    assert {row[0] for row in curated(df).select("validation_status").distinct().collect()} == {VALID, WARNING}


def test_lineage_is_constant(spark):
    df = stamp(classify(spark.createDataFrame([trip(), trip()], CANONICAL)), "f.parquet", "b_2025_08", "1.0")
    stamps = df.select("source_file", "batch_id", "schema_version", "ingested_at").distinct().collect()
    assert len(stamps) == 1
    assert stamps[0][:3] == ("f.parquet", "b_2025_08", "1.0")
    assert stamps[0]["ingested_at"].endswith("+00:00")
    assert df.columns[-4:] == ["source_file", "batch_id", "schema_version", "ingested_at"]


def test_other_tables_bring_other_rules(spark):
    profile = Profile(
        name="orders",
        renames={},
        required=("o_totalprice",),
        rules=(Rule("TOO_CHEAP", WARNING, "o_totalprice < 1"),),
        columns=(("o_totalprice", "DOUBLE"),),
    )
    rows = classify(spark.createDataFrame([(0.5,), (2.0,)], "o_totalprice DOUBLE"), profile).collect()
    assert [row["validation_status"] for row in rows] == [WARNING, VALID]
    assert rows[0]["warning_reasons"] == ["TOO_CHEAP"] and rows[0]["quarantine_reasons"] == []


def test_new_york_clock_change_on_zoned_timestamps(spark):
    """A zoned day of 25 hours is over the limit, whatever the wall clock shows."""
    df = spark.sql(
        """SELECT timestamp'2025-11-01 12:00:00 America/New_York' AS pickup_datetime,
                  timestamp'2025-11-02 12:00:00 America/New_York' AS dropoff_datetime,
                  1D AS trip_distance, 1 AS pickup_location_id, 1 AS dropoff_location_id,
                  1D AS fare_amount, 1D AS total_amount"""
    )
    assert classify(df).first()["warning_reasons"] == ["TRIP_OVER_24_HOURS"]
