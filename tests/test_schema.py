import pytest

from sievelake.operators.schema import normalize, require_columns
from sievelake.profiles import TRIP_RENAMES, TRIPS

ACCEPTED = (
    "VendorID INT, tpep_pickup_datetime TIMESTAMP, tpep_dropoff_datetime TIMESTAMP, trip_distance DOUBLE, "
    "PULocationID INT, DOLocationID INT, fare_amount DOUBLE, total_amount DOUBLE"
)


def test_required_columns_accepted(spark):
    require_columns(spark.createDataFrame([], ACCEPTED))


def test_missing_columns_are_named_in_order(spark):
    df = spark.createDataFrame([], ACCEPTED).drop("PULocationID", "DOLocationID", "VendorID")
    with pytest.raises(ValueError, match="columns: DOLocationID, PULocationID, VendorID$"):
        normalize(df)


def test_case_decides(spark):
    df = spark.createDataFrame([], ACCEPTED).withColumnRenamed("VendorID", "vendorid")
    with pytest.raises(ValueError, match="VendorID"):
        require_columns(df)


def test_rename_keeps_order_unknown_columns_and_types(spark):
    ddl = ACCEPTED.replace("TIMESTAMP", "STRING") + ", `odd.name` INT, airport_fee DOUBLE"
    row = (1, "a", "b", 1.0, 2, 3, 4.0, 5.0, 6, 7.0)
    found = normalize(spark.createDataFrame([row], ddl))
    assert found.columns == [
        "vendor_id", "pickup_datetime", "dropoff_datetime", "trip_distance", "pickup_location_id",
        "dropoff_location_id", "fare_amount", "total_amount", "odd.name", "airport_fee",
    ]
    assert dict(found.dtypes)["pickup_datetime"] == "string"
    assert tuple(found.first()) == row


def test_all_mapped_columns(spark):
    found = normalize(spark.createDataFrame([], ", ".join(f"{name} INT" for name in TRIP_RENAMES)))
    assert found.columns == [name for name, _ in TRIPS.columns]


def test_opt_in_cast_takes_table_types(spark):
    ddl = ", ".join(f"{name} STRING" for name in TRIP_RENAMES)
    found = normalize(spark.createDataFrame([], ddl), cast=True)
    assert dict(found.dtypes) == {name: kind.lower() for name, kind in TRIPS.columns}


def test_rename_is_one_projection(spark):
    plan = normalize(spark.createDataFrame([], ACCEPTED))._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1
