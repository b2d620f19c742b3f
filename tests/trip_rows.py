"""Small trip tables for tests."""

from __future__ import annotations

from datetime import datetime

CANONICAL = (
    "pickup_datetime TIMESTAMP, dropoff_datetime TIMESTAMP, trip_distance DOUBLE, "
    "pickup_location_id INT, dropoff_location_id INT, fare_amount DOUBLE, total_amount DOUBLE"
)

SOURCE = (
    "VendorID INT, tpep_pickup_datetime TIMESTAMP, tpep_dropoff_datetime TIMESTAMP, passenger_count INT, "
    "trip_distance DOUBLE, RatecodeID INT, store_and_fwd_flag STRING, PULocationID INT, DOLocationID INT, "
    "payment_type INT, fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE, "
    "tolls_amount DOUBLE, improvement_surcharge DOUBLE, total_amount DOUBLE, "
    "congestion_surcharge DOUBLE, Airport_fee DOUBLE, cbd_congestion_fee DOUBLE"
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2025-08-{text}")


def source_row(pickup: str, dropoff: str, distance: float, fare: float, total: float) -> tuple:
    return (
        1, at(f"01 {pickup}"), at(f"01 {dropoff}"), 1, distance, 1, "N", 100, 200, 1,
        fare, 0.5, 0.5, 1.0, 0.0, 1.0, total, 0.0, 0.0, 0.8,
    )


THREE_TRIPS = [
    source_row("10:00", "10:20", 3.5, 15.0, 19.8),
    source_row("11:00", "11:10", 0.0, 10.0, 13.8),
    source_row("12:00", "12:20", -2.0, 12.0, 15.8),
]


def write_source(spark, path: str, rows=THREE_TRIPS) -> str:
    spark.createDataFrame(rows, SOURCE).coalesce(1).write.mode("overwrite").parquet(path)
    return path
