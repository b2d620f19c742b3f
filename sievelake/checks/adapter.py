"""Trips derived from `lineitem`, and scratch space for queries that write.

A batch is the month of `l_shipdate`. Quarantine rules depend on `l_partkey` and
warning rules on `l_orderkey`, so that rows with both severities occur.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sievelake.batch import Lake

DATASET = "trips"
PREFIX = "trip_data"

_local_scratch: list[str] = []


def trip_expressions(seconds_after_ship: Callable[[str], str]) -> list[tuple[str, str]]:
    """Source columns as SQL text; the one dialect difference is how seconds are added to `l_shipdate`."""
    start = "(l_orderkey * 37 % 86400)"
    length = (
        "CASE WHEN l_partkey % 61 = 0 THEN -600 WHEN l_orderkey % 67 = 0 THEN 90000 "
        "ELSE CAST(60 * l_quantity AS BIGINT) END"
    )
    return [
        ("VendorID", "CAST(l_suppkey % 2 + 1 AS INT)"),
        (
            "tpep_pickup_datetime",
            f"CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE {seconds_after_ship(start)} END",
        ),
        (
            "tpep_dropoff_datetime",
            "CASE WHEN l_partkey % 59 = 0 THEN NULL "
            f"ELSE {seconds_after_ship(f'{start} + {length}')} END",
        ),
        ("passenger_count", "CAST(l_linenumber AS BIGINT)"),
        (
            "trip_distance",
            "CASE WHEN l_partkey % 71 = 0 THEN -l_quantity "
            "WHEN l_orderkey % 73 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity / 2 END",
        ),
        ("RatecodeID", "CAST(l_suppkey % 6 + 1 AS BIGINT)"),
        ("store_and_fwd_flag", "CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END"),
        ("PULocationID", "CASE WHEN l_partkey % 79 = 0 THEN NULL ELSE CAST(l_suppkey % 265 + 1 AS INT) END"),
        ("DOLocationID", "CASE WHEN l_partkey % 83 = 0 THEN NULL ELSE CAST(l_orderkey % 265 + 1 AS INT) END"),
        ("payment_type", "CAST(l_linenumber % 4 + 1 AS BIGINT)"),
        ("fare_amount", "CASE WHEN l_orderkey % 89 = 0 THEN -l_extendedprice ELSE l_extendedprice END"),
        ("extra", "l_discount"),
        ("mta_tax", "l_tax"),
        ("tip_amount", "l_discount"),
        ("tolls_amount", "l_tax"),
        ("improvement_surcharge", "l_discount"),
        (
            "total_amount",
            "CASE WHEN l_orderkey % 97 = 0 THEN -l_extendedprice ELSE l_extendedprice * (1 + l_tax) END",
        ),
        ("congestion_surcharge", "l_tax"),
        ("Airport_fee", "l_discount"),
        ("cbd_congestion_fee", "l_tax"),
        ("year", "CAST(year(l_shipdate) AS INT)"),
        ("month", "CAST(month(l_shipdate) AS INT)"),
    ]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = trip_expressions(lambda seconds: f"timestampadd(SECOND, {seconds}, l_shipdate)")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lineitem.selectExpr(*[f"{text} AS {name}" for name, text in columns])


def scratch(spark: SparkSession) -> str:
    """A new folder below the session's shared folder.

    Only a local session without one falls back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: no shared folder to write to")
        if not _local_scratch:
            _local_scratch.append(tempfile.mkdtemp(prefix="sievelake-"))
        shared = _local_scratch[0]
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def scratch_lake(spark: SparkSession) -> Lake:
    return Lake(scratch(spark))


def scratch_table() -> str:
    return f"curated_{DATASET}_{uuid.uuid4().hex}"
