"""Small tables made on the driver: run records, batch lists, counts per batch."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ARROW = {
    "STRING": pa.string(),
    "INT": pa.int32(),
    "BIGINT": pa.int64(),
    "DOUBLE": pa.float64(),
    "BOOLEAN": pa.bool_(),
}


def fields(ddl: str) -> list[tuple[str, str]]:
    """Names and types of a flat column list such as `a INT, b STRING`."""
    return [tuple(column.split()) for column in ddl.split(",")]


def small_frame(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A local relation. Its size is known to the planner, which so may broadcast it by itself;
    a DataFrame from a Python list is an RDD of unknown size."""
    columns = {
        name: pa.array([row[place] for row in rows], _ARROW[kind])
        for place, (name, kind) in enumerate(fields(ddl))
    }
    return spark.createDataFrame(pa.table(columns))
