"""Batch-metrics history: one CSV row per published month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Header of the history file.
HISTORY_DDL = (
    "month STRING, source_records BIGINT, valid_records BIGINT, warning_records BIGINT, "
    "quarantined_records BIGINT, curated_records BIGINT, athena_records BIGINT"
)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The schema is given, so no pass over the file is spent on inferring it."""
    return spark.read.schema(HISTORY_DDL).option("header", True).option("mode", "FAILFAST").csv(path)
