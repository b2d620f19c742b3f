"""Do the published partitions hold the rows the batches produced?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def count_query(table: str, year: int, month: int) -> str:
    """Count of one partition; the predicate names partition columns only, so others are not read."""
    return f"SELECT COUNT(*) AS record_count FROM {table} WHERE year = {int(year)} AND month = {int(month)}"


def count_partition(spark: SparkSession, table: str, year: int, month: int) -> int:
    return spark.sql(count_query(table, year, month)).first()["record_count"]


def partition_counts(published: DataFrame) -> DataFrame:
    """Counts of all partitions in one job; Parquet answers it from file footers."""
    return published.groupBy("year", "month").agg(F.count("*").alias("published_records"))


def reconcile(expected: DataFrame, counts: DataFrame) -> DataFrame:
    """Compare `expected_records` with `published_records` per partition.

    A side without the partition counts 0, so a lost and an unexpected partition both show.
    """
    zero = F.lit(0).cast("bigint")
    both = expected.select("year", "month", "expected_records").join(
        counts.select("year", "month", "published_records"), ["year", "month"], "full_outer"
    )
    wanted = F.coalesce("expected_records", zero)
    found = F.coalesce("published_records", zero)
    return both.select(
        "year",
        "month",
        wanted.alias("expected_records"),
        found.alias("published_records"),
        (found - wanted).alias("difference"),
        F.when(found == wanted, "MATCH").otherwise("MISMATCH").alias("reconciliation_status"),
    )


def outcome(enabled: Column, partition_status: Column, failed: Column, compared: Column) -> Column:
    """Final status: DISABLED without a reconciler or a usable partition, FAILED on an error."""
    usable = F.coalesce(enabled & partition_status.isin("CREATED", "EXISTS"), F.lit(False))
    return (
        F.when(~usable, "DISABLED").when(F.coalesce(failed, F.lit(False)), "FAILED").otherwise(compared)
    )
