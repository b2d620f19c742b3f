"""Row classification, lineage and the split by severity."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.functions import addresses
from sievelake.functions.reasons import fired_codes, fires, validation_status
from sievelake.profiles import QUARANTINE, TRIPS, VALID, WARNING, Profile


def classify(df: DataFrame, profile: Profile = TRIPS) -> DataFrame:
    """Add both reason arrays and the status. A quarantined row keeps its warnings too."""
    return df.select(
        "*",
        fired_codes(profile.rules_of(QUARANTINE)).alias("quarantine_reasons"),
        fired_codes(profile.rules_of(WARNING)).alias("warning_reasons"),
        validation_status(profile).alias("validation_status"),
    )


def where_fired(df: DataFrame, code: str, profile: Profile = TRIPS) -> DataFrame:
    """Canonical rows for which one rule fires; simple rules reach the Parquet scan as filters."""
    rule = next((rule for rule in profile.rules if rule.code == code), None)
    if rule is None:
        raise KeyError(f"no rule {code} in profile {profile.name}")
    return df.where(fires(rule))


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def stamp(
    df: DataFrame,
    source_file: str | Column,
    batch_id: str | Column,
    schema_version: str,
    ingested_at: str | None = None,
) -> DataFrame:
    """Add the lineage columns. `ingested_at` is one driver-side instant for the whole batch."""

    def column(value: str | Column) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    return df.withColumns(
        {
            "source_file": column(source_file),
            "batch_id": column(batch_id),
            "schema_version": F.lit(schema_version),
            "ingested_at": F.lit(ingested_at or utc_now()),
        }
    )


def stamp_batches(
    df: DataFrame,
    dataset: str,
    source_prefix: str,
    schema_version: str = "1.0",
    ingested_at: str | None = None,
) -> DataFrame:
    """Lineage for rows of many batches, addressed by their `year` and `month` columns."""
    year, month = F.col("year"), F.col("month")
    return stamp(
        df,
        addresses.source_file(source_prefix, year, month),
        addresses.batch_id(dataset, year, month),
        schema_version,
        ingested_at,
    )


def curated(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("validation_status").isin(VALID, WARNING))


def quarantined(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("validation_status") == QUARANTINE)
