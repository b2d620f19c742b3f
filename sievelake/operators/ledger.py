"""Decisions taken from the run ledger, for any number of batches at once.

A ledger grows without end and one batch may own much of it, so it is always
grouped to one row per (batch, checksum) before it meets a join: Spark combines
those groups map-side and the join sees unique keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["batch_id", "source_checksum"]
COUNTS = ["rows_read", "valid_records", "warning_records", "quarantined_records"]


def processing_completed(trust_processing_status: bool = False) -> Column:
    """Did the run finish its transform? True or false, never null.

    A run that failed in reconciliation only has complete outputs and counts. With
    `trust_processing_status` any run whose transform succeeded counts, so that a
    failed publication or registration does not repeat the transform.
    """
    col = F.col
    processed = col("processing_status").isin("SUCCESS", "SKIPPED_ALREADY_PROCESSED")
    unreconciled = col("reconciliation_status").isin("MISMATCH", "FAILED")
    completed = (col("status") == "SUCCESS") | (processed & unreconciled)
    if trust_processing_status:
        completed = completed | (col("processing_status") == "SUCCESS")
    return F.coalesce(completed, F.lit(False))


def completed_keys(ledger: DataFrame, trust_processing_status: bool = False) -> DataFrame:
    return ledger.where(processing_completed(trust_processing_status)).select(*KEY).distinct()


def pending(batches: DataFrame, ledger: DataFrame, trust_processing_status: bool = False) -> DataFrame:
    """Batches whose exact source has not been processed yet."""
    return batches.join(completed_keys(ledger, trust_processing_status), KEY, "left_anti")


def skipped(batches: DataFrame, ledger: DataFrame, trust_processing_status: bool = False) -> DataFrame:
    """Batches whose exact source is done."""
    return batches.join(completed_keys(ledger, trust_processing_status), KEY, "left_semi")


def latest_counts(ledger: DataFrame, trust_processing_status: bool = False) -> DataFrame:
    """Counts of the last completed record per key that has them; `ledger` carries `seq`.

    `max_by` keeps one candidate per task and key, where a window would sort all
    records of a key in one task.
    """
    counted = ledger.where(
        processing_completed(trust_processing_status)
        & F.col("valid_records").isNotNull()
        & F.col("warning_records").isNotNull()
    )
    kept = F.struct(*COUNTS, "ingested_at")
    return (
        counted.groupBy(*KEY)
        .agg(F.max_by(kept, F.col("seq")).alias("kept"))
        .select(*KEY, "kept.*")
    )


def no_counts(batch_id: str) -> RuntimeError:
    return RuntimeError(f"{batch_id}: no run in the ledger holds its counts")


def worth_recording(publish_status: Column, partition_status: Column, reconciliation: Column) -> Column:
    """Does a rerun of a processed batch leave a ledger record? A rerun that changed nothing does not."""
    changed = (publish_status == "BACKFILLED") | (partition_status == "CREATED")
    return F.coalesce(changed | (reconciliation == "MATCH"), F.lit(False))


def rerun_records(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(
        worth_recording(
            F.col("s3_publish_status"), F.col("glue_partition_status"), F.col("reconciliation_status")
        )
    )
