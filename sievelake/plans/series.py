"""Batch series: process, publish, register, reconcile and record, once per source content.

The driver walks over batches, which are few; all work on rows is in the Spark
jobs it starts. Reruns skip whatever the ledger and the lake show as done.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from sievelake.batch import Batch, Lake, under
from sievelake.operators import ledger as ledgers
from sievelake.operators.classify import utc_now
from sievelake.operators.ledger import COUNTS
from sievelake.operators.reconcile import count_partition
from sievelake.plans.batch_run import run_batch
from sievelake.profiles import TRIPS, Profile
from sievelake.sinks import catalog, publish
from sievelake.sources.ledger import append_records, read_ledger
from sievelake.sources.manifest import source_checksum, source_checksums
from sievelake.sources.small import small_frame


@dataclass(frozen=True)
class Site:
    """Where a series works and which steps it takes.

    Without a `lake` nothing is published, without a `table` nothing is
    registered, and reconciliation needs both besides its own switch. A series in one pass hashes only files whose size or time
    differs from the stored manifest's, or with `rehash` all.
    """

    ledger: str
    work_root: str = ""
    lake: Lake | None = None
    table: str | None = None
    reconcile: bool = True
    profile: Profile = TRIPS
    cast: bool = False
    trust_processing_status: bool = False
    rehash: bool = False

    @property
    def registers(self) -> bool:
        return self.lake is not None and self.table is not None

    @property
    def reconciles(self) -> bool:
        return self.registers and self.reconcile

    def source(self, batch: Batch) -> str:
        return under(self.work_root, batch.input_path)


def process_batch(
    spark: SparkSession, batch: Batch, site: Site, checksum: str | None = None
) -> dict[str, Any]:
    """Bring one batch to its final state and return its run record.

    A failure is recorded before it is raised. A rerun that changed nothing
    returns its record without adding it to the ledger. Versioned lakes are written by `one_pass.run_all` alone.
    """
    if site.lake is not None and site.lake.versioned:
        raise ValueError("a versioned lake is written by a series in one pass")
    record: dict[str, Any] = {
        "run_id": str(uuid.uuid4()),
        "batch_id": batch.batch_id,
        "dataset": batch.dataset,
        "period": batch.period,
        "source_file": batch.source_file,
        "source_path": site.source(batch),
        "schema_version": batch.schema_version,
        "started_at": utc_now(),
        "status": "STARTED",
        "reconciliation_status": "NOT_RUN",
        "s3_publish_enabled": site.lake is not None,
        "glue_registration_enabled": site.registers,
        "athena_reconciliation_enabled": site.reconciles,
    }
    try:
        record["source_checksum"] = checksum or source_checksum(spark, site.source(batch))
        if _is_processed(spark, site, record):
            keep = _resume(spark, batch, site, record)
        else:
            keep = _start(spark, batch, site, record)
        if keep:
            record.update(status="SUCCESS", completed_at=utc_now())
            _append(spark, site, record)
        return record
    except Exception as error:
        record.update(
            status="FAILED",
            completed_at=utc_now(),
            error_type=type(error).__name__,
            error_message=str(error),
        )
        if site.lake is not None:
            record.setdefault("s3_publish_status", "FAILED")
        if site.registers:
            record.setdefault("glue_partition_status", "FAILED")
        _append(spark, site, record)
        raise


def _append(spark: SparkSession, site: Site, record: dict[str, Any]) -> None:
    append_records(spark, site.ledger, [record])


def _key(spark: SparkSession, record: dict[str, Any]):
    key = (record["batch_id"], record["source_checksum"])
    return small_frame(spark, [key], "batch_id STRING, source_checksum STRING")


def _is_processed(spark: SparkSession, site: Site, record: dict[str, Any]) -> bool:
    done = ledgers.skipped(
        _key(spark, record), read_ledger(spark, site.ledger), site.trust_processing_status
    )
    return not done.isEmpty()


def _recorded(spark: SparkSession, site: Site, record: dict[str, Any]) -> dict[str, Any]:
    """Counts and ingestion time of the run that processed this content."""
    counts = ledgers.latest_counts(read_ledger(spark, site.ledger), site.trust_processing_status)
    found = counts.join(_key(spark, record), ledgers.KEY, "left_semi").first()
    if found is None:
        raise ledgers.no_counts(record["batch_id"])
    return {name: found[name] for name in (*COUNTS, "ingested_at") if found[name] is not None}


def _run(spark: SparkSession, batch: Batch, site: Site, outputs: tuple[str, str, str], ingested_at: str):
    return run_batch(
        spark,
        site.source(batch),
        batch.source_file,
        batch.batch_id,
        batch.schema_version,
        *outputs,
        profile=site.profile,
        cast=site.cast,
        ingested_at=ingested_at,
    )


def _work_outputs(batch: Batch, site: Site) -> tuple[str, str, str]:
    outputs = (batch.curated_output, batch.quarantine_output, batch.metrics_output)
    return tuple(under(site.work_root, output) for output in outputs)


def _lake_outputs(batch: Batch, lake: Lake) -> tuple[str, str, str]:
    return lake.curated(batch), lake.quarantine(batch), lake.metrics(batch)


def _start(spark: SparkSession, batch: Batch, site: Site, record: dict[str, Any]) -> bool:
    """New content. With publication on, outputs are written to the lake at once and never copied."""
    outputs = _lake_outputs(batch, site.lake) if site.lake else _work_outputs(batch, site)
    record["ingested_at"] = utc_now()
    record.update(_run(spark, batch, site, outputs, record["ingested_at"]))
    record["processing_status"] = "SUCCESS"
    if site.lake is None:
        record.update(s3_publish_status="DISABLED", glue_partition_status="DISABLED")
    else:
        _finish_publication(spark, batch, site, record, "SUCCESS")
        _register(spark, batch, site, record)
    _reconcile(spark, batch, site, record)
    return True


def _resume(spark: SparkSession, batch: Batch, site: Site, record: dict[str, Any]) -> bool:
    """Content processed before: publish what is missing, then register and reconcile."""
    record["processing_status"] = "SKIPPED_ALREADY_PROCESSED"
    if site.lake is None:
        return False
    if publish.is_published(spark, site.lake, batch, record["source_checksum"]):
        record.update(s3_publish_status="EXISTS", s3_bucket=site.lake.root)
    else:
        _backfill(spark, batch, site, record)
        _finish_publication(spark, batch, site, record, "BACKFILLED")
    _register(spark, batch, site, record)
    _reconcile(spark, batch, site, record)
    return (
        record["s3_publish_status"] == "BACKFILLED"
        or record["glue_partition_status"] == "CREATED"
        or record["reconciliation_status"] == "MATCH"
    )


def _backfill(spark: SparkSession, batch: Batch, site: Site, record: dict[str, Any]) -> None:
    """Publish the outputs the earlier run left, or derive them again from the same content.

    Outputs written straight to the lake have no second copy; the source has the
    recorded checksum, so deriving them with the recorded ingestion time restores the same rows.
    """
    restore(spark, batch, site, _recorded(spark, site, record).get("ingested_at") or utc_now())


def restore(spark: SparkSession, batch: Batch, site: Site, ingested_at: str) -> None:
    if publish.has_processed_outputs(spark, batch, site.work_root):
        publish.copy_outputs(spark, site.lake, batch, site.work_root)
    else:
        transform(spark, batch, site, ingested_at)


def transform(spark: SparkSession, batch: Batch, site: Site, ingested_at: str) -> dict[str, int]:
    """One batch from its source straight into the lake."""
    return _run(spark, batch, site, _lake_outputs(batch, site.lake), ingested_at)


def _finish_publication(
    spark: SparkSession, batch: Batch, site: Site, record: dict[str, Any], status: str
) -> None:
    publish.publish_raw(spark, site.lake, batch, site.source(batch), record["source_checksum"])
    summary = publish.publication_summary(spark, site.lake, batch)
    record.update(s3_publish_status=status, s3_bucket=site.lake.root)
    for name in ("curated_object_count", "quarantine_object_count", "quality_object_count"):
        record[f"s3_{name}"] = summary[name]


def _register(spark: SparkSession, batch: Batch, site: Site, record: dict[str, Any]) -> None:
    created = (
        catalog.register_partition(spark, site.table, site.lake, batch) if site.registers else None
    )
    record["glue_partition_status"] = catalog.partition_status(created)


def _reconcile(spark: SparkSession, batch: Batch, site: Site, record: dict[str, Any]) -> None:
    """Compare the partition's count with the processed count; a mismatch is kept, then raised."""
    if not site.reconciles or record["glue_partition_status"] not in ("CREATED", "EXISTS"):
        record["reconciliation_status"] = "DISABLED"
        return
    try:
        if "valid_records" not in record:
            record.update(_recorded(spark, site, record))
        expected = record["valid_records"] + record["warning_records"]
        found = count_partition(spark, site.table, batch.year, batch.month)
    except Exception:
        record["reconciliation_status"] = "FAILED"
        raise
    record.update(
        year=batch.year,
        month=batch.month,
        expected_records=expected,
        athena_records=found,
        difference=found - expected,
        reconciliation_status="MATCH" if found == expected else "MISMATCH",
    )
    if found != expected:
        raise RuntimeError(
            f"reconciliation MISMATCH for {batch.batch_id}: expected {expected}, found {found}"
        )


def run_series(
    spark: SparkSession, batches: Iterable[Batch], site: Site, parallel: int = 1
) -> list[dict[str, Any]]:
    """Process batches in order; the first failure keeps later ones from starting.

    All sources are hashed by one job beforehand, so that files are read side by
    side. With `parallel` above 1 small batches share the cluster: their jobs are
    submitted from that many threads, and those under way when one fails finish.
    """
    batches = list(batches)
    checksums = source_checksums(spark, {site.source(batch) for batch in batches})

    def process(batch: Batch) -> dict[str, Any]:
        return process_batch(spark, batch, site, checksums.get(site.source(batch)))

    if parallel <= 1:
        return [process(batch) for batch in batches]
    with ThreadPoolExecutor(parallel) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(process), batch) for batch in batches]
        wait(runs, return_when=FIRST_EXCEPTION)
        for run in runs:
            if run.done() and not run.cancelled() and run.exception():
                pool.shutdown(wait=True, cancel_futures=True)
                break
    failed = [run.exception() for run in runs if not run.cancelled() and run.exception()]
    if failed:
        raise failed[0]
    return [run.result() for run in runs]


def run_single(spark: SparkSession, batch: Batch, site: Site) -> dict[str, Any] | None:
    """One batch into the working folder, without publication. None when it was processed before."""
    record: dict[str, Any] = {
        "run_id": str(uuid.uuid4()),
        "batch_id": batch.batch_id,
        "source_file": batch.source_file,
        "schema_version": batch.schema_version,
        "started_at": utc_now(),
        # A missing source fails here, before there is a run to record.
        "source_checksum": source_checksum(spark, site.source(batch)),
    }
    if _is_processed(spark, site, record):
        return None
    try:
        record["ingested_at"] = utc_now()
        record.update(_run(spark, batch, site, _work_outputs(batch, site), record["ingested_at"]))
        record.update(status="SUCCESS", completed_at=utc_now())
    except Exception as error:
        record.update(status="FAILED", completed_at=utc_now(), error=str(error))
        raise
    finally:
        _append(spark, site, record)
    return record
