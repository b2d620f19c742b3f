import uuid

import pytest
from trip_rows import THREE_TRIPS, write_source

from sievelake.batch import Batch, Lake
from sievelake.operators.reconcile import count_partition
from sievelake.plans import series
from sievelake.plans.series import Site, process_batch, run_series, run_single
from sievelake.sinks import catalog, files, publish
from sievelake.sources.ledger import append_records, read_ledger
from sievelake.sources.manifest import source_checksum

AUGUST = Batch("yellow_taxi", "yellow_tripdata", 2025, 8)


class Run:
    """A site with one stored batch, and a note of each transform."""

    def __init__(self, spark, root, monkeypatch):
        self.spark = spark
        self.work = str(root / "work")
        lake = Lake(str(root / "lake"))
        self.table = f"t_{uuid.uuid4().hex}"
        catalog.create_table(spark, self.table, lake.curated_root("yellow_taxi"))
        self.site = Site(lake.ledger, self.work, lake, self.table)
        self.transforms = []
        original = series.run_batch

        def noted(spark, source, *arguments, **options):
            self.transforms.append(source)
            return original(spark, source, *arguments, **options)

        monkeypatch.setattr(series, "run_batch", noted)
        self.store(AUGUST)

    def store(self, batch, rows=THREE_TRIPS):
        return write_source(self.spark, f"{self.work}/{batch.input_path}", rows)

    def __call__(self, **changes):
        site = Site(**{**self.site.__dict__, **changes})
        return process_batch(self.spark, AUGUST, site)

    def records(self):
        return read_ledger(self.spark, self.site.ledger).orderBy("seq").collect()


@pytest.fixture
def run(spark, tmp_path, monkeypatch):
    run = Run(spark, tmp_path, monkeypatch)
    yield run
    spark.sql(f"DROP TABLE {run.table}")


def test_new_batch(run):
    record = run()
    assert record["status"] == "SUCCESS" and record["reconciliation_status"] == "MATCH"
    assert record["glue_partition_status"] == "CREATED" and record["s3_publish_status"] == "SUCCESS"
    (stored,) = run.records()
    assert (stored["rows_read"], stored["valid_records"], stored["warning_records"]) == (3, 1, 1)
    assert (stored["expected_records"], stored["athena_records"], stored["difference"]) == (2, 2, 0)
    assert stored["source_checksum"] == source_checksum(run.spark, run.site.source(AUGUST))
    assert stored["s3_curated_object_count"] >= 2
    assert publish.is_published(run.spark, run.site.lake, AUGUST, stored["source_checksum"])
    rows = run.spark.table(run.table).collect()
    assert {row["ingested_at"] for row in rows} == {stored["ingested_at"]}


def test_rerun_reconciles_without_transform(run):
    run()
    record = run()
    assert len(run.transforms) == 1
    assert record["processing_status"] == "SKIPPED_ALREADY_PROCESSED"
    assert record["s3_publish_status"] == "EXISTS" and record["glue_partition_status"] == "EXISTS"
    assert [r["reconciliation_status"] for r in run.records()] == ["MATCH", "MATCH"]


def test_lost_marker_is_backfilled_with_the_same_rows(run):
    run()
    before = run.spark.read.parquet(run.site.lake.quarantine(AUGUST)).collect()
    files.remove(run.spark, run.site.lake.quarantine(AUGUST))
    record = run()
    assert record["s3_publish_status"] == "BACKFILLED" and record["reconciliation_status"] == "MATCH"
    assert run.spark.read.parquet(run.site.lake.quarantine(AUGUST)).collect() == before


def test_outputs_of_a_single_run_are_published_later_without_transform(run):
    run_single(run.spark, AUGUST, run.site)
    assert len(run.transforms) == 1
    record = run()
    assert len(run.transforms) == 1
    assert record["s3_publish_status"] == "BACKFILLED" and record["glue_partition_status"] == "CREATED"
    assert record["reconciliation_status"] == "MATCH" and record["expected_records"] == 2


def test_dropped_partition_is_created_again(run):
    run()
    run.spark.sql(f"ALTER TABLE {run.table} DROP PARTITION (year=2025, month=8)")
    record = run()
    assert record["glue_partition_status"] == "CREATED" and record["s3_publish_status"] == "EXISTS"
    assert len(run.transforms) == 1


@pytest.mark.parametrize("failure", ["MISMATCH", "error"])
def test_failed_reconciliation_is_recorded_and_retry_skips_transform(run, monkeypatch, failure):
    def fail(*_):
        if failure == "error":
            raise TimeoutError("query timed out")
        return 1

    monkeypatch.setattr(series, "count_partition", fail)
    with pytest.raises((RuntimeError, TimeoutError), match="MISMATCH|timed out"):
        run()
    (record,) = run.records()
    assert record["status"] == "FAILED" and record["s3_publish_status"] == "SUCCESS"
    assert record["glue_partition_status"] == "CREATED"
    if failure == "MISMATCH":
        assert record["reconciliation_status"] == "MISMATCH" and record["difference"] == -1
    else:
        assert record["reconciliation_status"] == "FAILED" and record["error_type"] == "TimeoutError"
    monkeypatch.setattr(series, "count_partition", count_partition)
    assert run()["status"] == "SUCCESS"
    assert len(run.transforms) == 1


def test_mismatch_of_a_processed_batch_is_logged(run, monkeypatch):
    run()
    monkeypatch.setattr(series, "count_partition", lambda *_: 3)
    with pytest.raises(RuntimeError, match="MISMATCH for yellow_taxi_2025_08: expected 2, found 3"):
        run()
    last = run.records()[-1]
    assert last["status"] == "FAILED" and last["difference"] == 1
    assert last["processing_status"] == "SKIPPED_ALREADY_PROCESSED" and len(run.transforms) == 1


def test_changed_source_is_processed_again(run, monkeypatch):
    monkeypatch.setattr(series, "count_partition", lambda *_: 0)
    with pytest.raises(RuntimeError, match="MISMATCH"):
        run()
    monkeypatch.setattr(series, "count_partition", count_partition)
    run.store(AUGUST, THREE_TRIPS[:1])
    assert run()["expected_records"] == 1
    assert len(run.transforms) == 2
    assert run.spark.table(run.table).count() == 1  # nothing of the old content is left


@pytest.mark.parametrize("off", ["lake", "table", "reconcile"])
def test_switched_off_steps(run, off):
    record = run(**{off: None if off != "reconcile" else False})
    assert record["reconciliation_status"] == "DISABLED" and record["status"] == "SUCCESS"
    published = run.records()[-1]["s3_publish_status"]
    assert published == ("DISABLED" if off == "lake" else "SUCCESS")
    registered = run.records()[-1]["glue_partition_status"]
    assert registered == ("CREATED" if off == "reconcile" else "DISABLED")


def test_rerun_that_changes_nothing_leaves_no_record(run):
    run(reconcile=False)
    run(reconcile=False)
    run(lake=None)
    assert len(run.records()) == 1 and len(run.transforms) == 1


def test_failed_registration_prevents_reconciliation(run, monkeypatch):
    def fail(*_):
        raise RuntimeError("catalog unavailable")

    monkeypatch.setattr(catalog, "register_partition", fail)
    with pytest.raises(RuntimeError, match="catalog unavailable"):
        run()
    (record,) = run.records()
    assert record["reconciliation_status"] == "NOT_RUN" and record["glue_partition_status"] == "FAILED"
    assert record["s3_publish_status"] == "SUCCESS"


def test_missing_source_is_recorded(run):
    files.remove(run.spark, run.site.source(AUGUST))
    with pytest.raises(FileNotFoundError):
        run()
    (record,) = run.records()
    assert record["status"] == "FAILED" and record["error_type"] == "FileNotFoundError"
    assert record["s3_publish_status"] == record["glue_partition_status"] == "FAILED"
    assert record["reconciliation_status"] == "NOT_RUN"


def test_counts_survive_a_countless_record(run):
    checksum = source_checksum(run.spark, run.site.source(AUGUST))
    run_single(run.spark, AUGUST, run.site)
    base = {"batch_id": AUGUST.batch_id, "source_checksum": checksum, "status": "SUCCESS"}
    append_records(run.spark, run.site.ledger, [base])
    assert run()["expected_records"] == 2 and len(run.transforms) == 1


def test_missing_counts_fail_without_query(run, monkeypatch):
    checksum = source_checksum(run.spark, run.site.source(AUGUST))
    record = {"batch_id": AUGUST.batch_id, "source_checksum": checksum, "status": "SUCCESS"}
    append_records(run.spark, run.site.ledger, [record])
    monkeypatch.setattr(publish, "is_published", lambda *_: True)
    monkeypatch.setattr(series, "count_partition", lambda *_: pytest.fail("queried"))
    with pytest.raises(RuntimeError, match="holds its counts"):
        run()
    assert run.records()[-1]["reconciliation_status"] == "FAILED" and not run.transforms


def test_single_run(run):
    record = run_single(run.spark, AUGUST, run.site)
    assert record["status"] == "SUCCESS" and record["rows_read"] == 3
    assert run.spark.read.parquet(f"{run.work}/{AUGUST.curated_output}").count() == 2
    assert not files.exists(run.spark, run.site.lake.curated(AUGUST))
    assert run_single(run.spark, AUGUST, run.site) is None
    assert len(run.records()) == 1


def test_single_run_failures(run):
    bad = run.spark.range(3)
    bad.write.mode("overwrite").parquet(run.site.source(AUGUST))
    with pytest.raises(ValueError, match="missing required columns"):
        run_single(run.spark, AUGUST, run.site)
    (record,) = run.records()
    assert record["status"] == "FAILED" and "missing required columns" in record["error"]
    files.remove(run.spark, run.site.source(AUGUST))
    with pytest.raises(FileNotFoundError):
        run_single(run.spark, AUGUST, run.site)
    assert len(run.records()) == 1  # a missing source is no run


MONTHS = [Batch("yellow_taxi", "yellow_tripdata", 2025, month) for month in range(1, 6)]


@pytest.mark.parametrize("parallel", [1, 3])
def test_series(run, parallel):
    for batch in MONTHS:
        run.store(batch, THREE_TRIPS[: 1 + batch.month % 3])
    records = run_series(run.spark, MONTHS, run.site, parallel)
    assert [record["batch_id"] for record in records] == [batch.batch_id for batch in MONTHS]
    assert {record["reconciliation_status"] for record in records} == {"MATCH"}
    assert len(run.records()) == 5
    again = run_series(run.spark, MONTHS, run.site, parallel)
    assert {record["processing_status"] for record in again} == {"SKIPPED_ALREADY_PROCESSED"}
    assert len(run.transforms) == 5


def test_first_failure_stops_the_series(run):
    for batch in MONTHS:
        if batch.month != 3:
            run.store(batch)
    with pytest.raises(FileNotFoundError):
        run_series(run.spark, MONTHS, run.site)
    statuses = {row["batch_id"][-2:]: row["status"] for row in run.records()}
    assert statuses == {"01": "SUCCESS", "02": "SUCCESS", "03": "FAILED"}
