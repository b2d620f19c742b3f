import json

import pytest

from sievelake.operators import ledger as ledgers
from sievelake.sources.ledger import append_records, read_ledger

KEY = "batch_id STRING, source_checksum STRING"


def write_lines(path, *records):
    path.write_text("\n\n".join(json.dumps(record) for record in records) + "\n\n")
    return str(path)


def done(spark, path, batch="b", checksum="c", **options):
    asked = spark.createDataFrame([(batch, checksum)], KEY)
    return not ledgers.skipped(asked, read_ledger(spark, path), **options).isEmpty()


def test_missing_ledger_is_empty(spark, tmp_path):
    assert read_ledger(spark, str(tmp_path / "absent")).isEmpty()
    assert not done(spark, str(tmp_path / "absent"))


@pytest.mark.parametrize(
    "record, completed",
    [
        ({"status": "SUCCESS"}, True),
        ({"status": "FAILED"}, False),
        ({"status": "STARTED"}, False),
        ({}, False),
        ({"status": "FAILED", "processing_status": "SUCCESS", "reconciliation_status": "MISMATCH"}, True),
        ({"status": "FAILED", "processing_status": "SUCCESS", "reconciliation_status": "FAILED"}, True),
        ({"status": "FAILED", "processing_status": "SUCCESS", "reconciliation_status": "NOT_RUN"}, False),
        ({"status": "FAILED", "reconciliation_status": "MISMATCH"}, False),
        ({"processing_status": "SKIPPED_ALREADY_PROCESSED", "reconciliation_status": "FAILED"}, True),
    ],
)
def test_completed_runs(spark, tmp_path, record, completed):
    path = write_lines(tmp_path / "ledger.jsonl", {"batch_id": "b", "source_checksum": "c", **record})
    assert done(spark, path) is completed


def test_opt_in_trusts_the_transform(spark, tmp_path):
    record = {"status": "FAILED", "processing_status": "SUCCESS", "reconciliation_status": "NOT_RUN"}
    path = write_lines(tmp_path / "ledger.jsonl", {"batch_id": "b", "source_checksum": "c", **record})
    assert not done(spark, path)
    assert done(spark, path, trust_processing_status=True)


def test_other_batches_and_contents_do_not_count(spark, tmp_path):
    path = write_lines(tmp_path / "l.jsonl", {"batch_id": "b", "source_checksum": "c", "status": "SUCCESS"})
    assert not done(spark, path, checksum="other")
    assert not done(spark, path, batch="other")


def test_pending_and_skipped_split_the_batches(spark, tmp_path):
    path = write_lines(
        tmp_path / "l.jsonl",
        *[{"batch_id": "a", "source_checksum": "1", "status": "SUCCESS"}] * 3,
        {"batch_id": "b", "source_checksum": "old", "status": "SUCCESS"},
    )
    asked = spark.createDataFrame([("a", "1"), ("b", "new"), ("c", "1")], KEY)
    log = read_ledger(spark, path)
    assert [row["batch_id"] for row in ledgers.skipped(asked, log).collect()] == ["a"]
    assert sorted(row["batch_id"] for row in ledgers.pending(asked, log).collect()) == ["b", "c"]


def run(valid, **fields):
    base = {"batch_id": "b", "source_checksum": "c", "status": "SUCCESS", "warning_records": 0}
    return {**base, "valid_records": valid, **fields}


def counts(spark, path):
    return [row["valid_records"] for row in ledgers.latest_counts(read_ledger(spark, path)).collect()]


def test_latest_counts_follow_completion_not_place(spark, tmp_path):
    path = write_lines(
        tmp_path / "l.jsonl",
        run(2, completed_at="2025-08-02T00:00:00+00:00"),
        run(3, completed_at="2025-08-02T00:00:00.5+00:00"),
        run(1, completed_at="2025-08-01T00:00:00+00:00"),
    )
    assert counts(spark, path) == [3]


def test_latest_counts_of_records_without_time_follow_the_file(spark, tmp_path):
    path = write_lines(tmp_path / "l.jsonl", *[run(i) for i in range(200)])
    assert counts(spark, path) == [199]
    timed = run(7, completed_at="2025-08-01T00:00:00+00:00")
    assert counts(spark, write_lines(tmp_path / "m.jsonl", timed, run(8))) == [7]


def test_records_without_counts_are_passed_over(spark, tmp_path):
    countless = {"batch_id": "b", "source_checksum": "c", "status": "SUCCESS"}
    failed = run(5, status="FAILED")
    assert counts(spark, write_lines(tmp_path / "l.jsonl", run(8), countless, failed)) == [8]
    assert counts(spark, write_lines(tmp_path / "m.jsonl", countless)) == []


def test_append_keeps_earlier_records(spark, tmp_path):
    path = str(tmp_path / "ledger")
    for number in range(3):
        append_records(spark, path, [{"run_id": str(number), "batch_id": "b", "difference": None}])
    assert sorted(row["run_id"] for row in read_ledger(spark, path).collect()) == ["0", "1", "2"]
    lines = [line for part in (tmp_path / "ledger").glob("run=*/part-*") for line in part.read_text().splitlines()]
    assert {"run_id": "0", "batch_id": "b"} in [json.loads(line) for line in lines]


def test_unknown_field_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="colour"):
        append_records(spark, str(tmp_path / "ledger"), [{"run_id": "1", "colour": "red"}])


def test_damaged_line_raises(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"batch_id": "b"}\n{"batch_id": \n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|Malformed"):
        read_ledger(spark, str(tmp_path / "l.jsonl")).collect()


@pytest.mark.parametrize(
    "publish, partition, reconciled, kept",
    [
        ("EXISTS", "EXISTS", "DISABLED", False),
        ("BACKFILLED", "EXISTS", "DISABLED", True),
        ("EXISTS", "CREATED", "DISABLED", True),
        ("EXISTS", "EXISTS", "MATCH", True),
        (None, "EXISTS", None, False),
    ],
)
def test_reruns_worth_a_record(spark, publish, partition, reconciled, kept):
    ddl = "s3_publish_status STRING, glue_partition_status STRING, reconciliation_status STRING"
    outcomes = spark.createDataFrame([(publish, partition, reconciled)], ddl)
    assert ledgers.rerun_records(outcomes).count() == int(kept)


def test_hot_batch_is_combined_before_the_join(spark, tmp_path):
    """A third of a long ledger belongs to one batch: the join must see one row for it."""
    path = str(tmp_path / "hot")
    spark.range(9000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('b', id)) AS batch_id", "'c' AS source_checksum",
        "'SUCCESS' AS status", "id AS valid_records", "0L AS warning_records",
        "cast(timestamp_seconds(id) AS string) AS completed_at",
    ).write.json(path)
    log = read_ledger(spark, path)
    keys = ledgers.completed_keys(log)
    assert keys.where("batch_id = 'hot'").count() == 1
    best = ledgers.latest_counts(log).where("batch_id = 'hot'").first()
    assert best["valid_records"] == 8997
    plan = ledgers.latest_counts(log)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_writers_that_do_not_know_each_other_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from sievelake.sources.ledger import append_records, compact_ledger, read_ledger

    path = str(tmp_path / "ledger")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: append_records(spark, path, [{"run_id": str(i), "status": "SUCCESS"}]), range(16)))
    assert sorted(int(row["run_id"]) for row in read_ledger(spark, path).collect()) == list(range(16))
    compact_ledger(spark, path)
    assert len(list((tmp_path / "ledger").iterdir())) == 1
    assert sorted(int(row["run_id"]) for row in read_ledger(spark, path).collect()) == list(range(16))


def test_flat_files_of_a_ledger_are_read(spark, tmp_path):
    from sievelake.sources.ledger import append_records, read_ledger

    path = tmp_path / "ledger"
    append_records(spark, str(path), [{"run_id": "new", "status": "SUCCESS"}])
    (path / "old.json").write_text('{"run_id": "old", "status": "FAILED"}\n')
    assert {row["run_id"] for row in read_ledger(spark, str(path)).collect()} == {"old", "new"}
