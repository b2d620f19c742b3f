"""Snapshots of a ledger answer as the whole ledger does."""

import random
import threading
import uuid

import pytest

from sievelake.operators import ledger as ledgers
from sievelake.sinks import files
from sievelake.sources.ledger import append_records, compact_ledger, read_ledger
from sievelake.sources.ledger_state import (
    completed_keys,
    fold_ledger,
    latest_counts,
    ledger_state,
    unfolded,
)


def records(rng, n):
    out = []
    for _ in range(n):
        counted = rng.random() < 0.7
        record = {
            "run_id": str(uuid.UUID(int=rng.getrandbits(128))),
            "batch_id": f"b{rng.randrange(6)}",
            "source_checksum": f"c{rng.randrange(3)}",
            "status": rng.choice(["SUCCESS", "FAILED", "STARTED"]),
            "processing_status": rng.choice(["SUCCESS", "SKIPPED_ALREADY_PROCESSED", None]),
            "reconciliation_status": rng.choice(["MATCH", "MISMATCH", "FAILED", "NOT_RUN"]),
            "completed_at": rng.choice([None, f"2025-01-{rng.randint(1, 28):02d}T00:00:00+00:00"]),
        }
        if counted:
            record |= {"rows_read": rng.randrange(9), "valid_records": rng.randrange(9), "warning_records": 1, "quarantined_records": 0}
        out.append(record)
    return out


def answers(spark, path, trust, state=True):
    if state:
        held = ledger_state(spark, path)
        done, counts = completed_keys(held, trust), latest_counts(held, trust)
    else:
        held = read_ledger(spark, path)
        done, counts = ledgers.completed_keys(held, trust), ledgers.latest_counts(held, trust)
    return sorted(map(tuple, done.collect())), sorted(map(tuple, counts.collect()), key=str)


@pytest.mark.parametrize("trust", [False, True])
def test_state_is_that_of_the_whole_ledger_at_every_step(spark, tmp_path, trust):
    rng, path = random.Random(7), str(tmp_path / "ledger")
    assert answers(spark, path, trust) == ([], [])
    for step in range(8):
        append_records(spark, path, records(rng, 9))
        want = answers(spark, path, trust, state=False)
        assert answers(spark, path, trust) == want
        if step in (2, 3, 6):
            assert fold_ledger(spark, path) and unfolded(spark, path) == 0
            assert answers(spark, path, trust) == want
        if step == 5:
            compact_ledger(spark, path)
            assert answers(spark, path, trust) == want and answers(spark, path, trust, state=False) == want
    some = ledger_state(spark, path, ["b1", "b4"])
    assert {r["batch_id"] for r in some.collect()} <= {"b1", "b4"}


def test_folding_beside_writers_loses_no_run(spark, tmp_path):
    path, rng = str(tmp_path / "ledger"), random.Random(3)
    append_records(spark, path, records(rng, 5))

    def write():
        for i in range(6):
            append_records(spark, path, [{"batch_id": f"w{i}", "source_checksum": "c", "status": "SUCCESS"}])

    writer = threading.Thread(target=write)
    writer.start()
    for _ in range(4):
        fold_ledger(spark, path)
    writer.join()
    fold_ledger(spark, path)
    assert {r["batch_id"] for r in completed_keys(ledger_state(spark, path)).collect()} >= {f"w{i}" for i in range(6)}
    assert unfolded(spark, path) == 0 and fold_ledger(spark, path) is None
    assert len(files.children(spark, f"{path}/_snapshots")) <= 2


def test_a_fold_that_was_cut_short_does_not_count(spark, tmp_path):
    path = str(tmp_path / "ledger")
    append_records(spark, path, [{"batch_id": "b", "source_checksum": "c", "status": "SUCCESS"}])
    folder = fold_ledger(spark, path)
    files.remove(spark, f"{folder}/_COMPLETE")
    files.remove(spark, f"{folder}/state")
    assert unfolded(spark, path) == 1 and completed_keys(ledger_state(spark, path)).count() == 1
    # an append under way is read, and not taken for folded
    (run,) = [c for c in files.children(spark, path) if "run=" in c]
    files.remove(spark, f"{run}/_SUCCESS")
    assert fold_ledger(spark, path) is None and completed_keys(ledger_state(spark, path)).count() == 1


def test_compaction_is_dealt_over_tasks_and_keeps_the_order(spark, tmp_path):
    path = str(tmp_path / "ledger")
    for i in range(60):
        record = {"batch_id": "b", "source_checksum": "c", "status": "SUCCESS", "valid_records": i, "warning_records": 0}
        append_records(spark, path, [record | ({"completed_at": "2025-01-01T00:00:00+00:00"} if i > 40 else {})])
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        for _ in range(2):
            compact_ledger(spark, path)
            (run,) = [c for c in files.children(spark, path) if "run=" in c]
            assert len([f for f in files.children(spark, run) if f.endswith(".json")]) > 3
            order = [r["valid_records"] for r in read_ledger(spark, path).orderBy("seq").collect()]
            assert order == list(range(60))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    append_records(spark, path, [{"batch_id": "b", "source_checksum": "c", "status": "SUCCESS", "valid_records": 99, "warning_records": 0, "completed_at": "2025-01-01T00:00:00+00:00"}])
    assert read_ledger(spark, path).orderBy("seq").collect()[-1]["valid_records"] == 99
