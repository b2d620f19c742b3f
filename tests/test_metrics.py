import pytest
from trip_rows import CANONICAL

from sievelake.operators import metrics
from sievelake.operators.classify import classify
from sievelake.sources.history import read_history

# Published counts of eight monthly batches.
HISTORY = """month,source_records,valid_records,warning_records,quarantined_records,curated_records,athena_records
Jan 2025,3475226,3254325,220777,124,3475102,3475102
Feb 2025,3577543,3311301,266149,93,3577450,3577450
Mar 2025,4145257,3849234,295942,81,4145176,4145176
Apr 2025,3970553,3706555,263835,163,3970390,3970390
May 2025,4591845,4156134,435610,101,4591744,4591744
Jun 2025,4322960,3936782,385947,231,4322729,4322729
Jul 2025,3898963,3550120,348842,1,3898962,3898962
Aug 2025,3574091,3227851,346238,2,3574089,3574089
"""


@pytest.fixture
def history(spark, tmp_path):
    path = tmp_path / "history.csv"
    path.write_text(HISTORY)
    return read_history(spark, str(path))


def statuses(spark, *counts):
    rows = [(s,) for s, n in zip(("VALID", "WARNING", "QUARANTINE"), counts) for _ in range(n)]
    return spark.createDataFrame(rows, "validation_status STRING")


def test_counts_and_rates(spark):
    row = metrics.quality_metrics(statuses(spark, 5, 1, 1)).first()
    assert row[:4] == (7, 5, 1, 1)
    assert row["quality_pass_rate"] == 85.7143 and row["quarantine_rate"] == 14.2857


def test_rounding_is_half_up(spark):
    # 1 of 16 in percent is 6.25; 1 of 80000 is 0.00125, a tie at four digits.
    df = spark.createDataFrame([(80000, 79999, 0, 1)],
                               "total_records BIGINT, valid_records BIGINT, warning_records BIGINT, "
                               "quarantined_records BIGINT")
    row = metrics.with_rates(df).first()
    assert row["quarantine_rate"] == 0.0013 and row["quality_pass_rate"] == 99.9988


def test_empty_batch(spark):
    empty = metrics.quality_metrics(classify(spark.createDataFrame([], CANONICAL)))
    assert empty.first()[:] == (0, None, None, None, None, None)
    assert metrics.batch_summary(empty).first()[:] == (0, 0, 0, 0)


def test_status_report_is_ordered(spark):
    rows = metrics.status_counts(statuses(spark, 3, 2, 1)).collect()
    assert [tuple(row) for row in rows] == [("QUARANTINE", 1), ("VALID", 3), ("WARNING", 2)]


def test_absent_statuses_count_zero(spark):
    summary = metrics.batch_summary(metrics.quality_metrics(statuses(spark, 0, 2, 0))).first()
    assert summary.asDict() == {
        "rows_read": 2, "valid_records": 0, "warning_records": 2, "quarantined_records": 0
    }


def test_history_totals(history):
    row = metrics.history_totals(history).first()
    assert row["total_source_records"] == 31_556_438
    assert row["total_curated_records"] == 31_555_642
    assert (row["total_valid_records"], row["total_warning_records"]) == (28_992_302, 2_563_340)
    assert row["total_quarantined_records"] == 796
    assert round(row["overall_pass_rate"], 4) == 99.9975


def test_history_pass_rates(history):
    rates = [row["quality_pass_rate"] for row in metrics.history_pass_rates(history).collect()]
    assert rates == [99.9964, 99.9974, 99.998, 99.9959, 99.9978, 99.9947, 100.0, 99.9999]


def test_history_checks_pass(history):
    checks = dict(metrics.history_checks(history, 8).collect())
    assert len(checks) == 5 and all(checks.values())
    assert not dict(metrics.history_checks(history, 9).collect())["expected_batch_count"]


@pytest.mark.parametrize(
    "change, check",
    [
        ("source_records + 1 AS source_records", "source_is_curated_plus_quarantined"),
        ("valid_records - 1 AS valid_records", "curated_is_valid_plus_warning"),
        ("athena_records + 1 AS athena_records", "published_is_curated"),
        ("-warning_records AS warning_records", "counts_not_negative"),
        ("CAST(NULL AS BIGINT) AS athena_records", "published_is_curated"),
        ("CAST(NULL AS BIGINT) AS athena_records", "counts_not_negative"),
    ],
)
def test_one_bad_month_fails_its_check(history, change, check):
    name = change.rsplit(" ", 1)[1]
    others = [column for column in history.columns if column != name]
    bad = history.where("month = 'May 2025'").selectExpr(*others, change)
    mixed = history.where("month <> 'May 2025'").unionByName(bad)
    assert not dict(metrics.history_checks(mixed, 8).collect())[check]
