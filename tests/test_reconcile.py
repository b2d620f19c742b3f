import pytest
from pyspark.sql import functions as F

from sievelake.operators.reconcile import outcome, reconcile


def test_comparison(spark):
    expected = spark.createDataFrame(
        [(2025, 7, 10), (2025, 8, 3574089), (2025, 9, 0)], "year INT, month INT, expected_records BIGINT"
    )
    counts = spark.createDataFrame(
        [(2025, 8, 3574000), (2025, 10, 4), (2025, 7, 10)], "year INT, month INT, published_records BIGINT"
    )
    found = {row["month"]: tuple(row)[2:] for row in reconcile(expected, counts).collect()}
    assert found == {
        7: (10, 10, 0, "MATCH"),
        8: (3574089, 3574000, -89, "MISMATCH"),
        9: (0, 0, 0, "MATCH"),  # an empty batch has no rows to show
        10: (0, 4, 4, "MISMATCH"),
    }


@pytest.mark.parametrize(
    "enabled, partition, failed, compared, status",
    [
        (True, "CREATED", False, "MATCH", "MATCH"),
        (True, "EXISTS", False, "MISMATCH", "MISMATCH"),
        (True, "EXISTS", True, None, "FAILED"),
        (False, "EXISTS", False, "MATCH", "DISABLED"),
        (True, "DISABLED", False, None, "DISABLED"),
        (True, "FAILED", True, None, "DISABLED"),
        (True, None, False, None, "DISABLED"),
    ],
)
def test_outcome(spark, enabled, partition, failed, compared, status):
    text = lambda value: F.lit(value).cast("string")
    column = outcome(F.lit(enabled), text(partition), F.lit(failed), text(compared))
    assert spark.range(1).select(column).first()[0] == status
