"""Digests of multisets of rows."""

import pytest
from pyspark.sql import functions as F
from test_load import DDL, rows

from sievelake.checks.queries import _largest_rows
from sievelake.operators.content import content_digests, reconcile_content
from sievelake.plans.load import classified_batches


def table(spark, data):
    return classified_batches(spark.createDataFrame(data, DDL), "d", "p")


def status(expected, found):
    compared = reconcile_content(content_digests(expected), content_digests(found)).collect()
    return {r["month"]: (r["expected_records"], r["published_records"], r["reconciliation_status"]) for r in compared}


def test_order_types_stamps_and_absent_columns_do_not_matter(spark):
    one = table(spark, rows(1, 3, 2) + rows(2, 4))
    other = one.orderBy(F.desc("trip_distance")).repartition(5).withColumn("ingested_at", F.lit("later"))
    other = other.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
    assert set(v[2] for v in status(one, other).values()) == {"MATCH"}
    none = one.withColumn("extra", F.lit(None).cast("double"))
    assert set(v[2] for v in status(none, one.drop("extra")).values()) == {"MATCH"}


@pytest.mark.parametrize(
    "change",
    [
        lambda t: t.withColumn("tip_amount", F.when(F.col("month") == 1, F.col("tip_amount") + 1).otherwise(F.col("tip_amount"))),
        lambda t: t.withColumn("extra", F.when(F.col("month") == 2, F.col("extra"))),
        lambda t: t.withColumns({"extra": F.when(F.col("month") == 2, F.col("tolls_amount")).otherwise(F.col("extra")), "tolls_amount": F.when(F.col("month") == 2, F.col("extra")).otherwise(F.col("tolls_amount"))}),
    ],
)
def test_changed_moved_and_lost_values_show(spark, change):
    one = table(spark, rows(1, 3, 2) + rows(2, 4))
    assert sorted(v[2] for v in status(one, change(one)).values()) == ["CONTENT_MISMATCH", "MATCH"]


def test_repeated_rows_count_as_often_as_they_are(spark):
    one, other = table(spark, rows(1, 4, 2)), table(spark, rows(1, 2, 4))
    assert status(one, other) == {1: (6, 6, "CONTENT_MISMATCH")}
    assert status(table(spark, rows(1, 2)), table(spark, rows(1, 4))) == {1: (2, 4, "COUNT_MISMATCH")}


def test_lost_and_unexpected_partitions_show(spark):
    one, other = table(spark, rows(1, 2)), table(spark, rows(2, 3))
    assert status(one, other) == {1: (2, 0, "COUNT_MISMATCH"), 2: (0, 3, "COUNT_MISMATCH")}


def test_a_hot_partition_sends_one_row_per_task(spark):
    plan = content_digests(table(spark, rows(1, 2)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("HashAggregate") == 2


def test_largest_row_of_a_batch_is_that_of_whole_rows_compared(spark):
    made = [(1, 5, None, 2020, 1), (None, 9, "z", 2020, 1), (1, 5, "b", 2020, 1), (1, None, "c", 2020, 1), (1, 5, "b", 2020, 1)]
    made += [(2, None, "x", 2020, 4), (2, None, None, 2020, 4), (1, 7, "y", 2020, 4), (None, None, None, 2021, 4), (None, None, "a", 2021, 4)]
    held = spark.createDataFrame(made, "vendor_id INT, at BIGINT, name STRING, year INT, month INT").repartition(3)
    found = {(r["year"], r["month"]): tuple(r["row"]) for r in _largest_rows(held).collect()}
    plain = held.groupBy("year", "month").agg(F.max(F.struct("vendor_id", "at", "name")).alias("row")).collect()
    assert found == {(r["year"], r["month"]): tuple(r["row"]) for r in plain}
    assert found == {(2020, 1): (1, 5, "b"), (2020, 4): (2, None, "x"), (2021, 4): (None, None, "a")}


def test_a_task_does_not_sort_all_its_rows_for_the_largest(spark):
    """What is sorted by batch comes out of a join with the tops or, for the tops, of maxima by hash."""
    held = spark.createDataFrame([(1, i, "n", 2020, 1) for i in range(1000)], "vendor_id INT, at BIGINT, name STRING, year INT, month INT")
    lines = _largest_rows(held)._jdf.queryExecution().executedPlan().toString().splitlines()
    few, all_rows = ("HashAggregate", "BroadcastHashJoin"), "Scan"
    sorts = [i for i, line in enumerate(lines) if "Sort [" in line]
    first_below = [next(x for x in lines[i:] if all_rows in x or any(f in x for f in few)) for i in sorts]
    assert first_below and not [x for x in first_below if all_rows in x]
