import uuid

import pytest
from trip_rows import THREE_TRIPS, write_source

from sievelake.batch import Batch, Lake
from sievelake.operators.reconcile import count_partition, count_query, partition_counts
from sievelake.plans.batch_run import run_batch
from sievelake.profiles import ADDED_COLUMNS, TRIPS
from sievelake.sinks import catalog

AUGUST = Batch("yellow_taxi", "yellow_tripdata", 2025, 8)
JULY = Batch("yellow_taxi", "yellow_tripdata", 2025, 7)


@pytest.fixture
def site(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for batch, rows in ((AUGUST, THREE_TRIPS), (JULY, THREE_TRIPS[:1])):
        source = write_source(spark, str(tmp_path / batch.source_file), rows)
        outputs = lake.curated(batch), lake.quarantine(batch), lake.metrics(batch)
        run_batch(spark, source, batch.source_file, batch.batch_id, "1.0", *outputs, cast=True)
    table = f"t_{uuid.uuid4().hex}"
    catalog.create_table(spark, table, lake.curated_root("yellow_taxi"))
    yield lake, table
    spark.sql(f"DROP TABLE {table}")


def test_values_and_location(spark, site):
    lake, _ = site
    assert catalog.partition_values(AUGUST) == ["2025", "08"]
    location = catalog.expected_location(spark, lake, AUGUST)
    assert location.startswith("file:/") and location.endswith("/curated/yellow_taxi/year=2025/month=08")


def test_table_columns(spark, site):
    _, table = site
    wanted = [(name, kind.lower()) for name, kind in TRIPS.columns + ADDED_COLUMNS]
    assert spark.table(table).dtypes == wanted + [("year", "int"), ("month", "int")]


def test_create_table_twice_is_harmless(spark, site):
    lake, table = site
    catalog.create_table(spark, table, lake.curated_root("yellow_taxi"))


def test_only_registered_partitions_are_visible(spark, site):
    lake, table = site
    assert spark.table(table).count() == 0
    assert not catalog.partition_exists(spark, table, AUGUST)
    assert catalog.registered_location(spark, table, AUGUST) is None
    assert catalog.register_partition(spark, table, lake, AUGUST) is True
    assert spark.table(table).count() == 2
    assert catalog.partition_is_correct(spark, table, lake, AUGUST)
    assert not catalog.partition_is_correct(spark, table, lake, JULY)


def test_registering_again_changes_nothing(spark, site):
    lake, table = site
    assert catalog.register_partitions(spark, table, lake, [AUGUST, JULY]) == {AUGUST: True, JULY: True}
    assert catalog.register_partitions(spark, table, lake, [AUGUST, JULY]) == {AUGUST: False, JULY: False}


def test_wrong_location_is_repaired(spark, site):
    lake, table = site
    wrong = f"{lake.root}/curated/year=2025/month=8"
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (year=2025, month=8) LOCATION '{wrong}'")
    assert catalog.partition_exists(spark, table, AUGUST)
    assert not catalog.partition_is_correct(spark, table, lake, AUGUST)
    assert catalog.register_partition(spark, table, lake, AUGUST) is True
    assert catalog.partition_is_correct(spark, table, lake, AUGUST)
    assert spark.table(table).count() == 2


def test_missing_table_is_an_error(spark, site):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        catalog.register_partition(spark, "no_such_table", site[0], AUGUST)


def test_status_names():
    assert [catalog.partition_status(c) for c in (None, True, False)] == ["DISABLED", "CREATED", "EXISTS"]


def test_partition_counts(spark, site):
    lake, table = site
    catalog.register_partitions(spark, table, lake, [AUGUST, JULY])
    assert count_partition(spark, table, 2025, 8) == 2
    assert count_partition(spark, table, 2025, 12) == 0
    assert {tuple(row) for row in partition_counts(spark.table(table)).collect()} == {(2025, 8, 2), (2025, 7, 1)}


def test_count_reads_one_partition_and_no_column(spark, site):
    lake, table = site
    catalog.register_partitions(spark, table, lake, [AUGUST, JULY])
    query = count_query(table, 2025, 8)
    assert query == f"SELECT COUNT(*) AS record_count FROM {table} WHERE year = 2025 AND month = 8"
    plan = spark.sql(query)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<>" in plan


def test_stray_dates_stay_in_their_batch(spark, tmp_path):
    """Partition values come from the batch: these trips are of August, the batch is of July."""
    lake = Lake(str(tmp_path / "lake"))
    source = write_source(spark, str(tmp_path / "source"))
    outputs = lake.curated(JULY), lake.quarantine(JULY), lake.metrics(JULY)
    run_batch(spark, source, JULY.source_file, JULY.batch_id, "1.0", *outputs)
    found = spark.read.parquet(lake.curated_root("yellow_taxi")).select("year", "month").distinct().collect()
    assert [tuple(row) for row in found] == [(2025, 7)]


def counted(spark, table):
    rows = partition_counts(spark.table(table)).collect()
    return {(row["year"], row["month"]): row["published_records"] for row in rows}


def test_partitions_found_by_repair_are_known_whatever_their_spelling(spark, site):
    lake, table = site
    spark.sql(f"MSCK REPAIR TABLE {table}")
    assert [v for v, _ in catalog.listed_partitions(spark, table)[2025, 8]] == [("2025", "08")]
    assert catalog.register_partitions(spark, table, lake, [AUGUST, JULY]) == {AUGUST: False, JULY: False}
    assert counted(spark, table) == {(2025, 7): 1, (2025, 8): 2}
    assert catalog.partition_is_correct(spark, table, lake, AUGUST)


def test_a_doubled_partition_is_registered_once(spark, site):
    lake, table = site
    spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (year=2025, month=8) LOCATION '{lake.curated(AUGUST)}'")
    assert counted(spark, table)[2025, 8] == 4
    assert not catalog.partition_is_correct(spark, table, lake, AUGUST)
    assert catalog.register_partitions(spark, table, lake, [AUGUST, JULY]) == {AUGUST: True, JULY: False}
    assert counted(spark, table) == {(2025, 7): 1, (2025, 8): 2}


def test_a_partition_spelled_with_zero_and_misplaced_is_repaired(spark, site):
    lake, table = site
    spark.sql(f"MSCK REPAIR TABLE {table}")
    moved = Lake(lake.root + "/elsewhere")
    assert catalog.register_partition(spark, table, moved, AUGUST) is True
    assert catalog.registered_location(spark, table, AUGUST) == catalog.expected_location(spark, moved, AUGUST)
    assert counted(spark, table) == {(2025, 7): 1}
