import json

import pytest
from trip_rows import SOURCE, THREE_TRIPS, source_row, write_source

from sievelake.plans.batch_run import run_batch


def run(spark, tmp_path, source, **options):
    outputs = [str(tmp_path / name) for name in ("curated", "quarantine", "metrics")]
    summary = run_batch(
        spark, source, "yellow_tripdata_2025-08.parquet", "yellow_taxi_2025_08_test", "1.0", *outputs, **options
    )
    return summary, *outputs


def metrics_json(path):
    lines = [line for part in path.glob("part-*.json") for line in part.read_text().splitlines()]
    return [json.loads(line) for line in lines]


def test_three_trips(spark, tmp_path):
    source = write_source(spark, str(tmp_path / "source"))
    summary, curated, quarantine, _ = run(spark, tmp_path, source)
    assert summary == {"rows_read": 3, "valid_records": 1, "warning_records": 1, "quarantined_records": 1}

    rows = spark.read.parquet(curated).collect()
    assert {row["validation_status"] for row in rows} == {"VALID", "WARNING"}
    assert {row["batch_id"] for row in rows} == {"yellow_taxi_2025_08_test"}
    held = spark.read.parquet(quarantine).collect()
    assert [row["quarantine_reasons"] for row in held] == [["NEGATIVE_TRIP_DISTANCE"]]
    assert held[0]["source_file"] == "yellow_tripdata_2025-08.parquet"

    (metrics,) = metrics_json(tmp_path / "metrics")
    assert metrics == {
        "total_records": 3, "valid_records": 1, "warning_records": 1, "quarantined_records": 1,
        "quality_pass_rate": 66.6667, "quarantine_rate": 33.3333,
    }


def test_curated_columns_are_the_table_columns(spark, tmp_path):
    from sievelake.profiles import ADDED_COLUMNS, TRIPS

    source = write_source(spark, str(tmp_path / "source"))
    _, curated, *_ = run(spark, tmp_path, source, cast=True)
    found = spark.read.parquet(curated).dtypes
    assert found == [(name, kind.lower()) for name, kind in TRIPS.columns + ADDED_COLUMNS]


def test_empty_batch(spark, tmp_path):
    source = write_source(spark, str(tmp_path / "source"), [])
    summary, curated, quarantine, _ = run(spark, tmp_path, source)
    assert set(summary.values()) == {0}
    assert spark.read.parquet(curated).count() == spark.read.parquet(quarantine).count() == 0
    assert metrics_json(tmp_path / "metrics") == [{"total_records": 0}]


def test_nothing_quarantined_leaves_a_readable_empty_output(spark, tmp_path):
    source = write_source(spark, str(tmp_path / "source"), THREE_TRIPS[:2])
    _, curated, quarantine, _ = run(spark, tmp_path, source)
    held = spark.read.parquet(quarantine)
    assert held.count() == 0 and held.dtypes == spark.read.parquet(curated).dtypes
    assert (tmp_path / "quarantine" / "_SUCCESS").exists()


def test_rerun_replaces_all_outputs(spark, tmp_path):
    run(spark, tmp_path, write_source(spark, str(tmp_path / "source")))
    smaller = write_source(spark, str(tmp_path / "other"), THREE_TRIPS[:1])
    _, curated, quarantine, _ = run(spark, tmp_path, smaller)
    assert spark.read.parquet(curated).count() == 1
    assert spark.read.parquet(quarantine).count() == 0


def test_many_files_are_counted_once(spark, tmp_path):
    rows = [source_row("10:00", "10:20", float(i % 3 - 1), 1.0, 1.0) for i in range(300)]
    source = str(tmp_path / "source")
    spark.createDataFrame(rows, SOURCE).repartition(7).write.parquet(source)
    summary, *_ = run(spark, tmp_path, source)
    assert summary == {
        "rows_read": 300, "valid_records": 100, "warning_records": 100, "quarantined_records": 100
    }


def test_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run(spark, tmp_path, str(tmp_path / "absent"))
