import uuid
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from trip_rows import SOURCE, THREE_TRIPS, source_row

from sievelake.batch import Batch, Lake
from sievelake.plans.load import classified_batches, load_batches, of_batches
from sievelake.session import SETTINGS, tune
from sievelake.sinks import files, publish
from sievelake.sinks.outputs import read_curated, write_batches

DDL = f"{SOURCE}, year INT, month INT"


def rows(month, valid=0, warning=0, quarantined=0):
    made = []
    for distance, number in ((1.0, valid), (0.0, warning), (-1.0, quarantined)):
        made += [(*source_row("10:00", "10:20", distance, 1.0, 1.0), 2025, month)] * number
    return made


def load(spark, lake, data, clustered=False):
    return write_batches(classified_batches(spark.createDataFrame(data, DDL), "d", "p"), lake, "d", clustered)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def per_month(df, column):
    return Counter(row[0] for row in df.select(column).collect())


@pytest.mark.parametrize("clustered", [False, True])
def test_layout_and_content(spark, lake, clustered):
    counts = load(spark, lake, rows(1, 3, 1, 2) + rows(2, 0, 0, 4) + rows(10, 5), clustered)
    assert {c["month"]: (c["valid_records"], c["quarantined_records"]) for c in counts} == {
        1: (3, 2), 2: (0, 4), 10: (5, 0)
    }
    assert per_month(read_curated(spark, lake, "d"), "month") == {1: 4, 10: 5}
    assert spark.read.parquet(f"{lake.root}/curated/d/year=2025/month=01").count() == 4
    held = {m: lake.quarantine(Batch("d", "p", 2025, m)) for m in (1, 2, 10)}
    assert spark.read.parquet(held[1]).count() == 2 and spark.read.parquet(held[2]).count() == 4
    metrics = spark.read.json(f"{lake.metrics_root('d')}/2025-02").first().asDict()
    assert metrics == {"total_records": 4, "valid_records": 0, "warning_records": 0, "quarantined_records": 4,
                       "quality_pass_rate": 0.0, "quarantine_rate": 100.0}
    for month in (1, 2, 10):
        batch = Batch("d", "p", 2025, month)
        assert all(files.is_complete(spark, p) for p in (lake.curated(batch), held[month], lake.metrics(batch)))


def test_loading_again_replaces_only_the_given_batches(spark, lake):
    load(spark, lake, rows(1, 3, quarantined=2) + rows(2, 3, quarantined=1) + rows(3, 7))
    load(spark, lake, rows(1, 1) + rows(2, 0, 0, 5))
    assert per_month(read_curated(spark, lake, "d"), "month") == {1: 1, 3: 7}
    assert not files.has_objects(spark, f"{lake.quarantine(Batch('d', 'p', 2025, 1))}/part-0")
    assert files.object_count(spark, lake.quarantine(Batch("d", "p", 2025, 1))) == 1  # the marker
    assert spark.read.parquet(lake.quarantine(Batch("d", "p", 2025, 2))).count() == 5
    assert files.object_count(spark, lake.curated(Batch("d", "p", 2025, 2))) == 1


def test_state_after_load(spark, lake):
    load(spark, lake, rows(1, 1))
    batch = Batch("d", "p", 2025, 1)
    publish.publish_raw(spark, lake, batch, "/data/raw", "c")
    assert publish.is_published(spark, lake, batch, "c")


def test_summary_matches_and_repeats(spark, lake):
    table = f"t_{uuid.uuid4().hex}"
    source = spark.createDataFrame(rows(1, 3, 1, 2) + rows(2, 0, 0, 4) + rows(3, 2), DDL)

    def summary():
        found = load_batches(spark, source, "d", "p", lake, table, cast=True).collect()
        return {
            r["batch_id"]: (r["partition_status"], r["expected_records"], r["reconciliation_status"])
            for r in found
        }

    assert summary() == {
        "d_2025_01": ("CREATED", 4, "MATCH"), "d_2025_02": ("CREATED", 0, "MATCH"),
        "d_2025_03": ("CREATED", 2, "MATCH"),
    }
    assert {status for status, *_ in summary().values()} == {"EXISTS"}
    spark.sql(f"DROP TABLE {table}")


def test_hot_batch_is_split_over_files(spark, lake):
    """One month holds most rows: adaptive execution writes it from several tasks, and whole."""
    start = datetime(2025, 8, 1)
    data = spark.range(60_000).selectExpr(
        "IF(id % 3 = 0, 8, CAST(id % 12 + 1 AS INT)) AS month", "2025 AS year", "1 AS VendorID",
        f"timestamp'{start}' + make_dt_interval(0, 0, 0, id) AS tpep_pickup_datetime",
        f"timestamp'{start + timedelta(days=1)}' + make_dt_interval(0, 0, 0, id) AS tpep_dropoff_datetime",
        "rand(1) AS trip_distance", "1 AS PULocationID", "1 AS DOLocationID",
        "rand(2) AS fare_amount", "rand(3) AS total_amount",
    )
    key, partition = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    before = spark.conf.get(partition)
    spark.conf.set(key, "256k")
    spark.conf.set(partition, "4")
    try:
        counts = write_batches(classified_batches(data, "d", "p"), lake, "d")
    finally:
        spark.conf.unset(key)
        spark.conf.set(partition, before)
    by_month = {row["month"]: row["total_records"] for row in counts}
    assert by_month[8] > 20_000 and sum(by_month.values()) == 60_000
    assert per_month(read_curated(spark, lake, "d"), "month") == by_month
    hot, cold = (files.object_count(spark, lake.curated(Batch("d", "p", 2025, m))) for m in (8, 9))
    assert hot > cold


def test_rows_without_a_batch_are_refused_by_name(spark, tmp_path):
    rows = spark.createDataFrame(THREE_TRIPS, SOURCE).withColumn("year", F.lit(2025)).withColumn("month", F.lit(None).cast("int"))
    with pytest.raises(ValueError, match="3 rows have no batch"):
        write_batches(classified_batches(rows, "d", "p"), Lake(str(tmp_path)), "d")


def test_a_move_that_fails_leaves_the_older_output(spark, tmp_path):
    older = tmp_path / "target"
    older.mkdir()
    (older / "data").write_text("old")
    with pytest.raises(Exception):
        files.replace_directory(spark, str(tmp_path / "absent"), str(older))
    assert [p.name for p in tmp_path.iterdir()] == ["target"] and (older / "data").read_text() == "old"


def test_file_size_is_a_parameter_and_the_session_keeps_its_own(spark, tmp_path):
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting, None)
    rows = spark.createDataFrame(THREE_TRIPS * 500, SOURCE).withColumn("year", F.lit(2025)).withColumn("month", F.lit(8))
    made = []
    for size in (2_000, 64 << 20):
        lake = Lake(str(tmp_path / str(size)))
        write_batches(classified_batches(rows.repartition(8), "d", "p"), lake, "d", file_bytes=size)
        made.append(files.object_count(spark, lake.curated(Batch("d", "p", 2025, 8))))
    assert made[0] > made[1]
    assert spark.conf.get(setting, None) == before


def test_counts_prune_by_a_predicate_a_metastore_can_evaluate(spark):
    wanted = of_batches([Batch("d", "p", 2024, 12), Batch("d", "p", 2025, 1), Batch("d", "p", 2025, 2)])
    grid = spark.sql("SELECT y AS year, m AS month FROM VALUES (2024), (2025) AS a(y), VALUES (1), (2), (12) AS b(m)")
    assert {tuple(r) for r in grid.where(wanted).collect()} == {(2024, 12), (2025, 1), (2025, 2)}
    assert "year * 100" not in str(wanted)


@pytest.mark.parametrize("months", [1, 9])
def test_the_source_is_read_once(spark, lake, months):
    """Curated rows, quarantined rows and counts of any number of batches, from one pass over the input."""
    made = [row for m in range(1, months + 1) for row in rows(m, 2, 1, 1)]
    source = spark.createDataFrame(made, DDL)
    read = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    seen = source.mapInArrow(passed, source.schema)
    counts = write_batches(classified_batches(seen, "d", "p"), lake, "d")
    assert read.value == 4 * months
    assert {(c["total_records"], c["valid_records"], c["warning_records"], c["quarantined_records"]) for c in counts} == {(4, 2, 1, 1)}


def test_nothing_staged_is_left(spark, lake):
    load(spark, lake, rows(1, 2, 1, 1) + rows(2, 1))
    names = [f.rsplit("/", 1)[1] for root in (lake.curated_root("d"), lake.quarantine_root("d"), lake.metrics_root("d")) for f in files.children(spark, root)]
    assert not [n for n in names if n.startswith("_staged")]


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def tuned(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    yield tune(spark)
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plans_of_writes(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [found.apply(i).physicalPlanDescription() for i in range(found.size())]
    return [plan for plan in plans if "WriteFiles" in plan and "sievelake_row_kind" in plan]


@pytest.mark.parametrize("clustered", [False, True])
def test_a_task_does_not_sort_its_rows_to_write_them(tuned, lake, clustered):
    """Sorted, a task would hold all its rows in memory, several times their size, and spill."""
    before = len(plans_of_writes(tuned))
    load(tuned, lake, rows(1, 3, 1, 2) + rows(2, 0, 0, 4), clustered)
    written = plans_of_writes(tuned)[before:]
    assert written and not any("Sort" in plan for plan in written)


@pytest.mark.parametrize("writers", ["2", "32"])
def test_a_task_of_more_batches_than_writers_writes_all(tuned, lake, writers):
    tuned.conf.set(WRITERS, writers)
    made = [(*source_row("10:00", "10:20", d, 1.0, 1.0), y, m) for d in (1.0, -1.0, 0.0) for m in range(1, 13) for y in (2023, 2024)]
    data = tuned.createDataFrame(made * 5, DDL).coalesce(1)
    counts = write_batches(classified_batches(data, "d", "p"), lake, "d", clustered=True)
    assert len(counts) == 24 and {(c["valid_records"], c["warning_records"], c["quarantined_records"]) for c in counts} == {(5, 5, 5)}
    assert Counter(r[:] for r in read_curated(tuned, lake, "d").select("year", "month").collect()) == {
        (y, m): 10 for m in range(1, 13) for y in (2023, 2024)
    }
    assert {tuned.read.parquet(lake.quarantine(Batch("d", "p", y, m))).count() for m in range(1, 13) for y in (2023, 2024)} == {5}
