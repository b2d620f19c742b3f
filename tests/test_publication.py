import pytest
from pyspark.sql import functions as F
from trip_rows import write_source

from sievelake.batch import Batch, Lake
from sievelake.operators.publication import object_counts, publish_action
from sievelake.plans.batch_run import run_batch
from sievelake.sinks import files, publish

AUGUST = Batch("yellow_taxi", "yellow_tripdata", 2025, 8)


@pytest.fixture
def work(spark, tmp_path):
    root = str(tmp_path / "work")
    source = write_source(spark, f"{root}/{AUGUST.input_path}")
    outputs = [f"{root}/{o}" for o in (AUGUST.curated_output, AUGUST.quarantine_output, AUGUST.metrics_output)]
    run_batch(spark, source, AUGUST.source_file, AUGUST.batch_id, "1.0", *outputs)
    return root


@pytest.fixture
def lake(spark, tmp_path, work):
    lake = Lake(str(tmp_path / "lake"))
    publish.copy_outputs(spark, lake, AUGUST, work)
    publish.publish_raw(spark, lake, AUGUST, f"{work}/{AUGUST.input_path}", "abc123")
    return lake


def test_published_copy_equals_the_outputs(spark, lake, work):
    read = spark.read.parquet
    for source, target in ((AUGUST.curated_output, lake.curated(AUGUST)),
                           (AUGUST.quarantine_output, lake.quarantine(AUGUST))):
        assert read(target).exceptAll(read(f"{work}/{source}")).isEmpty()
        assert read(target).count() == read(f"{work}/{source}").count()
    assert spark.read.json(lake.metrics(AUGUST)).collect() == spark.read.json(f"{work}/{AUGUST.metrics_output}").collect()


def test_complete(spark, lake):
    assert publish.is_published(spark, lake, AUGUST, "abc123")
    state = publish.published_batches(spark, lake, [(AUGUST, "abc123")]).first()
    assert state["raw_present"] and state["raw_matches"] and state["published"]


def test_other_content(spark, lake):
    assert not publish.is_published(spark, lake, AUGUST, "wrong-checksum")


def test_raw_unknown(spark, lake, tmp_path):
    files.remove(spark, lake.manifest(AUGUST))
    assert not publish.is_published(spark, lake, AUGUST, "abc123")
    assert not publish.is_published(spark, Lake(str(tmp_path / "nowhere")), AUGUST, "abc123")


@pytest.mark.parametrize("output", ["curated", "quarantine", "metrics"])
def test_marker_missing(spark, lake, output):
    files.remove(spark, f"{getattr(lake, output)(AUGUST)}/_SUCCESS")
    assert not publish.is_published(spark, lake, AUGUST, "abc123")


def test_publishing_again_leaves_no_stale_file(spark, lake, work):
    stale = spark.read.parquet(lake.curated(AUGUST))
    stale.write.mode("append").parquet(lake.curated(AUGUST))
    publish.copy_outputs(spark, lake, AUGUST, work)
    assert spark.read.parquet(lake.curated(AUGUST)).count() == 2


def test_summary_counts_marker_but_no_sidecars(spark, lake, tmp_path):
    summary = publish.publication_summary(spark, lake, AUGUST)
    parts = list((tmp_path / "lake/curated/yellow_taxi/year=2025/month=08").glob("part-*"))
    assert summary["curated_prefix"] == "curated/yellow_taxi/year=2025/month=08"
    assert summary["curated_object_count"] == len(parts) + 1
    assert summary["quarantine_object_count"] >= 2 and summary["quality_object_count"] == 2


def test_object_counts_of_a_whole_tree(spark, lake):
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(lake.root)
    found = object_counts(
        listing.select("path", F.col("length").alias("size_bytes")), files.qualified(spark, lake.root)
    )
    counts = {row["directory"]: row["data_files"] for row in found.collect()}
    summary = publish.publication_summary(spark, lake, AUGUST)
    assert counts["curated/yellow_taxi/year=2025/month=08"] == summary["curated_object_count"] - 1
    assert counts["metrics/quality/yellow_taxi/2025-08"] == 1


def test_prefix_probe(spark, lake, tmp_path):
    assert files.has_objects(spark, lake.curated(AUGUST))
    assert not files.has_objects(spark, f"{lake.root}/absent")
    (tmp_path / "bare").mkdir()
    assert not files.has_objects(spark, str(tmp_path / "bare"))


@pytest.mark.parametrize(
    "enabled, processed, published, action",
    [
        (False, True, True, "DISABLED"),
        (True, False, True, "SUCCESS"),
        (True, True, True, "EXISTS"),
        (True, True, False, "BACKFILLED"),
    ],
)
def test_action(spark, enabled, processed, published, action):
    column = publish_action(F.lit(enabled), F.lit(processed), F.lit(published))
    assert spark.range(1).select(column).first()[0] == action
