"""Publication of single batches and what is known about it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.batch import Batch, Lake, under
from sievelake.operators.publication import publication_state
from sievelake.sinks import files
from sievelake.sinks.listing import listed_outputs
from sievelake.sources.small import small_frame

MANIFEST_DDL = (
    "dataset STRING, period STRING, source_file STRING, source_path STRING, source_checksum STRING, version STRING"
)
STATE_DDL = (
    "batch_id STRING, dataset STRING, period STRING, source_file STRING, source_checksum STRING, "
    "curated_complete BOOLEAN, quarantine_complete BOOLEAN, metrics_complete BOOLEAN"
)


def publish_raw(spark: SparkSession, lake: Lake, batch: Batch, source_path: str, checksum: str) -> None:
    """Record the raw file as published. It stays where it is: sources already lie on the lake."""
    row = (batch.dataset, batch.period, batch.source_file, files.qualified(spark, source_path), checksum, lake.version)
    manifest = small_frame(spark, [row], MANIFEST_DDL).coalesce(1)
    manifest.write.mode("overwrite").json(lake.manifest(batch))


def published_manifest(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """One row per published raw file of a dataset; empty before the first publication."""
    try:
        return spark.read.schema(MANIFEST_DDL).json(f"{lake.manifest_root(dataset)}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return small_frame(spark, [], MANIFEST_DDL)


def has_processed_outputs(spark: SparkSession, batch: Batch, work_root: str) -> bool:
    outputs = (batch.curated_output, batch.quarantine_output, batch.metrics_output)
    return all(files.is_complete(spark, under(work_root, output)) for output in outputs)


def copy_outputs(spark: SparkSession, lake: Lake, batch: Batch, work_root: str) -> None:
    """Publish outputs of an earlier run. Stale files at the target do not survive."""
    for source, target in (
        (batch.curated_output, lake.curated(batch)),
        (batch.quarantine_output, lake.quarantine(batch)),
    ):
        spark.read.parquet(under(work_root, source)).write.mode("overwrite").parquet(target)
    metrics = spark.read.text(under(work_root, batch.metrics_output))
    metrics.coalesce(1).write.mode("overwrite").format("text").save(lake.metrics(batch))


def publication_summary(spark: SparkSession, lake: Lake, batch: Batch) -> dict[str, Any]:
    return {
        "batch_id": batch.batch_id,
        "curated_prefix": lake.curated_prefix(batch),
        "curated_object_count": files.object_count(spark, lake.curated(batch)),
        "quarantine_object_count": files.object_count(spark, lake.quarantine(batch)),
        "quality_object_count": files.object_count(spark, lake.metrics(batch)),
    }


def publication_summaries(spark: SparkSession, places: Iterable[tuple[Batch, Lake]]) -> DataFrame:
    """Object counts of many batches, one row each, from one listing in tasks."""
    counted = listed_outputs(spark, places).groupBy("batch_id")

    def of(kind: str, value: str = "objects"):
        return F.max(F.when(F.col("kind") == kind, F.col(value)))

    return counted.agg(
        of("curated").alias("curated_object_count"),
        of("quarantine").alias("quarantine_object_count"),
        of("metrics").alias("quality_object_count"),
        (of("curated", "data_files") > 0).alias("has_curated_data"),
        F.bool_and("complete").alias("complete"),
    )


def published_versions(spark: SparkSession, lake: Lake, batches: Iterable[Batch]) -> dict[Batch, Lake]:
    """The lake of each batch, at the version that its manifest row names; a lake without versions as it is."""
    batches = list(batches)
    if not lake.versioned or not batches:
        return dict.fromkeys(batches, lake)
    rows = published_manifest(spark, lake, batches[0].dataset).where("version IS NOT NULL").collect()
    found = {row["period"]: row["version"] for row in rows}
    return {batch: lake.at(found.get(batch.period)) for batch in batches}


def published_batches(
    spark: SparkSession,
    lake: Lake,
    checksums: Iterable[tuple[Batch, str]],
    at: Mapping[Batch, Lake] | None = None,
) -> DataFrame:
    """Publication state of batches, given with their source checksums; `at` names lakes at versions."""
    asked = list(checksums)
    places = at or {}
    listed = listed_outputs(spark, [(batch, places.get(batch, lake)) for batch, _ in asked]).where("complete")
    whole = {(row["batch_id"], row["kind"]) for row in listed.select("batch_id", "kind").collect()}
    rows = [
        (
            batch.batch_id, batch.dataset, batch.period, batch.source_file, checksum,
            *((batch.batch_id, kind) in whole for kind in ("curated", "quarantine", "metrics")),
        )
        for batch, checksum in asked
    ]
    manifest = small_frame(spark, [], MANIFEST_DDL)
    for dataset in sorted({batch.dataset for batch, _ in asked}):
        manifest = manifest.unionByName(published_manifest(spark, lake, dataset))
    return publication_state(small_frame(spark, rows, STATE_DDL), manifest)


def is_published(spark: SparkSession, lake: Lake, batch: Batch, checksum: str) -> bool:
    return not published_batches(spark, lake, [(batch, checksum)]).where(F.col("published")).isEmpty()
