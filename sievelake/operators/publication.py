"""Is a batch published in full, and what must a run do about it?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKERS = ("curated_complete", "quarantine_complete", "metrics_complete")


def publication_state(batches: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add `raw_present`, `raw_matches` and `published` to batches.

    `batches` has dataset, source_file, source_checksum and the marker columns; `manifest`
    holds one row per published raw file. A batch is published when its raw file is
    known with the same checksum and all three outputs carry their marker.
    """
    raw = manifest.select(
        "dataset", "source_file", F.col("source_checksum").alias("published_checksum")
    )
    state = batches.join(raw, ["dataset", "source_file"], "left")
    present = F.col("published_checksum").isNotNull()
    matches = F.coalesce(F.col("published_checksum") == F.col("source_checksum"), F.lit(False))
    complete = matches
    for marker in MARKERS:
        complete = complete & F.coalesce(F.col(marker), F.lit(False))
    return state.select(
        *batches.columns,
        present.alias("raw_present"),
        matches.alias("raw_matches"),
        complete.alias("published"),
    )


def publish_action(enabled: Column, processed: Column, published: Column) -> Column:
    """SUCCESS for a new batch, EXISTS or BACKFILLED for a processed one, DISABLED when off."""
    return (
        F.when(~enabled, "DISABLED")
        .when(~processed, "SUCCESS")
        .when(published, "EXISTS")
        .otherwise("BACKFILLED")
    )


def object_counts(files: DataFrame, root: str) -> DataFrame:
    """Data files and bytes per output directory of a published tree, for every batch at once.

    `files` is a listing (`path`, `size_bytes`) below the URI `root`; contents are not read.
    """
    relative = F.expr(f"substring(path, {len(root.rstrip('/')) + 2})")
    return files.groupBy(F.regexp_replace(relative, "/[^/]+$", "").alias("directory")).agg(
        F.count("*").alias("data_files"), F.sum("size_bytes").alias("size_bytes")
    )
