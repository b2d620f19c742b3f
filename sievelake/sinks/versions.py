"""Old versions of curated partitions in a versioned lake."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

from sievelake.batch import ROW_KIND, Lake
from sievelake.sinks import catalog, files, publish

HOUR_MS = 3_600_000


def collect_versions(spark: SparkSession, table: str, lake: Lake, dataset: str, hours: float = 24) -> list[str]:
    """Remove partition folders that neither the table nor a manifest row names, and return their URIs.

    Folders younger than `hours` stay: a run may not have registered them yet, and readers that began before a
    switch may still be at them.
    """
    named = {place for held in catalog.listed_partitions(spark, table).values() for _, place in held}
    rows = publish.published_manifest(spark, lake, dataset).where("version IS NOT NULL").collect()
    current = {(row["version"], row["period"]) for row in rows}
    oldest = time.time() * 1000 - hours * HOUR_MS
    gone = []
    for run in files.children(spark, lake.versions_root(dataset)):
        years = files.children(spark, f"{run}/{ROW_KIND}=curated")
        months = [month for year in years for month in files.children(spark, year)]
        left = 0
        for month in months:
            period = "-".join(part.partition("=")[2] for part in month.split("/")[-2:])
            kept = month in named or (run.rsplit("/", 1)[1], period) in current
            if kept or files.modified(spark, month) > oldest:
                left += 1
            else:
                files.remove(spark, month)
                gone.append(month)
        if months and not left:
            files.remove(spark, run)
    return gone
