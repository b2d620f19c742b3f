"""Session settings the results or the speed of a run depend on. All can be set while Spark runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Durations of zoned timestamps must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
    # Splits hot batches, merges small partitions, picks joins from real sizes.
    "spark.sql.adaptive.enabled": "true",
    # The JVM does not compile methods above 8000 bytes. Rules over derived columns
    # exceed that in one fused stage and run many times slower; with this limit such
    # a stage is run as separate, compiled operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A write into folders sorts all rows of a task by folder, in memory, then on disk. A task that meets
    # few folders, as after a rebalance by batch, writes them side by side; beyond this many it sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
