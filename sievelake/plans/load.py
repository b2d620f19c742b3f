"""Many batches in one pass: the steps of a series over a DataFrame that holds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.batch import Batch, Lake
from sievelake.functions import addresses
from sievelake.operators.classify import classify, stamp_batches
from sievelake.operators.metrics import with_rates
from sievelake.operators.reconcile import partition_counts, reconcile
from sievelake.operators.schema import normalize
from sievelake.profiles import TRIPS, Profile
from sievelake.sinks import catalog
from sievelake.sinks.outputs import COUNTS_DDL, write_batches
from sievelake.sources.small import small_frame


def classified_batches(
    trips: DataFrame,
    dataset: str,
    source_prefix: str,
    schema_version: str = "1.0",
    profile: Profile = TRIPS,
    cast: bool = False,
    ingested_at: str | None = None,
) -> DataFrame:
    """Rows of many batches with reasons, status and lineage; `year` and `month` name the batch."""
    normal = normalize(trips, profile, cast)
    return classified_normal(normal, dataset, source_prefix, schema_version, profile, ingested_at)


def classified_normal(
    normal: DataFrame,
    dataset: str,
    source_prefix: str,
    schema_version: str = "1.0",
    profile: Profile = TRIPS,
    ingested_at: str | None = None,
) -> DataFrame:
    """The same from rows whose columns have their canonical names."""
    checked = classify(normal, profile)
    stamped = stamp_batches(checked, dataset, source_prefix, schema_version, ingested_at)
    batch = [F.col(name).cast("int").alias(name) for name in ("year", "month")]
    return stamped.select(*[c for c in stamped.columns if c not in ("year", "month")], *batch)


def of_batches(batches: list[Batch]) -> Column:
    """True for the batches' partitions, in a form that a metastore can evaluate itself."""
    months: dict[int, list[int]] = {}
    for batch in batches:
        months.setdefault(batch.year, []).append(batch.month)
    wanted = F.lit(False)
    for year, of_year in sorted(months.items()):
        wanted = wanted | ((F.col("year") == year) & F.col("month").isin(sorted(of_year)))
    return wanted


def load_batches(
    spark: SparkSession,
    trips: DataFrame,
    dataset: str,
    source_prefix: str,
    lake: Lake,
    table: str,
    profile: Profile = TRIPS,
    clustered: bool = False,
    cast: bool = False,
) -> DataFrame:
    """Write, register and reconcile all batches of `trips`; one summary row per batch."""
    rows = classified_batches(trips, dataset, source_prefix, profile=profile, cast=cast)
    counts = write_batches(rows, lake, dataset, clustered)
    batches = [Batch(dataset, source_prefix, row["year"], row["month"]) for row in counts]

    catalog.create_table(spark, table, lake.curated_root(dataset), profile)
    created = catalog.register_partitions(spark, table, lake, batches)

    summary = small_frame(
        spark,
        [
            (
                row["year"], row["month"], catalog.partition_status(created[batch]),
                row["total_records"], row["valid_records"], row["warning_records"],
                row["quarantined_records"],
            )
            for batch, row in zip(batches, counts)
        ],
        f"year INT, month INT, partition_status STRING, {COUNTS_DDL}",
    )
    expected = summary.select(
        "year", "month", (F.col("valid_records") + F.col("warning_records")).alias("expected_records")
    )
    # A predicate on partition columns alone: other partitions are pruned, not counted.
    compared = reconcile(expected, partition_counts(spark.table(table).where(of_batches(batches))))
    return (
        with_rates(summary)
        .withColumn("batch_id", addresses.batch_id(dataset, F.col("year"), F.col("month")))
        .join(compared, ["year", "month"])
    )
