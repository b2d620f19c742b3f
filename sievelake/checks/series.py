"""Queries that run whole batch series in one pass, from raw files they write to scratch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.batch import Batch
from sievelake.checks.adapter import DATASET, PREFIX, scratch_lake, scratch_table, trips
from sievelake.functions import addresses
from sievelake.operators import drift
from sievelake.plans.one_pass import SeriesFailed, run_all
from sievelake.plans.series import Site
from sievelake.sinks import catalog, files
from sievelake.sinks.outputs import write_periods
from sievelake.sources.ledger import read_ledger
from sievelake.sources.schemas import file_columns
from sievelake.sources.small import small_frame

RESULT = (
    "batch_id STRING, status STRING, processing_status STRING, s3_publish_status STRING, "
    "glue_partition_status STRING, reconciliation_status STRING, rows_read BIGINT, valid_records BIGINT, "
    "warning_records BIGINT, quarantined_records BIGINT, expected_records BIGINT, athena_records BIGINT, "
    "difference BIGINT"
)
NAMES = [column.split()[0] for column in RESULT.split(", ")]
REPLACED = (1995, 3)


def _store_raw(rows: DataFrame, work: str) -> list[Batch]:
    """One raw folder per month, named after it; the month is in the name alone."""
    months = [(row["year"], row["month"]) for row in rows.select("year", "month").distinct().collect()]
    batches = [Batch(DATASET, PREFIX, year, month) for year, month in sorted(months)]
    name = F.concat(F.lit(f"{PREFIX}_"), addresses.period(F.col("year"), F.col("month")), F.lit(".parquet"))
    raw = rows.withColumn("source_name", name).drop("year", "month").hint("rebalance", "source_name")
    write_periods(raw, f"{work}/data/raw/{DATASET}", [b.source_file for b in batches], "parquet", "source_name")
    return batches


def _site(spark: SparkSession, sf_dir: str) -> tuple[Site, list[Batch]]:
    lake = scratch_lake(spark)
    work, table = f"{lake.root}/work", scratch_table()
    batches = _store_raw(trips(spark, sf_dir), work)
    catalog.create_table(spark, table, lake.curated_root(DATASET))
    return Site(lake.ledger, work, lake, table), batches


def _outcome(spark: SparkSession, site: Site, records: list[dict]) -> DataFrame:
    spark.sql(f"DROP TABLE {site.table}")
    return small_frame(spark, [tuple(record.get(name) for name in NAMES) for record in records], RESULT)


def series_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    site, batches = _site(spark, sf_dir)
    return _outcome(spark, site, run_all(spark, batches, site))


def series_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run over the same files: nothing is transformed."""
    site, batches = _site(spark, sf_dir)
    run_all(spark, batches, site)
    return _outcome(spark, site, run_all(spark, batches, site))


def series_changed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run after one month's file was replaced: that month alone is transformed."""
    site, batches = _site(spark, sf_dir)
    run_all(spark, batches, site)
    year, month = REPLACED
    one = trips(spark, sf_dir).where((F.col("year") == year) & (F.col("month") == month) & (F.col("VendorID") == 1))
    _store_raw(one, site.work_root)
    return _outcome(spark, site, run_all(spark, batches, site))


# What months' files are like: a condition on the batch and what is done to its columns. Other months are plain.
_DRIFTS = (
    ("month IN (1, 7)", lambda rows: rows.drop("cbd_congestion_fee")),
    ("month = 2", lambda rows: rows.withColumnRenamed("Airport_fee", "airport_fee")),
    ("month = 3", lambda rows: rows.withColumn("passenger_count", F.col("passenger_count").cast("int"))),
    ("month = 4", lambda rows: rows.withColumn("driver_note", F.lit("none"))),
    ("year = 1995 AND month = 5", lambda rows: rows.drop("PULocationID", "tolls_amount")),
    ("year = 1996 AND month = 6", lambda rows: rows.withColumn("trip_distance", F.col("trip_distance").cast("string"))),
)
UNREADABLE, ABSENT = (1998, 10), (1997, 8)


def _drifted(spark: SparkSession, sf_dir: str) -> tuple[Site, list[Batch]]:
    """Months whose files differ as `_DRIFTS` has it, and one whose file is no Parquet."""
    lake = scratch_lake(spark)
    work, table = f"{lake.root}/work", scratch_table()
    rows, batches = trips(spark, sf_dir), []
    plain = F.lit(True)
    for condition, change in _DRIFTS:
        batches += _store_raw(change(rows.where(condition)), work)
        plain = plain & ~F.expr(condition)
    batches += _store_raw(rows.where(plain), work)
    catalog.create_table(spark, table, lake.curated_root(DATASET))
    site = Site(lake.ledger, work, lake, table)
    spoiled = site.source(Batch(DATASET, PREFIX, *UNREADABLE))
    spark.createDataFrame([("no Parquet",)], "line STRING").write.mode("overwrite").text(spoiled)
    return site, sorted(batches, key=lambda b: (b.year, b.month))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every month's files differ from the table, from their footers."""
    site, batches = _drifted(spark, sf_dir)
    spark.sql(f"DROP TABLE {site.table}")
    files_ = [(b.batch_id, path) for b in batches for path, _, _ in files.all_files(spark, site.source(b))]
    found = drift.schema_drift(file_columns(spark, files_), site.profile)
    kind = F.regexp_extract("unreadable", "^([A-Za-z]*)", 1)
    return found.drop("n_files").withColumn("unreadable", kind)


def series_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over months of which some cannot be processed and one is not there: what the ledger then holds."""
    site, batches = _drifted(spark, sf_dir)
    files.remove(spark, site.source(Batch(DATASET, PREFIX, *ABSENT)))
    try:
        run_all(spark, batches, site)
    except SeriesFailed:
        pass
    spark.sql(f"DROP TABLE {site.table}")
    reason = F.regexp_extract("error_message", "^([a-z' ]+)", 1)
    return read_ledger(spark, site.ledger).select(*NAMES, "error_type", reason.alias("reason"))


SERIES = {
    "schema_drift": schema_drift,
    "series_with_failures": series_with_failures,
    "series_first_run": series_first_run,
    "series_rerun": series_rerun,
    "series_changed_source": series_changed_source,
}
