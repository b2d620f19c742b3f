"""Curated, quarantine and metrics outputs.

`write_batch` writes one batch to three given directories. `write_batches` writes
every batch of a DataFrame into the published layout, with as many jobs for a
thousand batches as for one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sievelake.batch import ROW_KIND, Batch, Lake
from sievelake.functions import addresses
from sievelake.operators.classify import curated, quarantined
from sievelake.operators.metrics import count_columns, quality_metrics, with_rates
from sievelake.profiles import QUARANTINE
from sievelake.sinks import files
from sievelake.sources.small import fields, small_frame

_PERIOD = "sievelake_period"
FILE_BYTES = 256 * 1024 * 1024
COUNTS_DDL = (
    "total_records BIGINT, valid_records BIGINT, warning_records BIGINT, quarantined_records BIGINT"
)


def write_batch(
    classified: DataFrame, curated_output: str, quarantine_output: str, metrics_output: str
) -> dict[str, Any]:
    """Write one batch and return its four counts.

    The counts are observed on the rows that flow into the curated write, so they
    cost no scan. That write has no shuffle: each row passes in the final stage,
    whose tasks count once however often executors are lost. Quarantine is a
    second scan; caching the batch instead would put all of it on executor disks,
    where a lost executor takes its share along.
    A batch without quarantined rows skips that scan and writes the empty output.
    """
    spark = classified.sparkSession
    seen = Observation()
    curated(classified.observe(seen, *count_columns())).write.mode("overwrite").parquet(curated_output)
    counts = seen.get
    # Few rows out of many tasks: merged, or each scan task would leave a tiny file.
    some = counts["quarantined_records"]
    held_back = quarantined(classified).hint("rebalance") if some else classified.where(F.lit(False))
    held_back.write.mode("overwrite").parquet(quarantine_output)
    row = small_frame(spark, [tuple(counts[name] for name, _ in fields(COUNTS_DDL))], COUNTS_DDL)
    with_rates(row).coalesce(1).write.mode("overwrite").json(metrics_output)
    return counts


def write_batches(
    classified: DataFrame,
    lake: Lake,
    dataset: str,
    clustered: bool = False,
    file_bytes: int | None = None,
) -> list[dict[str, Any]]:
    """Write all batches of a DataFrame that carries their `year` and `month`; return counts per batch.

    The input is read once: one write puts curated and quarantined rows into folders by kind and batch, beside the
    published ones. Counts come from what was written, its status column alone, so they are those of committed
    files however often tasks ran. Then curated folders take their places, and quarantined rows, few out of many
    tasks, are merged on their way to theirs. In a lake at a version curated folders stay where they were written.

    Batches absent from the input are left alone. Unless the input is `clustered`,
    with each file holding rows of few batches, rows are rebalanced by batch:
    adaptive execution splits a hot batch over many tasks and merges small ones,
    so the number of files follows the data and not tasks times batches. `file_bytes` is the size
    that rebalanced partitions, and so files, aim at: by default what the session has set, or else FILE_BYTES.
    """
    spark = classified.sparkSession
    held = F.when(F.col("validation_status") == QUARANTINE, "quarantine").otherwise("curated")
    rows = classified.withColumns({ROW_KIND: held, "month": addresses.month_string(F.col("month"))})
    rows = rows if clustered else rows.hint("rebalance", ROW_KIND, "year", "month")
    if lake.version:
        staged = f"{lake.versions_root(dataset)}/{lake.version}"
    else:
        staged = f"{lake.curated_root(dataset)}/_staged-{uuid.uuid4().hex}"
    # Two runs of one version follow each other: what it holds of other batches stays.
    dynamic = {"partitionOverwriteMode": "dynamic"} if lake.version else {}
    with _advisory_size(spark, file_bytes):
        rows.write.partitionBy(ROW_KIND, "year", "month").mode("overwrite").options(**dynamic).parquet(staged)
    written = spark.read.schema(_with_batch(classified.select("validation_status"))).parquet(staged)
    counts = [row.asDict() for row in quality_metrics(written, ["year", "month"]).collect()]
    for row in counts:
        if row["year"] is None or row["month"] is None:
            files.remove(spark, staged)
            raise ValueError(f"{row['total_records']} rows have no batch: year or month is null")
    batches = {Batch(dataset, "", row["year"], row["month"]): row for row in counts}
    periods = [batch.period for batch in batches]
    rates = with_rates(
        small_frame(
            spark,
            [(batch.period, *(row[name] for name, _ in fields(COUNTS_DDL))) for batch, row in batches.items()],
            f"period STRING, {COUNTS_DDL}",
        )
    )
    bad = spark.read.schema(_with_batch(classified)).parquet(staged).where(F.col(ROW_KIND) == "quarantine")
    bad = bad.withColumn(_PERIOD, addresses.period(F.col("year"), F.col("month"))).drop(ROW_KIND, "year", "month")
    bad = bad.hint("rebalance", _PERIOD)

    def write_quarantine() -> None:
        write_periods(bad, lake.quarantine_root(dataset), periods, "parquet", _PERIOD)

    def write_metrics() -> None:
        write_periods(rates, lake.metrics_root(dataset), periods, "json")

    def publish_curated() -> None:
        moves = [
            (spark, f"{staged}/{ROW_KIND}=curated/year={b.year}/month={b.month_string}", lake.curated(b)) for b in batches
        ]
        files.for_each(files.mark_complete, [m[::2] for m in moves]) if lake.version else files.for_each(_finish_period, moves)

    # Submitted together: small jobs, and moves that wait for the store.
    with _advisory_size(spark, file_bytes), ThreadPoolExecutor(3) as pool:
        steps = (publish_curated, write_quarantine, write_metrics)
        for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            done.result()
    # What is left of the staged rows is published elsewhere by now.
    files.remove(spark, f"{staged}/{ROW_KIND}=quarantine" if lake.version else staged)
    return counts


def _with_batch(classified: DataFrame) -> StructType:
    kept = [field for field in classified.schema if field.name not in ("year", "month")]
    batch = [StructField(ROW_KIND, StringType()), StructField("year", IntegerType()), StructField("month", IntegerType())]
    return StructType([*kept, *batch])


@contextmanager
def _advisory_size(spark: SparkSession, file_bytes: int | None) -> Iterator[None]:
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = spark.conf.get(advisory, None)
    spark.conf.set(advisory, str(file_bytes or usual or FILE_BYTES))
    try:
        yield
    finally:
        if usual is None:
            spark.conf.unset(advisory)
        else:
            spark.conf.set(advisory, usual)


def write_periods(
    df: DataFrame, root: str, periods: list[str], form: str, by: str = "period"
) -> None:
    """One job for all periods, then one move per period to its plain `YYYY-MM` directory."""
    spark = df.sparkSession
    staged = f"{root}/_staged-{uuid.uuid4().hex}"
    try:
        df.write.partitionBy(by).format(form).save(staged)
    except Exception:
        files.remove(spark, staged)
        raise
    moves = [(spark, f"{staged}/{by}={period}", f"{root}/{period}") for period in periods]
    files.for_each(_finish_period, moves)
    files.remove(spark, staged)  # kept if a move failed: it may hold the only copy


def _finish_period(spark: SparkSession, staged: str, target: str) -> None:
    if files.exists(spark, staged):
        files.replace_directory(spark, staged, target)
    else:
        files.remove(spark, target)
    files.mark_complete(spark, target)


def read_curated(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """All curated batches; `year` and `month` are partition columns."""
    return spark.read.parquet(lake.curated_root(dataset))
