"""The run ledger: append-only JSON lines, one record per run.

Every append has a folder of its own below the ledger, so that drivers that know nothing of each other
can append at the same time: Spark's commit of one never touches the staging folder of another.
Records that lie flat in the ledger's folder are read too.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.sinks import files
from sievelake.sources.small import fields, small_frame

SEQ = "struct<completed_at: timestamp, place: bigint, file_age: timestamp, file: string, block: bigint, line: bigint>"
_LATER = 2**63 - 1
#: The folder of a ledger's snapshots, which readers of records pass over.
SNAPSHOTS = "_snapshots"

# Field names of a ledger record, so ledgers written earlier stay readable.
LEDGER_DDL = """
    run_id STRING, batch_id STRING, dataset STRING, period STRING, source_file STRING,
    source_path STRING, source_checksum STRING, schema_version STRING, started_at STRING,
    completed_at STRING, status STRING, processing_status STRING,
    rows_read BIGINT, valid_records BIGINT, warning_records BIGINT, quarantined_records BIGINT,
    s3_publish_enabled BOOLEAN, s3_publish_status STRING, s3_bucket STRING,
    s3_curated_object_count BIGINT, s3_quarantine_object_count BIGINT, s3_quality_object_count BIGINT,
    glue_registration_enabled BOOLEAN, glue_partition_status STRING,
    athena_reconciliation_enabled BOOLEAN, query_execution_id STRING, year BIGINT, month BIGINT,
    expected_records BIGINT, athena_records BIGINT, difference BIGINT, reconciliation_status STRING,
    error_type STRING, error_message STRING, error STRING, ingested_at STRING, place BIGINT
"""


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Every record, with `seq` to order them; a missing ledger is an empty one.

    Spark reads files in no fixed order. `seq` sorts by completion, where records
    without one come first, then by the place that compaction gave them, then by where the record was read from: file age,
    file, block and line. A damaged line raises instead of vanishing.
    """
    return read_records(spark, [path])


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The records in files and folders of a ledger."""
    try:
        read = spark.read.schema(LEDGER_DDL).option("mode", "FAILFAST").option("recursiveFileLookup", True)
        records = read.json(paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return small_frame(spark, [], LEDGER_DDL).withColumn("seq", F.lit(None).cast(SEQ))
    return records.select(
        "*",
        F.struct(
            F.col("completed_at").try_cast("timestamp").alias("completed_at"),
            F.coalesce("place", F.lit(_LATER)).alias("place"),
            F.col("_metadata.file_modification_time").alias("file_age"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("seq"),
    )


def append_records(spark: SparkSession, path: str, records: Iterable[dict[str, Any]]) -> None:
    """Append run records as one small file. A field outside the ledger's is refused, not dropped."""
    names = [name for name, _ in fields(LEDGER_DDL)]
    rows = []
    for record in records:
        unknown = sorted(set(record).difference(names))
        if unknown:
            raise ValueError(f"unknown ledger fields: {', '.join(unknown)}")
        rows.append(tuple(record.get(name) for name in names))
    append_ledger(small_frame(spark, rows, LEDGER_DDL).coalesce(1), path)


def append_ledger(records: DataFrame, path: str) -> None:
    """Append ledger records computed by Spark. Null fields are left out of the JSON."""
    records.write.json(f"{path.rstrip('/')}/run={uuid.uuid4()}")


def compact_ledger(spark: SparkSession, path: str) -> None:
    """Write all records anew as one append, in their order, and remove the folders and files they came from.

    Records are dealt by ranges of their order, and each is given its place, so that no task holds the ledger and
    the order is kept whichever file is written first. Snapshots go, and are made anew by the next folding. Until the removal is done some records are there twice, which no
    decision taken from a ledger minds; records appended meanwhile stay.
    """
    before = [child for child in files.children(spark, path) if not child.rsplit("/", 1)[1].startswith("_")]
    if not before:
        return
    names = [name for name, _ in fields(LEDGER_DDL) if name != "place"]
    ordered = read_records(spark, before).repartitionByRange("seq").sortWithinPartitions("seq")
    append_ledger(ordered.select(*names, F.monotonically_increasing_id().alias("place")), path)
    # snapshots order records by where they lay before
    files.remove(spark, f"{path.rstrip('/')}/{SNAPSHOTS}")
    files.for_each(files.remove, [(spark, child) for child in before])
