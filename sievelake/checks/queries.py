"""One registered query per operator. Each reads whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.batch import Batch, Lake
from sievelake.checks.adapter import DATASET, PREFIX, scratch, scratch_lake, scratch_table, trips
from sievelake.checks.series import SERIES
from sievelake.functions import addresses
from sievelake.operators import classify as rows
from sievelake.operators import ledger as ledgers
from sievelake.operators import content, metrics, publication, reconcile
from sievelake.operators.schema import normalize
from sievelake.plans.batch_run import run_batch
from sievelake.plans.load import classified_batches, load_batches
from sievelake.plans.series import Site, run_single
from sievelake.profiles import TRIPS
from sievelake.session import tune
from sievelake.sinks import catalog, files, publish
from sievelake.sinks.outputs import read_curated, write_batches
from sievelake.sources import ledger_state
from sievelake.sources.history import read_history
from sievelake.sources.ledger import append_ledger, compact_ledger, read_ledger
from sievelake.sources.manifest import file_manifest
from sievelake.sources.manifest_store import refresh_manifest
from sievelake.sources.small import small_frame

Query = Callable[[SparkSession, str], DataFrame]

KEYS = ["vendor_id", "pickup_datetime", "dropoff_datetime", "trip_distance", "total_amount", "year", "month"]
EXPECTED_BATCHES = 83


def _flat(df: DataFrame) -> DataFrame:
    reasons = ("quarantine_reasons", "warning_reasons")
    return df.withColumns({name: F.concat_ws("|", name) for name in reasons})


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified_batches(trips(spark, sf_dir), DATASET, PREFIX)


# -- schema and rules ---------------------------------------------------------------------------


def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(trips(spark, sf_dir))


def canonical_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The opt-in cast: text columns of a drifted source come back with the table's types."""
    source = trips(spark, sf_dir)
    drifted = source.withColumns(
        {name: F.col(name).cast("string") for name in ("VendorID", "RatecodeID", "trip_distance")}
    )
    wanted = ("vendor_id", "rate_code_id", "trip_distance", "pickup_location_id")
    return normalize(drifted, cast=True).select(*wanted)


def _rule(code: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rows.where_fired(normalize(trips(spark, sf_dir)), code).select(*KEYS)

    return query


def reason_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _flat(rows.classify(normalize(trips(spark, sf_dir))))
    return found.select(*KEYS, "quarantine_reasons", "warning_reasons")


def classify_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _flat(rows.classify(normalize(trips(spark, sf_dir))))
    return found.select(*KEYS, "quarantine_reasons", "warning_reasons", "validation_status")


def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select(*KEYS, "source_file", "batch_id", "schema_version")


# -- outputs of a batch, written and read back --------------------------------------------------


def _written(spark: SparkSession, sf_dir: str) -> str:
    """All trips as one raw batch on disk, read, checked and written as any batch is."""
    root = scratch(spark)
    trips(spark, sf_dir).write.parquet(f"{root}/raw")
    outputs = (f"{root}/{name}" for name in ("curated", "quarantine", "metrics"))
    run_batch(spark, f"{root}/raw", f"{PREFIX}.parquet", DATASET, "1.0", *outputs)
    return root


def curated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = spark.read.parquet(f"{_written(spark, sf_dir)}/curated")
    return _flat(written).select(*KEYS, "quarantine_reasons", "warning_reasons", "validation_status")


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = spark.read.parquet(f"{_written(spark, sf_dir)}/quarantine")
    return _flat(written).select(*KEYS, "quarantine_reasons", "warning_reasons", "validation_status")


METRICS_DDL = (
    "total_records BIGINT, valid_records BIGINT, warning_records BIGINT, quarantined_records BIGINT, "
    "quality_pass_rate DOUBLE, quarantine_rate DOUBLE"
)


def written_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(METRICS_DDL).json(f"{_written(spark, sf_dir)}/metrics")


def single_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips as one batch run alone, twice: the metrics it wrote, and whether the second run was skipped."""
    work = scratch(spark)
    batch = Batch(DATASET, PREFIX, 2000, 1)
    site = Site(f"{work}/ledger", work)
    trips(spark, sf_dir).write.parquet(site.source(batch))
    run_single(spark, batch, site)
    skipped = run_single(spark, batch, site) is None
    found = spark.read.schema(METRICS_DDL).json(f"{work}/{batch.metrics_output}")
    return found.withColumn("second_run_skipped", F.lit(skipped))


# -- counts and rates ---------------------------------------------------------------------------


def total_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.total_records(_classified(spark, sf_dir))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.status_counts(_classified(spark, sf_dir))


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.quality_metrics(_classified(spark, sf_dir))


def quality_metrics_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.quality_metrics(_classified(spark, sf_dir), ["batch_id"])


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.batch_summary(quality_metrics_by_batch(spark, sf_dir), ["batch_id"])


# -- addresses and files ------------------------------------------------------------------------


def batch_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, month = F.col("year"), F.col("month")
    return (
        trips(spark, sf_dir)
        .select("year", "month")
        .distinct()
        .select(
            addresses.month_string(month).alias("month_string"),
            addresses.period(year, month).alias("period"),
            addresses.batch_id(DATASET, year, month).alias("batch_id"),
            addresses.source_file(PREFIX, year, month).alias("source_file"),
            addresses.curated_prefix(DATASET, year, month).alias("curated_prefix"),
        )
    )


def source_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and SHA-256 of one text file per batch, written from the trips: a line with the batch's id and rows."""
    line = F.concat_ws(":", addresses.batch_id(DATASET, F.col("in_year"), F.col("in_month")), "rows")
    found = trips(spark, sf_dir).groupBy("year", "month")
    found = found.agg(F.max("year").alias("in_year"), F.max("month").alias("in_month"), F.count("*").alias("rows"))
    path = scratch(spark)
    found.select("year", "month", line.alias("line")).write.partitionBy("year", "month").text(path)
    folder = F.element_at(F.split(F.regexp_extract("path", "(year=.*)/", 1), "/"), 1)
    month = F.element_at(F.split(F.regexp_extract("path", "(month=.*)/", 1), "/"), 1)
    return file_manifest(spark, path).select(
        F.concat_ws("/", folder, month).alias("folder"), "size_bytes", "sha256"
    )


def manifest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a refresh finds after January's file went, February's got another content, March a second file, and April
    was written again with the same content; files that did not change are not read."""
    line = F.concat_ws(":", addresses.batch_id(DATASET, F.col("in_year"), F.col("in_month")), "rows")
    found = trips(spark, sf_dir).groupBy("year", "month")
    found = found.agg(F.max("year").alias("in_year"), F.max("month").alias("in_month"), F.count("*").alias("rows"))
    root = scratch(spark)
    raw, store = f"{root}/raw", f"{root}/manifest"
    found.select("year", "month", line.alias("line")).write.partitionBy("year", "month").text(raw)
    refresh_manifest(spark, store, [raw])
    for path, _, _ in files.all_files(spark, raw):
        folder, month = path.rpartition("/")[0], path.rpartition("/")[0].rpartition("=")[2]
        if month == "1":
            files.remove(spark, path)
        elif month == "2":
            files.write_text(spark, path, "other")
        elif month == "3":
            files.write_text(spark, f"{folder}/second.txt", "more")
        elif month == "4":
            files.write_text(spark, path, files.read_text(spark, path))
    return refresh_manifest(spark, store, [raw]).select(
        F.regexp_extract("path", "(year=[0-9]+/month=[0-9]+)/", 1).alias("folder"), "change", "hashed", "sha256"
    )


# -- ledger -------------------------------------------------------------------------------------


def _run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    append_ledger(_runs(spark, sf_dir), path)
    return read_ledger(spark, path)


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs made from the trips: six attempts per batch over three contents, with mixed outcomes."""
    attempt = F.col("rate_code_id")
    kind = F.pmod(F.col("year") * 12 + F.col("month") + attempt, F.lit(7))
    counted = metrics.quality_metrics(_classified(spark, sf_dir), ["year", "month", "rate_code_id"])
    batch = addresses.batch_id(DATASET, F.col("year"), F.col("month"))
    completed = F.format_string("%d-%02d-%02dT00:00:00+00:00", "year", "month", attempt)

    def unless_countless(name: str):
        return F.when(kind != 4, F.col(name))

    return counted.select(
        F.format_string("run_%d_%d_%d", "year", "month", attempt).alias("run_id"),
        batch.alias("batch_id"),
        F.sha2(F.concat(batch, F.lit(":"), (attempt % 3).cast("string")), 256).alias("source_checksum"),
        F.when(attempt != 1, completed).alias("completed_at"),
        F.when(kind.isin(0, 4), "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(kind.isin(0, 1, 3), "SUCCESS")
        .when(kind.isin(2, 4), "SKIPPED_ALREADY_PROCESSED")
        .alias("processing_status"),
        F.when(kind.isin(0, 4), "MATCH")
        .when(kind == 1, "MISMATCH")
        .when(kind == 2, "FAILED")
        .otherwise("NOT_RUN")
        .alias("reconciliation_status"),
        F.when(kind.isin(1, 4), "BACKFILLED").when(kind != 6, "EXISTS").alias("s3_publish_status"),
        F.when(attempt % 2 == 0, "CREATED").otherwise("EXISTS").alias("glue_partition_status"),
        unless_countless("total_records").alias("rows_read"),
        unless_countless("valid_records").alias("valid_records"),
        unless_countless("warning_records").alias("warning_records"),
        unless_countless("quarantined_records").alias("quarantined_records"),
    )


def _current_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per batch. Ids come from aggregates: from grouping keys, Catalyst would move the
    ledger join below the grouping and hash an id for every trip."""
    batch = addresses.batch_id(DATASET, F.col("in_year"), F.col("in_month"))
    found = trips(spark, sf_dir).groupBy("year", "month")
    found = found.agg(F.max("year").alias("in_year"), F.max("month").alias("in_month"))
    return found.select(
        batch.alias("batch_id"), F.sha2(F.concat(batch, F.lit(":2")), 256).alias("source_checksum")
    )


def processed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _run_history(spark, sf_dir)
    return runs.select("run_id", "status", ledgers.processing_completed().alias("completed"))


def pending_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledgers.pending(_current_batches(spark, sf_dir), _run_history(spark, sf_dir))


def skipped_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledgers.skipped(_current_batches(spark, sf_dir), _run_history(spark, sf_dir))


def latest_processed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledgers.latest_counts(_run_history(spark, sf_dir)).drop("ingested_at")


def _folded_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger's state after its first appends were folded, compacted and folded again, and others came since."""
    path, runs = scratch(spark), _runs(spark, sf_dir)
    attempt = F.element_at(F.split("run_id", "_"), -1).cast("int")
    append_ledger(runs.where(attempt == 4), path)
    ledger_state.fold_ledger(spark, path)
    append_ledger(runs.where(attempt <= 2), path)
    compact_ledger(spark, path)
    ledger_state.fold_ledger(spark, path)
    append_ledger(runs.where(attempt.isin(3, 5, 6)), path)
    return ledger_state.ledger_state(spark, path)


def folded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_state.latest_counts(_folded_state(spark, sf_dir)).drop("ingested_at")


def folded_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = ledger_state.completed_keys(_folded_state(spark, sf_dir))
    return _current_batches(spark, sf_dir).join(done, ledgers.KEY, "left_semi")


def recorded_reruns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledgers.rerun_records(_run_history(spark, sf_dir)).select("run_id")


# -- published layout, catalog and reconciliation -----------------------------------------------


def _published(spark: SparkSession, sf_dir: str):
    lake = scratch_lake(spark)
    counts = write_batches(_classified(spark, sf_dir), lake, DATASET)
    return lake, [Batch(DATASET, PREFIX, row["year"], row["month"]) for row in counts]


def _registered(spark: SparkSession, sf_dir: str):
    lake, batches = _published(spark, sf_dir)
    table = scratch_table()
    catalog.create_table(spark, table, lake.curated_root(DATASET))
    catalog.register_partitions(spark, table, lake, batches)
    return lake, batches, table


def published_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = _published(spark, sf_dir)
    return read_curated(spark, lake, DATASET).select(*KEYS, "batch_id", "validation_status")


def published_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = _published(spark, sf_dir)
    held = spark.read.option("recursiveFileLookup", True).parquet(lake.quarantine_root(DATASET))
    wanted = [name for name in KEYS if name not in ("year", "month")]
    return _flat(held).select(*wanted, "batch_id", "quarantine_reasons", "warning_reasons")


def published_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = _published(spark, sf_dir)
    held = spark.read.schema(METRICS_DDL).option("recursiveFileLookup", True)
    period = F.regexp_extract("_metadata.file_path", "/([0-9]{4}-[0-9]{2})/", 1)
    return held.json(lake.metrics_root(DATASET)).withColumn("period", period)


def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.partition_counts(spark.table(_registered(spark, sf_dir)[2]))


def reconcile_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that agree, except: January expects quarantined rows too, February came into the lake by a
    run that nothing expects, and March lost its partition."""
    lake, trips_ = scratch_lake(spark), _classified(spark, sf_dir)
    processed = write_batches(trips_.where("month <> 2"), lake, DATASET)
    strays = write_batches(trips_.where("month = 2"), lake, DATASET)
    table = scratch_table()
    catalog.create_table(spark, table, lake.curated_root(DATASET))
    batches = [Batch(DATASET, PREFIX, row["year"], row["month"]) for row in processed + strays]
    catalog.register_partitions(spark, table, lake, batches)
    lost = [place for key, held in catalog.listed_partitions(spark, table).items() if key[1] == 3 for place, _ in held]
    catalog.drop_as_spelled(spark, table, lost)
    expected = [
        (
            row["year"],
            row["month"],
            row["total_records"] if row["month"] == 1 else row["valid_records"] + row["warning_records"],
        )
        for row in processed
    ]
    found = reconcile.partition_counts(spark.table(table))
    return reconcile.reconcile(small_frame(spark, expected, "year INT, month INT, expected_records BIGINT"), found)


def _largest_rows(df: DataFrame) -> DataFrame:
    """year, month and the batch's largest `row`, compared column by column.

    A maximum of whole rows sorts all of a task's rows by batch first. So it is taken only among those that are
    largest by their first two columns, whose maximum needs no sort.
    """
    a, b, *others = [name for name in df.columns if name not in ("year", "month")]
    per_first = df.groupBy("year", "month", a).agg(F.max(b).alias(b))
    tops = per_first.groupBy(F.col("year").alias("_year"), F.col("month").alias("_month")).agg(F.max(F.struct(a, b)).alias("_top"))
    same_batch = (F.col("year") == F.col("_year")) & (F.col("month") == F.col("_month"))
    same_start = F.col(a).eqNullSafe(F.col(f"_top.{a}")) & F.col(b).eqNullSafe(F.col(f"_top.{b}"))
    # one row a batch: the rows themselves need not be shuffled to meet it
    top_rows = df.join(F.broadcast(tops), same_batch & same_start)
    return top_rows.groupBy("year", "month").agg(F.max(F.struct(a, b, *others)).alias("row"))


def reconcile_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the source against rows of the table, after March's amounts were changed in place, April's rows of
    vendor 1 gave way to copies of others, May's were dealt anew over files, and June lost its partition."""
    lake, batches, table = _registered(spark, sf_dir)
    month = F.col("month")
    held = read_curated(spark, lake, DATASET).where(month.isin(3, 4, 5))
    first = F.col("vendor_id") == 1
    rest = held.where((month == 4) & ~first)
    copies = _largest_rows(rest)
    lost = held.where((month == 4) & first).select("year", "month").join(copies, ["year", "month"])
    changed = (
        held.where(month == 3).withColumn("total_amount", F.col("total_amount") + 1)
        .unionByName(rest)
        .unionByName(lost.select("row.*", "year", "month").select(*held.columns))
        .unionByName(held.where(month == 5).repartition(3))
    )
    aside = scratch(spark)
    changed.write.partitionBy("year", "month").parquet(aside)
    for batch in batches:
        if batch.month in (3, 4, 5):
            files.replace_directory(spark, f"{aside}/year={batch.year}/month={batch.month}", lake.curated(batch))
    catalog.drop_as_spelled(spark, table, [(str(b.year), str(b.month)) for b in batches if b.month == 6])
    spark.catalog.refreshTable(table)
    wanted = content.content_digests(rows.curated(_classified(spark, sf_dir)))
    return content.reconcile_content(wanted, content.content_digests(spark.table(table)))


def reconciliation_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _run_history(spark, sf_dir)
    return runs.select(
        "run_id",
        reconcile.outcome(
            F.col("s3_publish_status").isNotNull(),
            F.when(F.col("status") == "SUCCESS", F.col("glue_partition_status")).otherwise("FAILED"),
            F.col("reconciliation_status") == "FAILED",
            F.col("reconciliation_status"),
        ).alias("reconciliation_status"),
    )


def partition_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch registered again, with the counts then found.

    Before that all months are found by MSCK REPAIR, which spells them with a leading zero; then January is
    dropped, February lies elsewhere, and March is registered a second time.
    """
    lake, batches = _published(spark, sf_dir)
    table = scratch_table()
    catalog.create_table(spark, table, lake.curated_root(DATASET))
    spark.sql(f"MSCK REPAIR TABLE {table}")
    moved = Lake(f"{lake.root}/elsewhere")
    catalog.register_partitions(spark, table, moved, [b for b in batches if b.month == 2])
    catalog.drop_as_spelled(spark, table, [(str(b.year), b.month_string) for b in batches if b.month == 1])
    twice = " ".join(
        f"PARTITION (year={b.year}, month=3) LOCATION '{lake.curated(b)}'" for b in batches if b.month == 3
    )
    spark.sql(f"ALTER TABLE {table} ADD {twice}")
    changed = catalog.register_partitions(spark, table, lake, batches)
    correct = catalog.correct_partitions(spark, table, lake, batches)
    repaired = [(b.year, b.month, catalog.partition_status(changed[b]), b in correct) for b in batches]
    schema = "year INT, month INT, partition_status STRING, correct BOOLEAN"
    counts = reconcile.partition_counts(spark.table(table))
    return small_frame(spark, repaired, schema).join(counts, ["year", "month"])


def publication_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State and next action per batch, after January lost its quarantine marker and February's
    source changed; publication is off for April, and May was never processed."""
    lake, batches = _published(spark, sf_dir)
    current = _current_batches(spark, sf_dir)
    checksums = {row["batch_id"]: row["source_checksum"] for row in current.collect()}
    known = [
        (b.dataset, b.period, b.source_file, b.source_file, checksums[b.batch_id], None) for b in batches
    ]
    manifest = small_frame(spark, known, publish.MANIFEST_DDL)
    manifest.write.json(f"{lake.manifest_root(DATASET)}/all")
    for batch in batches:
        if batch.month == 1:
            files.remove(spark, f"{lake.quarantine(batch)}/_SUCCESS")
    asked = [(b, "changed" if b.month == 2 else checksums[b.batch_id]) for b in batches]
    state = publish.published_batches(spark, lake, asked)
    enabled, processed = (~F.col("batch_id").endswith(month) for month in ("_04", "_05"))
    action = publication.publish_action(enabled, processed, F.col("published"))
    return state.select(
        "batch_id", "raw_present", "raw_matches", "curated_complete", "quarantine_complete",
        "metrics_complete", "published", action.alias("action"),
    )


def publication_summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects per batch and output, after February's quarantine went and March's metrics lost their marker."""
    lake, batches = _published(spark, sf_dir)
    for batch in batches:
        if batch.month == 2:
            files.remove(spark, lake.quarantine(batch))
        elif batch.month == 3:
            files.remove(spark, f"{lake.metrics(batch)}/_SUCCESS")
    return publish.publication_summaries(spark, [(batch, lake) for batch in batches])


def published_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per published directory: does it hold data, its marker, any object at all?"""
    lake, batches = _published(spark, sf_dir)
    root = files.qualified(spark, lake.root)
    outputs = [out for b in batches for out in (lake.curated(b), lake.quarantine(b), lake.metrics(b))]
    names = [files.qualified(spark, out)[len(root) + 1 :] for out in outputs]
    marks = files.for_each(files.is_complete, [(spark, out) for out in outputs])
    any_ = files.for_each(files.has_objects, [(spark, out) for out in outputs])
    asked = small_frame(spark, list(zip(names, marks, any_)), "directory STRING, has_marker BOOLEAN, has_objects BOOLEAN")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(lake.root)
    found = listing.select("path", F.col("length").alias("size_bytes"))
    counted = publication.object_counts(found, root)
    return asked.join(counted, "directory", "left").select(
        "directory", (F.coalesce("data_files", F.lit(0)) > 0).alias("has_data"), "has_marker", "has_objects"
    )


# -- batch history ------------------------------------------------------------------------------


def _history(spark: SparkSession, sf_dir: str, damaged: bool = True) -> DataFrame:
    """One row per batch in the history's format, written as CSV and read back.

    Curated records are counted in the published files, athena records in the registered table. Damaged:
    March is not registered, May has a source row too many, June a valid one, July a negative count,
    and August 1996 is missing.
    """
    lake, batches, table = _registered(spark, sf_dir)
    if damaged:
        catalog.drop_as_spelled(spark, table, [(str(b.year), str(b.month)) for b in batches if b.month == 3])
    month = F.col("month")
    bad = F.lit(damaged)
    counted = metrics.quality_metrics(_classified(spark, sf_dir), ["year", "month"])
    written = reconcile.partition_counts(read_curated(spark, lake, DATASET))
    shown = reconcile.partition_counts(spark.table(table))
    zero = F.lit(0).cast("bigint")
    path = scratch(spark)
    counted.join(written.withColumnRenamed("published_records", "written"), ["year", "month"], "left").join(
        shown.withColumnRenamed("published_records", "shown"), ["year", "month"], "left"
    ).where(~(bad & (F.col("year") == 1996) & (month == 8))).select(
        addresses.period(F.col("year"), month).alias("month"),
        (F.col("total_records") + F.when(bad & (month == 5), 1).otherwise(0)).alias("source_records"),
        (F.col("valid_records") + F.when(bad & (month == 6), 1).otherwise(0)).alias("valid_records"),
        "warning_records",
        F.when(bad & (month == 7), F.lit(-1)).otherwise(F.col("quarantined_records")).alias("quarantined_records"),
        F.coalesce("written", zero).alias("curated_records"),
        F.coalesce("shown", zero).alias("athena_records"),
    ).write.option("header", True).csv(path)
    return read_history(spark, path)


def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.history_totals(_history(spark, sf_dir))


def batch_pass_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.history_pass_rates(_history(spark, sf_dir))


def invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check on an intact history and on a damaged one."""
    intact, damaged = (
        metrics.history_checks(_history(spark, sf_dir, bad), EXPECTED_BATCHES).withColumn("damaged", F.lit(bad))
        for bad in (False, True)
    )
    return intact.unionByName(damaged)


# -- end to end ---------------------------------------------------------------------------------


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batches written, registered and reconciled; one row each."""
    source = trips(spark, sf_dir)
    return load_batches(spark, source, DATASET, PREFIX, scratch_lake(spark), scratch_table())


def _tuned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "batch_summary": batch_summary,
    "normalize_columns": normalize_columns,
    "canonical_types": canonical_types,
    **{f"rule_{rule.code.lower()}": _rule(rule.code) for rule in TRIPS.rules},
    "reason_arrays": reason_arrays,
    "classify_status": classify_status,
    "lineage_columns": lineage_columns,
    "curated_rows": curated_rows,
    "quarantine_rows": quarantine_rows,
    "written_metrics": written_metrics,
    "total_rows": total_rows,
    "status_counts": status_counts,
    "quality_metrics": quality_metrics,
    "quality_metrics_by_batch": quality_metrics_by_batch,
    "batch_counts": batch_counts,
    "batch_addresses": batch_addresses,
    "source_manifest": source_manifest,
    "manifest_changes": manifest_changes,
    "processed_runs": processed_runs,
    "pending_batches": pending_batches,
    "skipped_batches": skipped_batches,
    "latest_processed_counts": latest_processed_counts,
    "folded_counts": folded_counts,
    "folded_skips": folded_skips,
    "recorded_reruns": recorded_reruns,
    "single_run": single_run,
    "published_rows": published_rows,
    "published_quarantine": published_quarantine,
    "published_metrics": published_metrics,
    "partition_counts": partition_counts,
    "reconcile_batches": reconcile_batches,
    "reconcile_content": reconcile_content,
    "reconciliation_outcomes": reconciliation_outcomes,
    "partition_repair": partition_repair,
    "publication_state": publication_state,
    "published_objects": published_objects,
    "publication_summary_counts": publication_summary_counts,
    "batch_totals": batch_totals,
    "batch_pass_rates": batch_pass_rates,
    "invariants": invariants,
    **SERIES,
}

QUERIES = {name: _tuned(query) for name, query in _QUERIES.items()}
