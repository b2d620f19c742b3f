"""A batch series in one pass: every step is taken for all batches at once.

The number of Spark jobs does not grow with the number of batches: sources are hashed by one job, the
ledger and the raw manifest are read once, what is new is written by the same few jobs, and one append
records all runs. Files are looked at by their footers beforehand and read in groups of one schema each. Rare cases alone are handled
batch by batch: publications to be restored, sources without a row, and the search for batches that made a job fail.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import replace
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.batch import Batch
from sievelake.operators import ledger as ledgers
from sievelake.operators.classify import utc_now
from sievelake.operators.drift import refusal, schema_drift
from sievelake.operators.ledger import COUNTS, KEY
from sievelake.operators.reconcile import partition_counts
from sievelake.operators.schema import normalize
from sievelake.plans import series
from sievelake.plans.load import classified_normal, of_batches
from sievelake.plans.series import Site
from sievelake.sinks import catalog, files, publish
from sievelake.sinks.outputs import write_batches, write_periods
from sievelake.sources.ledger import append_records
from sievelake.sources.ledger_state import FOLD_AFTER, completed_keys, fold_ledger, latest_counts, ledger_state, unfolded
from sievelake.sources.manifest_store import stored_checksums
from sievelake.sources.schemas import file_columns, file_schemas, parse, wider
from sievelake.sources.small import small_frame

_PERIOD = "sievelake_period"


def read_batches(spark: SparkSession, paths: Iterable[str], source_prefix: str) -> DataFrame:
    """Rows of many raw files or folders; `year` and `month` come from the name, as files do not hold them."""
    try:
        trips = spark.read.option("recursiveFileLookup", True).parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such input: {error}") from error
        raise
    # Evaluated for every row: one search for both parts, and names without escapes are taken as they are.
    path = F.col("_metadata.file_path")
    place = F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    period = F.regexp_extract(place, rf"{source_prefix}_(\d{{4}}-\d{{2}})\.parquet(?:/|$)", 1)
    named = trips.withColumn(_PERIOD, period)
    parts = {"year": F.substring(_PERIOD, 1, 4), "month": F.substring(_PERIOD, 6, 2)}
    return named.withColumns({part: text.cast("int") for part, text in parts.items()}).drop(_PERIOD)


class SeriesFailed(RuntimeError):
    """Batches of a series failed; all runs are recorded. `errors` holds each failed batch's own error."""

    def __init__(self, errors: dict[Batch, Exception]):
        super().__init__("; ".join(f"{batch.batch_id}: {error}" for batch, error in errors.items()))
        self.errors = errors


def run_all(spark: SparkSession, batches: Iterable[Batch], site: Site) -> list[dict[str, Any]]:
    """Bring all batches to their final state and return their run records, in order.

    `site` needs a lake. A batch that fails (its source is missing, unreadable, without a required column, of a type the
    table cannot hold or replaced while it is read, its rows cannot be processed, its counts do not agree) keeps no
    other from being finished. All runs are recorded before an error is raised: the batch's own, or `SeriesFailed` for several.
    """
    if site.lake is None:
        raise ValueError("a series in one pass publishes: it needs a lake")
    batches = list(batches)
    if len({(b.dataset, b.source_prefix, b.schema_version) for b in batches}) > 1:
        raise ValueError("a series in one pass holds one dataset")
    if site.lake.versioned and not site.registers:
        raise ValueError("a versioned lake needs a table, which names the versions to be read")
    if not batches:
        return []
    run = _Run(spark, site, batches)
    run.attempt(_all_steps, batches)
    failed = _finish(run)
    append_records(spark, site.ledger, [r for r in run.records.values() if r.pop("_recorded")])
    if unfolded(spark, site.ledger) > FOLD_AFTER:
        fold_ledger(spark, site.ledger)
    if len(failed) == 1:
        raise next(iter(failed.values()))
    if failed:
        raise SeriesFailed(failed)
    return list(run.records.values())


class _Run:
    """Records and errors of a series under way."""

    def __init__(self, spark: SparkSession, site: Site, batches: list[Batch]):
        self.spark, self.site, self.batches = spark, site, batches
        self.records = {batch: _started(batch, site) for batch in batches}
        self.errors: dict[Batch, Exception] = {}
        self.old: list[Batch] = []
        #: The layout in which each batch's outputs lie, in a versioned lake that of this run or of an earlier one.
        self.lake = site.lake.at(uuid.uuid4().hex) if site.lake.versioned else site.lake
        self.lakes = dict.fromkeys(batches, self.lake)

    def at(self, batch: Batch) -> Site:
        return replace(self.site, lake=self.lakes[batch])

    def left(self, batches: Iterable[Batch] | None = None) -> list[Batch]:
        """Those of `batches` (or of all) that have not failed."""
        return [batch for batch in (self.batches if batches is None else batches) if batch not in self.errors]

    def fail(self, batch: Batch, error: Exception) -> None:
        self.errors.setdefault(batch, error)

    def attempt(self, step, batches: Iterable[Batch]) -> None:
        """A step for all batches at once; if it fails, those left share its error."""
        asked = self.left(batches)
        if asked:
            try:
                step(self, asked)
            except Exception as error:
                for batch in self.left(asked):
                    self.fail(batch, error)


def _all_steps(run: _Run, batches: list[Batch]) -> None:
    spark, site, records = run.spark, run.site, run.records
    for batch, there in zip(batches, _exist(spark, batches, site)):
        if not there:
            run.fail(batch, FileNotFoundError(f"no such input: {site.source(batch)}"))
    facts = _facts(spark, run.left(), site)
    root = site.lake.file_manifest_root(batches[0].dataset)
    checksums = stored_checksums(spark, root, {site.source(batch) for batch in run.left()}, site.rehash)
    for batch in run.left():
        records[batch]["source_checksum"] = checksums[site.source(batch)]

    keys = small_frame(
        spark,
        [(b.batch_id, records[b]["source_checksum"]) for b in run.left()],
        "batch_id STRING, source_checksum STRING",
    )
    state = ledger_state(spark, site.ledger, [b.batch_id for b in run.left()])
    known = keys.join(completed_keys(state, site.trust_processing_status), KEY, "left_semi")
    counted = latest_counts(state, site.trust_processing_status)
    done = {row["batch_id"]: row for row in known.join(counted, KEY, "left").collect()}
    new = [batch for batch in run.left() if batch.batch_id not in done]
    run.old = [batch for batch in run.left() if batch.batch_id in done]

    run.attempt(lambda run, some: _write_new(run, some, facts), new)
    for batch in _changed(spark, run.left(new), site, facts):
        records[batch]["processing_status"] = records[batch]["s3_publish_status"] = "FAILED"
        run.fail(batch, RuntimeError(f"source of {batch.batch_id} was replaced while it was read"))
    run.attempt(lambda run, some: _resume_old(run, some, done), run.old)
    fresh = [b for b in run.left() if records[b]["s3_publish_status"] in ("SUCCESS", "BACKFILLED")]
    run.attempt(_publish, fresh)
    run.attempt(_register, run.batches)
    run.attempt(_reconcile, run.batches)


def _publish(run: _Run, batches: list[Batch]) -> None:
    spark, records = run.spark, run.records
    _publish_manifests(run, batches)
    counted = publish.publication_summaries(spark, [(b, run.lakes[b]) for b in batches]).collect()
    summaries = {row["batch_id"]: row for row in counted}
    for batch in batches:
        for name in ("curated_object_count", "quarantine_object_count", "quality_object_count"):
            records[batch][f"s3_{name}"] = summaries[batch.batch_id][name]


def _started(batch: Batch, site: Site) -> dict[str, Any]:
    return {
        "run_id": str(uuid.uuid4()),
        "batch_id": batch.batch_id,
        "dataset": batch.dataset,
        "period": batch.period,
        "source_file": batch.source_file,
        "source_path": site.source(batch),
        "schema_version": batch.schema_version,
        "started_at": utc_now(),
        "status": "STARTED",
        "reconciliation_status": "NOT_RUN",
        "s3_publish_enabled": True,
        "s3_bucket": site.lake.root,
        "glue_registration_enabled": site.registers,
        "athena_reconciliation_enabled": site.reconciles,
    }


def _exist(spark: SparkSession, batches: list[Batch], site: Site) -> list[bool]:
    return files.for_each(files.exists, [(spark, site.source(batch)) for batch in batches])


def _facts(spark: SparkSession, batches: list[Batch], site: Site) -> dict[Batch, list]:
    """Names, sizes and times of the sources' files."""
    found = files.for_each(files.all_files, [(spark, site.source(batch)) for batch in batches])
    return {batch: sorted(listed) for batch, listed in zip(batches, found)}


def _changed(spark: SparkSession, batches: list[Batch], site: Site, before: dict[Batch, list]) -> list[Batch]:
    after = _facts(spark, batches, site)
    return [batch for batch in batches if after[batch] != before[batch]]


class _Sources:
    """New sources as their footers show them: what is refused, and which files are read together."""

    def __init__(self, spark: SparkSession, batches: list[Batch], site: Site, facts: dict[Batch, list]):
        self.spark, self.site = spark, site
        columns = file_columns(spark, [(b.batch_id, path) for b in batches for path, _, _ in facts[b]]).persist()
        try:
            self.report = {row["batch_id"]: row for row in schema_drift(columns, site.profile, site.cast).collect()}
            schemas = file_schemas(columns).persist()
            least, most = F.min("schema"), F.max("schema")
            whole = schemas.groupBy("batch_id").agg(least.alias("schema"), (least != most).alias("mixed")).collect()
            self.schema = {row["batch_id"]: row["schema"] for row in whole if not row["mixed"]}
            mixed = [row["batch_id"] for row in whole if row["mixed"]]
            # files of one batch that differ are read apart; all others by their batch's path
            apart = schemas.where(F.col("batch_id").isin(mixed)).collect() if mixed else []
            self.files: dict[str, list[tuple[str, str]]] = {}
            for row in apart:
                self.files.setdefault(row["batch_id"], []).append((row["schema"], row["path"]))
            schemas.unpersist()
        finally:
            columns.unpersist()

    def refusal(self, batch: Batch) -> str | None:
        row = self.report.get(batch.batch_id)
        if row is None:
            return f"no file in {self.site.source(batch)}"
        return None if row["accepted"] else refusal(row)

    def normal(self, batches: list[Batch]) -> DataFrame:
        """Rows under canonical names: one scan for each distinct schema, united by name.

        A column that some files lack is null for their rows. Where types differ, all take the least that holds them,
        or the table's with `cast`; what is unknown to the profile and has no such type becomes text.
        """
        groups: dict[str, list[str]] = {}
        for batch in batches:
            if batch.batch_id in self.schema:
                groups.setdefault(self.schema[batch.batch_id], []).append(self.site.source(batch))
            for schema, path in self.files.get(batch.batch_id, []):
                groups.setdefault(schema, []).append(path)
        profile, kinds = self.site.profile, {}
        for schema in groups:
            for name, kind in parse(schema).items():
                kinds.setdefault(profile.renames.get(name, name).lower(), set()).add(kind)
        common = {name: reduce(lambda a, b: a and wider(a, b), sorted(found)) or "STRING" for name, found in kinds.items() if len(found) > 1}
        declared = dict(profile.columns) if self.site.cast else {}
        frames = []
        for paths in groups.values():
            rows = normalize(read_batches(self.spark, paths, batches[0].source_prefix), profile, self.site.cast)
            united = [F.col(f"`{c}`").cast(common[c.lower()]).alias(c) if c.lower() in common and c not in declared else F.col(f"`{c}`") for c in rows.columns]
            frames.append(rows.select(*united))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _write_new(run: _Run, new: list[Batch], facts: dict[Batch, list]) -> None:
    """Transform and write new batches together.

    Sources are looked at first, and what cannot be processed is refused by name. If the common job fails nevertheless, it
    is traced to its batches by halving, and the others are written by one more job.
    """
    spark, site, records = run.spark, run.site, run.records
    sources = _Sources(spark, new, site, facts)
    for batch in new:
        if reason := sources.refusal(batch):
            run.fail(batch, ValueError(reason))
    some, now = new[0], utc_now()

    def rows(batches: list[Batch]) -> DataFrame:
        return classified_normal(sources.normal(batches), some.dataset, some.source_prefix, some.schema_version, site.profile, now)

    def write(batches: list[Batch]) -> list[dict[str, Any]]:
        # A raw file belongs to one month: rows lie together already and are not shuffled.
        return write_batches(rows(batches), run.lake, some.dataset, clustered=True) if batches else []

    try:
        written = write(run.left(new))
    except Exception:
        culprits = _culprits(rows, run.left(new))
        if not culprits:
            raise
        for batch, error in culprits.items():
            run.fail(batch, error)
        written = write(run.left(new))
    counts = {(row["year"], row["month"]): row for row in written}
    for batch in run.left(new):
        records[batch].update(ingested_at=now, processing_status="SUCCESS", s3_publish_status="SUCCESS")
        row = counts.get((batch.year, batch.month))
        if row is None:  # a source without a row has outputs without a row
            records[batch].update(series.transform(spark, batch, run.at(batch), now))
        else:
            kept = {name: row[name] or 0 for name in COUNTS if name != "rows_read"}
            records[batch].update(rows_read=sum(kept.values()), **kept)


def _culprits(rows: Callable[[list[Batch]], DataFrame], batches: list[Batch]) -> dict[Batch, Exception]:
    """Batches whose rows cannot be read and checked, with their errors: of n batches k bad ones take some 2 k log n jobs."""
    try:
        rows(batches).write.format("noop").mode("overwrite").save()
    except Exception as error:
        if len(batches) == 1:
            return {batches[0]: error}
        half = len(batches) // 2
        return _culprits(rows, batches[:half]) | _culprits(rows, batches[half:])
    return {}


def _resume_old(run: _Run, old: list[Batch], done: dict[str, Any]) -> None:
    spark, lake, records = run.spark, run.site.lake, run.records
    for batch, place in publish.published_versions(spark, lake, old).items():
        run.lakes[batch] = place if place.version or not lake.versioned else run.lake
    state = publish.published_batches(spark, lake, [(b, records[b]["source_checksum"]) for b in old], run.lakes)
    published = {row["batch_id"] for row in state.where("published").select("batch_id").collect()}
    for batch in old:
        record, known = records[batch], done[batch.batch_id].asDict()
        record["processing_status"] = "SKIPPED_ALREADY_PROCESSED"
        record.update({n: known[n] for n in (*COUNTS, "ingested_at") if known.get(n) is not None})
        if batch.batch_id in published:
            record["s3_publish_status"] = "EXISTS"
        else:
            # never into a version that may be read
            run.lakes[batch] = run.lake
            series.restore(spark, batch, run.at(batch), record.get("ingested_at") or utc_now())
            record["s3_publish_status"] = "BACKFILLED"


def _publish_manifests(run: _Run, batches: list[Batch]) -> None:
    rows = [
        (
            b.period, b.dataset, b.period, b.source_file, files.qualified(run.spark, run.site.source(b)),
            run.records[b]["source_checksum"], run.lakes[b].version,
        )
        for b in batches
    ]
    manifest = small_frame(run.spark, rows, f"of STRING, {publish.MANIFEST_DDL}").coalesce(1)
    root = run.site.lake.manifest_root(batches[0].dataset)
    write_periods(manifest, root, [b.period for b in batches], "json", "of")


def _register(run: _Run, batches: list[Batch]) -> None:
    site = run.site
    created = catalog.register_partitions(run.spark, site.table, run.lakes, batches) if site.registers else {}
    for batch in batches:
        run.records[batch]["glue_partition_status"] = catalog.partition_status(created.get(batch))


def _reconcile(run: _Run, batches: list[Batch]) -> None:
    """One count of all the batches' partitions, from footers, against the processed counts."""
    site, records = run.site, run.records
    if not site.reconciles:
        for batch in batches:
            records[batch]["reconciliation_status"] = "DISABLED"
        return
    for batch in batches:
        records[batch]["reconciliation_status"] = "FAILED"  # until it is known better
    found = partition_counts(run.spark.table(site.table).where(of_batches(batches))).collect()
    counts = {(row["year"], row["month"]): row["published_records"] for row in found}
    for batch in batches:
        record = records[batch]
        if record.get("valid_records") is None or record.get("warning_records") is None:
            run.fail(batch, ledgers.no_counts(batch.batch_id))
            continue
        expected = record["valid_records"] + record["warning_records"]
        there = counts.get((batch.year, batch.month), 0)
        record.update(
            year=batch.year,
            month=batch.month,
            expected_records=expected,
            athena_records=there,
            difference=there - expected,
            reconciliation_status="MATCH" if there == expected else "MISMATCH",
        )
        if there != expected:
            said = f"reconciliation MISMATCH for {batch.batch_id}: expected {expected}, found {there}"
            run.fail(batch, RuntimeError(said))


def _finish(run: _Run) -> dict[Batch, Exception]:
    """Final status of every record, and whether it is to be recorded; the errors in order of the batches."""
    for batch, record in run.records.items():
        error = run.errors.get(batch)
        record.update(status="FAILED" if error else "SUCCESS", completed_at=utc_now())
        if error:
            record.update(error_type=type(error).__name__, error_message=str(error))
            record.setdefault("s3_publish_status", "FAILED")
            record.setdefault("glue_partition_status", "FAILED" if run.site.registers else "DISABLED")
        worth = (
            record["s3_publish_status"] == "BACKFILLED"
            or record["glue_partition_status"] == "CREATED"
            or record["reconciliation_status"] == "MATCH"
        )
        record["_recorded"] = bool(error) or batch not in run.old or worth
    return {batch: run.errors[batch] for batch in run.batches if batch in run.errors}
