"""What decisions need of a ledger: the newest state of every batch content.

A ledger grows without end, and its answers do not. `fold_ledger` writes the state of all complete appends as a
snapshot, sorted by key, with the names of the appends it holds; the ledger itself stays as it is. `ledger_state` reads the
newest snapshot and the appends that it does not name, so that a run reads what was appended since, not all history.
Appends have folders of their own and a snapshot has its name only when it is complete, so folding needs no lock: an append
that ends meanwhile is not named and is read by itself, and of two folds at once the newer one counts.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.operators.ledger import COUNTS, KEY, processing_completed
from sievelake.sinks import files
from sievelake.sources.ledger import SEQ, SNAPSHOTS, read_records
from sievelake.sources.small import small_frame

#: Appends that a run may find unfolded before it folds them.
FOLD_AFTER = 100
KEPT = f"struct<{', '.join(f'{name}: bigint' for name in COUNTS)}, ingested_at: string>"
_STATE = (
    f"batch_id STRING, source_checksum STRING, completed BOOLEAN, trusted BOOLEAN, kept {KEPT}, kept_seq {SEQ}, "
    f"trusted_kept {KEPT}, trusted_seq {SEQ}"
)


def state_of(records: DataFrame) -> DataFrame:
    """One row per (batch_id, source_checksum): is it done, and the counts of its last run that has them.

    Both twice: by the common rule, and by the one that trusts the transform (`trusted`). Maxima are combined map-side.
    """
    done, trusted = processing_completed(), processing_completed(True)
    counts = F.struct(*COUNTS, "ingested_at")
    counted = F.col("valid_records").isNotNull() & F.col("warning_records").isNotNull()
    facts = records.select(
        *KEY,
        done.alias("completed"),
        trusted.alias("trusted"),
        *[
            F.when(rule & counted, value).alias(name)
            for rule, names in ((done, ("kept", "kept_seq")), (trusted, ("trusted_kept", "trusted_seq")))
            for name, value in zip(names, (counts, F.col("seq")))
        ],
    )
    return merged(facts)


def merged(states: DataFrame) -> DataFrame:
    """States of several sources, or of single records, as one row per key."""
    return states.groupBy(*KEY).agg(
        F.bool_or("completed").alias("completed"),
        F.bool_or("trusted").alias("trusted"),
        F.max_by("kept", "kept_seq").alias("kept"),
        F.max("kept_seq").alias("kept_seq"),
        F.max_by("trusted_kept", "trusted_seq").alias("trusted_kept"),
        F.max("trusted_seq").alias("trusted_seq"),
    )


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    """Complete snapshots, the newest first."""
    found = files.children(spark, f"{path.rstrip('/')}/{SNAPSHOTS}")
    whole = files.for_each(files.exists, [(spark, f"{child}/_COMPLETE") for child in found])
    return sorted((child for child, there in zip(found, whole) if there), key=lambda c: c.rsplit("/", 1)[1], reverse=True)


def _appends(spark: SparkSession, path: str) -> dict[str, str]:
    """Folders and files of a ledger by name."""
    found = ((child.rsplit("/", 1)[1], child) for child in files.children(spark, path))
    return {name: child for name, child in found if name[:1] not in (".", "_")}


def _split(spark: SparkSession, path: str) -> tuple[str | None, list[str], list[str]]:
    """The newest snapshot, the names it holds, and the appends that it does not name."""
    newest = next(iter(_snapshots(spark, path)), None)
    held = [] if newest is None else [r["name"] for r in spark.read.schema("name STRING").json(f"{newest}/folded").collect()]
    known = set(held)
    return newest, held, [place for name, place in _appends(spark, path).items() if name not in known]


def _read(spark: SparkSession, newest: str | None, since: list[str]) -> DataFrame:
    parts = []
    if newest is not None:
        parts.append(spark.read.schema(_STATE).parquet(f"{newest}/state"))
    if since:
        parts.append(state_of(read_records(spark, since)))
    if not parts:
        return spark.createDataFrame([], _STATE)
    return parts[0] if len(parts) == 1 else merged(parts[0].unionByName(parts[1]))


def ledger_state(spark: SparkSession, path: str, batch_ids: Iterable[str] | None = None) -> DataFrame:
    """The state of every key of a ledger, or of those of some batches; Parquet skips what holds none of them."""
    newest, _, since = _split(spark, path)
    state = _read(spark, newest, since)
    return state if batch_ids is None else state.where(F.col("batch_id").isin(list(batch_ids)))


def unfolded(spark: SparkSession, path: str) -> int:
    return len(_split(spark, path)[2])


def fold_ledger(spark: SparkSession, path: str) -> str | None:
    """Write a new snapshot of all appends that are complete; its folder, or None if there is nothing new.

    The snapshot before it stays for readers that have just chosen it; older ones are removed.
    """
    newest, held, since = _split(spark, path)
    # a folder without its marker may still be written; files lie flat in ledgers made elsewhere and are whole
    marks = files.for_each(_whole, [(spark, place) for place in since])
    ready = [place for place, whole in zip(since, marks) if whole]
    if not ready:
        return None
    folder = f"{path.rstrip('/')}/{SNAPSHOTS}/{time.time_ns():020d}-{uuid.uuid4().hex}"
    state = _read(spark, newest, ready)
    state.repartitionByRange(*KEY).sortWithinPartitions(*KEY).write.parquet(f"{folder}/state")
    names = sorted({*held, *(place.rsplit("/", 1)[1] for place in ready)} & set(_appends(spark, path)))
    small_frame(spark, [(name,) for name in names], "name STRING").coalesce(1).write.json(f"{folder}/folded")
    files.create_empty(spark, f"{folder}/_COMPLETE")
    for old in _snapshots(spark, path)[2:]:
        files.remove(spark, old)
    return folder


def _whole(spark: SparkSession, place: str) -> bool:
    return files.is_complete(spark, place) or not files.is_folder(spark, place)


def completed_keys(state: DataFrame, trust_processing_status: bool = False) -> DataFrame:
    return state.where("trusted" if trust_processing_status else "completed").select(*KEY)


def latest_counts(state: DataFrame, trust_processing_status: bool = False) -> DataFrame:
    """Counts of the last completed run per key that has them."""
    kept = "trusted_kept" if trust_processing_status else "kept"
    return state.where(F.col(kept).isNotNull()).select(*KEY, f"{kept}.*")
