"""A stored file manifest, of which a refresh hashes only files whose size or time has changed.

The manifest is a table in versions, each a folder that gets its marker when it is complete; the newest one counts. A refresh
of some paths replaces what is known of files below them and carries all else over. Of two refreshes at once one is
lost, which costs hashing again and nothing else.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.sinks import files
from sievelake.sources.manifest import MANIFEST_DDL, batch_checksums, hashed_files, with_batch_path
from sievelake.sources.small import small_frame

STORED_DDL = f"{MANIFEST_DDL}, sha256 STRING, change STRING, hashed BOOLEAN"
_FACTS = ("path", "size_bytes", "modified_ms", "sha256")


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Complete versions, the newest first."""
    found = files.children(spark, root)
    whole = files.for_each(files.is_complete, [(spark, child) for child in found])
    return sorted((c for c, there in zip(found, whole) if there), key=lambda c: c.rsplit("/", 1)[1], reverse=True)


def stored_manifest(spark: SparkSession, root: str) -> DataFrame:
    """path, size_bytes, modified_ms, sha256 of the newest version; empty before the first."""
    newest = next(iter(_versions(spark, root)), None)
    rows = small_frame(spark, [], STORED_DDL) if newest is None else spark.read.schema(STORED_DDL).parquet(newest)
    return rows.where("change IS NULL OR change <> 'removed'").select(*_FACTS)


def refresh_manifest(spark: SparkSession, root: str, paths: Iterable[str], rehash: bool = False) -> DataFrame:
    """Bring the manifest at `root` up to date with all files at or below `paths`.

    Returns one row per file below them that was known before or is found now: path, size_bytes, modified_ms, sha256, change
    (added, changed, removed, same), hashed. A file of the same size and time is taken as it is known, or with `rehash` read
    all the same; one that was only touched is read and found the same. The rows are those of the version written,
    which stays until the next refresh but one.
    """
    paths = list(paths)
    listed = {file for part in files.for_each(_listed, [(spark, path) for path in paths]) for file in part}
    now = small_frame(spark, sorted(listed), MANIFEST_DDL)
    known = stored_manifest(spark, root)
    before = known.select("path", *[F.col(c).alias(f"old_{c}") for c in ("size_bytes", "modified_ms", "sha256")])
    # the same facts for every run of the plan: what is to be hashed is settled on the driver, as names
    joined = now.join(before, "path", "left")
    alike = F.coalesce((F.col("size_bytes") == F.col("old_size_bytes")) & (F.col("modified_ms") == F.col("old_modified_ms")), F.lit(False))
    differs = F.lit(True) if rehash else ~alike
    asked = [tuple(r) for r in joined.where(differs).select("path", "size_bytes", "modified_ms").collect()]
    fresh = hashed_files(spark, asked).select("path", F.col("sha256").alias("new_sha256"))
    folders = [files.qualified(spark, path) for path in paths]
    below = F.lit(False)
    for folder in folders:
        below = below | (F.col("path") == folder) | F.col("path").startswith(f"{folder}/")
    gone = known.where(below).join(now.select("path"), "path", "left_anti")
    found = joined.join(fresh, "path", "left").withColumn("sha256", F.coalesce("new_sha256", "old_sha256"))
    change = F.when(F.col("old_sha256").isNull(), "added").when(F.col("old_sha256") != F.col("sha256"), "changed").otherwise("same")
    out = found.select(*_FACTS, change.alias("change"), F.col("new_sha256").isNotNull().alias("hashed")).unionByName(
        gone.select(*_FACTS, F.lit("removed").alias("change"), F.lit(False).alias("hashed"))
    )
    other = known.where(~below).select(*_FACTS, F.lit(None).cast("string").alias("change"), F.lit(False).alias("hashed"))
    version = f"{root.rstrip('/')}/{time.time_ns():020d}-{uuid.uuid4().hex}"
    out.unionByName(other).write.parquet(version)
    for old in _versions(spark, root)[2:]:
        files.remove(spark, old)
    return spark.read.schema(STORED_DDL).parquet(version).where("change IS NOT NULL")


def _listed(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    return files.all_files(spark, path) if files.exists(spark, path) else []


def stored_checksums(spark: SparkSession, root: str, paths: Iterable[str], rehash: bool = False) -> dict[str, str]:
    """Checksums of batches, given as files or folders, from a refreshed manifest; a missing path has no entry."""
    found = {files.qualified(spark, path): path for path in paths if files.exists(spark, path)}
    if not found:
        return {}
    changes = refresh_manifest(spark, root, list(found.values()), rehash)
    batches = small_frame(spark, [(uri,) for uri in found], "batch_path STRING")
    owned = with_batch_path(changes.where("change <> 'removed'").drop("change", "hashed"), batches)
    sums = {found[row["batch_path"]]: row["source_checksum"] for row in batch_checksums(owned).collect()}
    # a folder without a file
    return {path: sums.get(path, hashlib.sha256(b"").hexdigest()) for path in found.values()}
