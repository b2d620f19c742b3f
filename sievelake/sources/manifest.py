"""File manifests: path, size and SHA-256 of every source file.

Names come from the file system's listing, so that files without a byte have their row too. Files are read
inside tasks, many side by side, each in pieces, so that a file of any size takes the same small memory and the
same way. A task opens local files itself and others through pyarrow's file systems; a scheme
those do not know is refused by name before a job starts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.sinks.files import all_files, exists, for_each, qualified
from sievelake.sources.small import small_frame

PIECE = 8 * 1024 * 1024
MOST_TASKS = 20_000
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
MANIFEST_DDL = "path STRING, size_bytes BIGINT, modified_ms BIGINT"


def address(uri: str) -> str:
    """The path as a task opens it: local ones plain, others as a URI whose odd characters are escaped."""
    scheme, _, rest = uri.partition(":")
    if scheme not in SCHEMES:
        raise ValueError(f"files of scheme {scheme!r} cannot be hashed: {uri}")
    if scheme == "file":
        return "/" + rest.lstrip("/")
    return f"{SCHEMES[scheme]}:{quote(rest, safe='/@:')}"


def _hasher(piece: int):
    """For mapInPandas. A function made here travels to the tasks by value: workers need not have the package."""

    def rows(frames):
        import hashlib as hashes

        for frame in frames:
            digests = []
            for place in frame["address"]:
                if place.startswith("/"):
                    stream = open(place, "rb")
                else:
                    from pyarrow import fs

                    system, name = fs.FileSystem.from_uri(place)
                    stream = system.open_input_stream(name)
                digest = hashes.sha256()
                with stream:
                    while data := stream.read(piece):
                        digest.update(data)
                digests.append(digest.hexdigest())
            yield frame.assign(sha256=digests).drop(columns="address")

    return rows


def file_manifest(spark: SparkSession, paths: str | list[str], piece: int = PIECE) -> DataFrame:
    """One row per file under `paths`: path, source_file, size_bytes, modified_at, sha256."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    found = {file for part in for_each(all_files, [(spark, path) for path in listed]) for file in part}
    hashed = hashed_files(spark, found, piece)
    return hashed.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("source_file"),
        "size_bytes",
        F.timestamp_millis("modified_ms").alias("modified_at"),
        "sha256",
    )


def hashed_files(spark: SparkSession, found: Iterable[tuple[str, int, int]], piece: int = PIECE) -> DataFrame:
    """path, size_bytes, modified_ms, sha256 of listed files."""
    rows = [(*file, address(file[0])) for file in sorted(found)]
    # As many partitions as files, by number, which adaptive execution leaves alone: a row here is a whole file.
    files = small_frame(spark, rows, f"{MANIFEST_DDL}, address STRING").repartition(min(max(1, len(rows)), MOST_TASKS))
    return files.mapInPandas(_hasher(piece), f"{MANIFEST_DDL}, sha256 STRING")


def with_batch_path(manifest: DataFrame, batches: DataFrame) -> DataFrame:
    """Attach to each file the batch it belongs to; `batches` has one `batch_path` URI per batch.

    A file belongs to the batch whose path is its own or one of its folders. Each
    file lists its folders (a handful), so this is an equi-join and no prefix search.
    """
    depth = F.size(F.split("path", "/"))
    folders = manifest.select("*", F.explode(F.sequence(F.lit(1), depth)).alias("_depth")).select(
        *manifest.columns, F.expr("substring_index(path, '/', _depth)").alias("batch_path")
    )
    return folders.join(batches.select("batch_path"), "batch_path")


def batch_checksums(manifest: DataFrame) -> DataFrame:
    """Checksum per `batch_path` of a manifest.

    A batch of one file has that file's SHA-256. A batch given as a directory has
    a digest of its file names and digests, folded by XOR: it needs no order and
    a fixed-size buffer, so a batch of a million files is combined map-side too.
    """
    name = F.expr("substring(path, length(batch_path) + 1)")
    mark = F.sha2(F.concat_ws(":", name, F.col("sha256")), 256)
    # The 256 bits as eight words; sixteen hex digits would not fit a signed bigint.
    words = [F.conv(F.substring(mark, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(8)]
    folded = manifest.groupBy("batch_path").agg(
        F.count("*").alias("file_count"),
        F.sum("size_bytes").alias("size_bytes"),
        F.min("sha256").alias("only_sha256"),
        *[F.bit_xor(word).alias(f"word_{i}") for i, word in enumerate(words)],
    )
    digest = F.sha2(
        F.concat_ws("|", "file_count", "size_bytes", *[f"word_{i}" for i in range(8)]), 256
    )
    return folded.select(
        "batch_path",
        "file_count",
        "size_bytes",
        F.when(F.col("file_count") == 1, F.col("only_sha256")).otherwise(digest).alias("source_checksum"),
    )


def source_checksum(spark: SparkSession, path: str) -> str:
    """Checksum of one batch, given as a file or a directory."""
    files = file_manifest(spark, path).withColumn("batch_path", F.lit(qualified(spark, path)))
    found = batch_checksums(files).first()
    return found["source_checksum"] if found else hashlib.sha256(b"").hexdigest()


def source_checksums(spark: SparkSession, paths: Iterable[str]) -> dict[str, str]:
    """Checksums of many batches by one job; a path without files has no entry."""
    found = {qualified(spark, path): path for path in paths if exists(spark, path)}
    if not found:
        return {}
    batches = small_frame(spark, [(uri,) for uri in found], "batch_path STRING")
    files = with_batch_path(file_manifest(spark, list(found)), batches)
    return {found[row["batch_path"]]: row["source_checksum"] for row in batch_checksums(files).collect()}
