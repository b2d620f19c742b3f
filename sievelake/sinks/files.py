"""The few file-system questions a run asks from the driver, on any Hadoop file system.

They concern names only: no file content passes through here.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

SUCCESS = "_SUCCESS"


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def for_each(action: Callable[..., object], items: Iterable[tuple]) -> list:
    """Apply a file-system call to many batches; each waits on the store, so some wait together."""
    with ThreadPoolExecutor(16) as pool:
        return [done.result() for done in [pool.submit(action, *item) for item in items]]


def qualified(spark: SparkSession, path: str) -> str:
    """Full URI as Spark reports it in `_metadata.file_path` and in the catalog."""
    system, target = _open(spark, path)
    return system.makeQualified(target).toString()


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Does the output carry the marker Spark leaves once all its files are in place?"""
    return exists(spark, f"{path.rstrip('/')}/{SUCCESS}")


def mark_complete(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, f"{path.rstrip('/')}/{SUCCESS}")
    system.mkdirs(target.getParent())
    system.create(target, True).close()


def create_empty(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    system.create(target, False).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, such as a note beside data, in the place of an older one."""
    system, target = _open(spark, path)
    stream = system.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    return spark.read.text(path, wholetext=True).first()["value"]


def is_folder(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.getFileStatus(target).isDirectory()


def remove(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    system.delete(target, True)


def replace_directory(spark: SparkSession, source: str, target: str) -> None:
    """Put a finished output in the place of an older one, which comes back if the move fails."""
    system, target_path = _open(spark, target)
    _, source_path = _open(spark, source)
    _, aside = _open(spark, f"{target.rstrip('/')}.{uuid.uuid4().hex}")
    older = system.exists(target_path)
    system.mkdirs(target_path.getParent())
    if older and not system.rename(target_path, aside):
        raise OSError(f"cannot move {target} aside")
    try:
        moved = system.rename(source_path, target_path)
    except Exception:
        if older:
            system.rename(aside, target_path)
        raise
    if not moved:
        if older:
            system.rename(aside, target_path)
        raise OSError(f"cannot move {source} to {target}")
    if older:
        system.delete(aside, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Full URIs of what lies directly in a folder; none if it does not exist."""
    system, target = _open(spark, path)
    return [status.getPath().toString() for status in system.listStatus(target)] if system.exists(target) else []


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed, in milliseconds."""
    system, target = _open(spark, path)
    return system.getFileStatus(target).getModificationTime()


def all_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """URI, size and modification time (milliseconds) of every file at or below a path, empty ones included.

    As in Spark's own listings, names that begin with a dot or an underscore are passed over.
    """
    system, target = _open(spark, path)
    if not system.exists(target):
        raise FileNotFoundError(f"no such input: {path}")
    base, found = system.makeQualified(target).toString(), []
    listing = system.listFiles(target, True)
    while listing.hasNext():
        status = listing.next()
        name = status.getPath().toString()
        if not any(part[:1] in (".", "_") for part in name[len(base) :].split("/")):
            found.append((name, status.getLen(), status.getModificationTime()))
    return found


def object_count(spark: SparkSession, path: str) -> int:
    """Published objects under a path: data files and the marker, without checksum and dot files."""
    system, target = _open(spark, path)
    if not system.exists(target):
        return 0
    found = 0
    listing = system.listFiles(target, True)
    while listing.hasNext():
        name = listing.next().getPath().getName()
        found += not (name.startswith(".") or name.endswith(".crc"))
    return found


def has_objects(spark: SparkSession, path: str) -> bool:
    """Is there at least one object under the path? Stops at the first."""
    system, target = _open(spark, path)
    return system.exists(target) and system.listFiles(target, True).hasNext()
