"""What lies in the output folders of many batches, listed in tasks side by side.

The driver hands out folder names and gets one row per folder, by one job for any number of batches. Spark's own file sources
pass over markers, so folders are listed by the operating system or by pyarrow's file systems, as files are hashed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from sievelake.batch import Batch, Lake
from sievelake.sinks.files import SUCCESS, all_files, exists, for_each, is_complete, object_count, qualified
from sievelake.sources.manifest import MOST_TASKS, address
from sievelake.sources.small import small_frame

LISTED_DDL = "batch_id STRING, kind STRING, folder STRING, objects BIGINT, data_files BIGINT, size_bytes BIGINT, complete BOOLEAN"
#: Folders a task lists, at least.
FOLDERS = 16


def _lister(marker: str):
    """For mapInPandas; travels to the tasks by value, as workers need not have the package."""

    def below(place):
        """(name, size) of all files below a folder; none if it does not exist."""
        import os

        if place.startswith("/"):
            for folder, _, names in os.walk(place):
                for name in names:
                    yield os.path.relpath(os.path.join(folder, name), place), os.path.getsize(os.path.join(folder, name))
            return
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(place)
        for found in system.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True)):
            if found.type == fs.FileType.File:
                yield found.path[len(root) :].lstrip("/"), found.size

    def rows(frames):
        for frame in frames:
            out = {"objects": [], "data_files": [], "size_bytes": [], "complete": []}
            for place in frame["address"]:
                names = [(name.rsplit("/", 1)[-1], size) for name, size in below(place)]
                shown = [(name, size) for name, size in names if not name.startswith(".") and not name.endswith(".crc")]
                data = [size for name, size in shown if not name.startswith("_")]
                out["objects"].append(len(shown))
                out["data_files"].append(len(data))
                out["size_bytes"].append(sum(data))
                out["complete"].append(any(name == marker for name, _ in shown))
            yield frame.drop(columns="address").assign(**out)

    return rows


def _by_driver(spark: SparkSession, folder: str) -> tuple[int, int, int, bool]:
    data = [size for name, size, _ in (all_files(spark, folder) if exists(spark, folder) else []) if not name.endswith(".crc")]
    return object_count(spark, folder), len(data), sum(data), is_complete(spark, folder)


def listed_outputs(spark: SparkSession, places: Iterable[tuple[Batch, Lake]]) -> DataFrame:
    """Per batch and output (curated, quarantine, metrics), batches given with their lakes at their versions:

    batch_id, kind, folder; objects (data files and markers, without checksum and dot files), data_files, size_bytes, and
    complete: is the marker there?
    """
    asked = [
        (batch.batch_id, kind, qualified(spark, folder))
        for batch, lake in places
        for kind, folder in (("curated", lake.curated(batch)), ("quarantine", lake.quarantine(batch)), ("metrics", lake.metrics(batch)))
    ]
    try:
        rows = [(*row, address(row[2])) for row in asked]
    except ValueError:  # a file system that tasks cannot open by themselves
        found = for_each(_by_driver, [(spark, row[2]) for row in asked])
        return small_frame(spark, [(*row, *facts) for row, facts in zip(asked, found)], LISTED_DDL)
    folders = small_frame(spark, rows, "batch_id STRING, kind STRING, folder STRING, address STRING")
    dealt = folders.repartition(min(max(1, -(-len(rows) // FOLDERS)), MOST_TASKS))
    return dealt.mapInPandas(_lister(SUCCESS), LISTED_DDL)
