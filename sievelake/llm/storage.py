"""Tables and binary files in the shared folder that `spark.checkpoint.dir` names."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from sievelake.checks.adapter import scratch


def keep(df: DataFrame, folder: str | None = None) -> DataFrame:
    """`df` written to the shared folder and read again: its lineage ends there and survives lost executors."""
    path = folder or scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession) -> str:
    return scratch(spark)


def write_file(path: str, parts: Iterable[bytes]) -> None:
    """Write one binary file from inside a task.

    The file gets its name only when it is complete, and the name depends on the content's place alone:
    a task that is run again replaces what an earlier attempt left. Paths without a scheme and of
    `file:` are written by the operating system, those of other schemes by pyarrow's file systems.
    """
    if "://" not in path or path.startswith("file:"):
        target = path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")
        os.makedirs(os.path.dirname(target), exist_ok=True)
        attempt = f"{os.path.dirname(target)}/.{uuid.uuid4().hex}"
        with open(attempt, "wb") as out:
            for part in parts:
                out.write(part)
        os.replace(attempt, target)
        return
    from pyarrow import fs

    system, target = fs.FileSystem.from_uri(path)
    parent = target.rpartition("/")[0]
    system.create_dir(parent, recursive=True)
    attempt = f"{parent}/.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as out:
        for part in parts:
            out.write(part)
    system.move(attempt, target)
