"""Columns and types of raw Parquet files, read from their footers in tasks, many files side by side.

Spark takes the schema of one file for all files of a read. Months differ, so the files are looked at first and read in
groups of one schema each.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.sources.manifest import MOST_TASKS, address
from sievelake.sources.small import small_frame

COLUMNS_DDL = "batch_id STRING, path STRING, name STRING, kind STRING, error STRING"

# Whole numbers of growing size; each fits those after it.
_WHOLE = ("TINYINT", "SMALLINT", "INT", "BIGINT")
_REAL = ("FLOAT", "DOUBLE")
_TIMES = ("DATE", "TIMESTAMP_NTZ", "TIMESTAMP")
KINDS = (*_WHOLE, *_REAL, *_TIMES, "STRING", "BOOLEAN", "BINARY")


def wider(a: str, b: str) -> str | None:
    """The least type that both fit, None if there is none.

    Whole numbers fit DOUBLE, as Spark has it too: above 2^53 it does not hold every one.
    """
    if a == b:
        return a
    for chain in (_WHOLE, _REAL, _TIMES):
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    if {a, b} <= {*_WHOLE, *_REAL}:
        return "DOUBLE"
    return None


def fits(found: str, wanted: str) -> bool:
    return wider(found, wanted) == wanted


def _footers():
    """For mapInPandas; travels to the tasks by value, as workers need not have the package."""

    def rows(frames):
        import pandas as pd
        import pyarrow.parquet as pq

        plain = {
            "int8": "TINYINT", "uint8": "SMALLINT", "int16": "SMALLINT", "uint16": "INT", "int32": "INT", "uint32": "BIGINT",
            "int64": "BIGINT", "uint64": "DECIMAL(20,0)", "float": "FLOAT", "double": "DOUBLE", "string": "STRING",
            "large_string": "STRING", "bool": "BOOLEAN", "binary": "BINARY", "large_binary": "BINARY", "date32[day]": "DATE",
        }

        def kind(field, physical):
            text = str(field.type)
            if text.startswith("timestamp"):
                if physical.get(field.name) == "INT96" or "tz=" in text:
                    return "TIMESTAMP"
                return "TIMESTAMP_NANOS" if "[ns" in text else "TIMESTAMP_NTZ"
            if text.startswith("decimal"):
                return f"DECIMAL({field.type.precision},{field.type.scale})"
            return plain.get(text, text)

        def columns(place):
            if place.startswith("/"):
                file = pq.ParquetFile(place)
            else:
                from pyarrow import fs

                system, name = fs.FileSystem.from_uri(place)
                file = pq.ParquetFile(system.open_input_file(name))
            with file:
                leaves = [file.schema.column(i) for i in range(len(file.schema))]
                physical = {leaf.path: leaf.physical_type for leaf in leaves}
                return [(field.name, kind(field, physical)) for field in file.schema_arrow]

        for frame in frames:
            out = []
            for batch, path, place in zip(frame["batch_id"], frame["path"], frame["address"]):
                try:
                    found = columns(place)
                except Exception as error:  # of any kind: the file's batch is refused and says why
                    out.append((batch, path, None, None, f"{type(error).__name__}: {error}"))
                else:
                    out += [(batch, path, name, of, None) for name, of in found] or [(batch, path, None, None, "no column")]
            yield pd.DataFrame(out, columns=["batch_id", "path", "name", "kind", "error"])

    return rows


def file_columns(spark: SparkSession, files: Iterable[tuple[str, str]]) -> DataFrame:
    """One row per column of every file: batch_id, path, name, kind; of a file that cannot be read one row with the error.

    `files` are batch ids with file URIs.
    """
    rows = [(batch, path, address(path)) for batch, path in files]
    listed = small_frame(spark, rows, "batch_id STRING, path STRING, address STRING")
    return listed.repartition(min(max(1, len(rows)), MOST_TASKS)).mapInPandas(_footers(), COLUMNS_DDL)


def file_schemas(columns: DataFrame) -> DataFrame:
    """batch_id, path, schema of every readable file; schemas of equal names and types are equal texts, read by `parse`."""
    listed = F.array_sort(F.collect_list(F.struct("name", "kind")))
    return columns.where("name IS NOT NULL").groupBy("batch_id", "path").agg(F.to_json(listed).alias("schema"))


def parse(schema: str) -> dict[str, str]:
    return {column["name"]: column["kind"] for column in json.loads(schema)}
