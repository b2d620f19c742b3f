"""Batch addresses as Column expressions over a (year, month) pair.

They give the same text as `Batch`, for work on many batches in one DataFrame.
Padding and concatenation are used since `format_string` costs a formatter per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_string(month: Column) -> Column:
    return F.lpad(month.cast("string"), 2, "0")


def _dated(prefix: str, year: Column, between: str, month: Column, suffix: str = "") -> Column:
    parts = [F.lit(prefix), year.cast("string"), F.lit(between), month_string(month), F.lit(suffix)]
    return F.concat(*parts)


def period(year: Column, month: Column) -> Column:
    return _dated("", year, "-", month)


def batch_id(dataset: str, year: Column, month: Column) -> Column:
    return _dated(f"{dataset}_", year, "_", month)


def source_file(source_prefix: str, year: Column, month: Column) -> Column:
    return _dated(f"{source_prefix}_", year, "-", month, ".parquet")


def curated_prefix(dataset: str, year: Column, month: Column) -> Column:
    return _dated(f"curated/{dataset}/year=", year, "/month=", month)
