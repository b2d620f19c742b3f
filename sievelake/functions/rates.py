"""Shares in percent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.round(part / whole * 100, digits)
