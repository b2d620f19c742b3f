"""Source contract: required columns and canonical names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.profiles import TRIPS, Profile


def require_columns(df: DataFrame, profile: Profile = TRIPS) -> None:
    """Refuse a source without the required columns. Names are compared case-sensitively."""
    missing = sorted(set(profile.required).difference(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def normalize(df: DataFrame, profile: Profile = TRIPS, cast: bool = False) -> DataFrame:
    """Rename to canonical names in one projection; other columns pass through, order is kept.

    Aliasing is exact about case, where `withColumnsRenamed` is not. With `cast`
    the canonical columns also take the table's types, which keeps months whose
    files drifted (INT for BIGINT, text for numbers) readable as one table.
    """
    require_columns(df, profile)
    types = dict(profile.columns) if cast else {}
    selected = []
    for source in df.columns:
        name = profile.renames.get(source, source)
        column = F.col("`" + source.replace("`", "``") + "`")
        if name in types:
            column = column.cast(types[name])
        selected.append(column.alias(name))
    return df.select(*selected)
