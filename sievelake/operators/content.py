"""Do two tables hold the same rows, partition by partition? Equal counts do not tell.

A digest of a multiset of rows: their count, the sum and the XOR of two independent 64-bit hashes of each row. It needs no
order, and parts of it merge to the whole, so that it is combined map-side and a hot partition sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.profiles import ADDED_COLUMNS, TRIPS, Profile

DIGEST = ("rows", "sum_a", "xor_a", "sum_b", "xor_b")
#: When a run stamped a row says nothing of what the row is.
NOT_CONTENT = ("ingested_at",)


def content_columns(df: DataFrame, profile: Profile = TRIPS) -> list[Column]:
    """All columns by which rows are compared: the table's, in its types, null where `df` lacks one."""
    there = {name.lower() for name in df.columns}
    return [
        (F.col(f"`{name}`") if name.lower() in there else F.lit(None)).cast(kind).alias(name)
        for name, kind in profile.columns + ADDED_COLUMNS
        if name not in NOT_CONTENT
    ]


def content_digests(df: DataFrame, by: Sequence[str] = ("year", "month"), profile: Profile = TRIPS) -> DataFrame:
    """One row per group of `by`: rows, sum_a, xor_a, sum_b, xor_b."""
    columns = content_columns(df, profile)
    # nulls leave a hash as it is, so which columns are null is hashed as well
    nulls = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in columns])
    a, b = F.xxhash64(*columns, nulls), F.xxhash64(F.lit("second"), nulls, *reversed(columns))
    hashed = df.select(*[F.col(name).cast("int").alias(name) for name in by], a.alias("a"), b.alias("b"))
    wide = [F.sum(F.col(h).cast("decimal(20,0)")).alias(f"sum_{h}") for h in "ab"]
    return hashed.groupBy(*by).agg(F.count("*").alias("rows"), wide[0], F.bit_xor("a").alias("xor_a"), wide[1], F.bit_xor("b").alias("xor_b"))


def reconcile_content(expected: DataFrame, found: DataFrame, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """Digests compared: expected_records, published_records, and MATCH, COUNT_MISMATCH or CONTENT_MISMATCH.

    A side without the partition counts 0, so a lost and an unexpected partition both show.
    """
    left = expected.select(*by, F.struct(*DIGEST).alias("wanted"))
    both = left.join(found.select(*by, F.struct(*DIGEST).alias("there")), list(by), "full_outer")
    zero = F.lit(0).cast("bigint")
    wanted, there = F.coalesce("wanted.rows", zero), F.coalesce("there.rows", zero)
    status = F.when(wanted != there, "COUNT_MISMATCH").when(F.col("wanted") == F.col("there"), "MATCH")
    return both.select(
        *by,
        wanted.alias("expected_records"),
        there.alias("published_records"),
        status.otherwise("CONTENT_MISMATCH").alias("reconciliation_status"),
    )
