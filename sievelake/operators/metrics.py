"""Counts, rates and checks.

Every aggregate here is algebraic, so Spark combines it map-side: a batch that
holds a third of all rows sends one row per task through the shuffle, not its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.functions.rates import percent
from sievelake.profiles import QUARANTINE, VALID, WARNING


def total_records(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_records"))


def status_counts(classified: DataFrame, ordered: bool = True) -> DataFrame:
    counts = classified.groupBy("validation_status").agg(F.count("*").alias("count"))
    return counts.orderBy("validation_status") if ordered else counts


def count_columns() -> list[Column]:
    """The four counts. On no rows the three sums are null, not 0."""

    def having(status: str) -> Column:
        return F.sum(F.when(F.col("validation_status") == status, 1).otherwise(0))

    return [
        F.count("*").alias("total_records"),
        having(VALID).alias("valid_records"),
        having(WARNING).alias("warning_records"),
        having(QUARANTINE).alias("quarantined_records"),
    ]


def with_rates(counts: DataFrame) -> DataFrame:
    passed = F.col("valid_records") + F.col("warning_records")
    total = F.col("total_records")
    return counts.withColumns(
        {
            "quality_pass_rate": percent(passed, total),
            "quarantine_rate": percent(F.col("quarantined_records"), total),
        }
    )


def quality_metrics(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts and rates of the whole input, or one row per group of `by` (such as `batch_id`)."""
    return with_rates(classified.groupBy(*by).agg(*count_columns()))


def batch_summary(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Ledger counts from metrics: a status without rows counts 0, rows read is the sum of statuses."""
    valid, warning, quarantine = (
        F.coalesce(F.col(name), F.lit(0).cast("bigint"))
        for name in ("valid_records", "warning_records", "quarantined_records")
    )
    return metrics.select(
        *by,
        (valid + warning + quarantine).alias("rows_read"),
        valid.alias("valid_records"),
        warning.alias("warning_records"),
        quarantine.alias("quarantined_records"),
    )


HISTORY_COUNTS = (
    "source_records",
    "curated_records",
    "valid_records",
    "warning_records",
    "quarantined_records",
)


def history_totals(history: DataFrame) -> DataFrame:
    """Grand totals over a batch history; the rate is a ratio of sums, not a mean of ratios."""
    totals = history.agg(*[F.sum(name).alias(f"total_{name}") for name in HISTORY_COUNTS])
    return totals.withColumn(
        "overall_pass_rate",
        F.col("total_curated_records") / F.col("total_source_records") * 100,
    )


def history_pass_rates(history: DataFrame) -> DataFrame:
    """Per-batch pass rate, and published minus curated rows."""
    return history.withColumns(
        {
            "quality_pass_rate": percent(F.col("curated_records"), F.col("source_records")),
            "reconciliation_difference": F.col("curated_records") - F.col("athena_records"),
        }
    )


def history_checks(history: DataFrame, expected_batches: int) -> DataFrame:
    """One row per check of the batch history: `check_name`, `passed`, in a single aggregation."""
    col = F.col

    def every_row(condition: Column) -> Column:
        # A null count fails its check; an empty history has no counterexample.
        return F.coalesce(F.bool_and(F.coalesce(condition, F.lit(False))), F.lit(True))

    not_negative = F.lit(True)
    for name in (*HISTORY_COUNTS, "athena_records"):
        not_negative = not_negative & (col(name) >= 0)
    checks = {
        "source_is_curated_plus_quarantined": every_row(
            col("source_records") == col("curated_records") + col("quarantined_records")
        ),
        "curated_is_valid_plus_warning": every_row(
            col("curated_records") == col("valid_records") + col("warning_records")
        ),
        "published_is_curated": every_row(col("athena_records") == col("curated_records")),
        "counts_not_negative": every_row(not_negative),
        "expected_batch_count": F.count("*") == expected_batches,
    }
    outcome = history.agg(*[check.alias(name) for name, check in checks.items()])
    return outcome.unpivot([], list(checks), "check_name", "passed")
