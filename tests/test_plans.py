"""Plans keep what makes them fit for large tables."""

import re

import pytest
from trip_rows import write_source

from sievelake.checks.queries import QUERIES
from sievelake.operators import metrics
from sievelake.operators.classify import classify, curated, where_fired
from sievelake.operators.schema import normalize
from sievelake.session import SETTINGS, tune

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    return spark.read.parquet(write_source(tune(spark), str(tmp_path_factory.mktemp("plans") / "trips")))


def test_settings_are_applied(spark):
    tune(spark)
    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())


def test_counts_read_only_rule_columns(source):
    text = plan(metrics.quality_metrics(classify(normalize(source))))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "tip_amount" not in schema and "concat(" not in text  # no other column, no reason array
    assert text.count("HashAggregate") == 2 and "partial_sum" in text


def test_simple_rule_reaches_the_scan(source):
    text = plan(where_fired(normalize(source), "NEGATIVE_FARE_AMOUNT"))
    assert "LessThan(fare_amount,0.0)" in text
    text = plan(where_fired(normalize(source), "MISSING_PICKUP_LOCATION"))
    assert "IsNull(PULocationID)" in text


def test_classification_is_one_compiled_stage_without_shuffle(source):
    text = plan(curated(classify(normalize(source))))
    assert "Exchange" not in text and "lambda" not in text
    assert re.search(r"\*\(1\) Project", text) and re.search(r"\*\(1\) Filter", text)


def test_total_count_reads_no_column(source):
    assert "ReadSchema: struct<>" in plan(metrics.total_records(classify(normalize(source))))


def test_ledger_joins_meet_unique_keys(spark):
    for name in ("pending_batches", "skipped_batches"):
        df = QUERIES[name](spark, SF_DIR)
        optimized = df._jdf.queryExecution().optimizedPlan().toString()
        join = optimized.index("Join Left")
        assert "Aggregate [batch_id" in optimized[join:], name
        assert "sha2" not in optimized.split("Relation [l_orderkey")[0].rsplit("Aggregate", 1)[1], name
