"""Every registered query against its SQL in DuckDB, over whole tables."""

import os

import pytest
from compare import duck, duck_rows, spark_rows

from sievelake.checks.oracle import ORACLES
from sievelake.checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Files and footers are read by Python functions in tasks.
READ_IN_TASKS = {(name, "Pandas") for name in ("source_manifest", "schema_drift", "publication_summary_counts")}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql_and_is_registered():
    import __spark_entry__ as contract

    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().toString()
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert operator not in plan or (name, operator) in READ_IN_TASKS, operator
    types, rows = spark_rows(df)
    wanted_types, wanted_rows = duck_rows(connection, ORACLES[name])
    assert types == wanted_types
    assert rows == wanted_rows
    assert rows


def test_results_do_not_depend_on_how_the_input_is_split(spark, connection, tmp_path):
    """The same table in many files and another order gives the same metrics."""
    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").repartition(13, "l_partkey").write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    for name in ("quality_metrics_by_batch", "latest_processed_counts", "status_counts"):
        _, rows = spark_rows(QUERIES[name](spark, str(tmp_path)))
        assert rows == duck_rows(connection, ORACLES[name])[1]


def test_faults_to_reconcile_lie_in_lake_and_catalog(spark, monkeypatch):
    from sievelake.checks import queries
    from sievelake.sinks import catalog

    name = queries.scratch_table()
    monkeypatch.setattr(queries, "scratch_table", lambda: name)
    rows = QUERIES["reconcile_batches"](spark, SF_DIR).collect()
    held = {(r["year"], r["month"]): r["n"] for r in spark.sql(f"SELECT year, month, count(*) AS n FROM {name} GROUP BY ALL").collect()}
    months = {month for _, month in catalog.listed_partitions(spark, name)}
    assert 3 not in months and 2 in months
    assert all(r["published_records"] == held.get((r["year"], r["month"]), 0) for r in rows)
    assert {r["expected_records"] for r in rows if r["month"] == 2} == {0}
