import uuid

import pytest
from trip_rows import THREE_TRIPS, write_source

from sievelake.batch import Batch, Lake
from sievelake.plans import one_pass
from sievelake.plans.one_pass import read_batches, run_all
from sievelake.plans.series import Site
from sievelake.sinks import catalog, files
from sievelake.sources.ledger import read_ledger


def months(count):
    return [Batch("taxi", "trip data", 2020 + i // 12, i % 12 + 1) for i in range(count)]


@pytest.fixture
def place(spark, tmp_path):
    made = []

    def make(batches, name="one"):
        root = tmp_path / name
        lake = Lake(str(root / "lake"))
        table = f"t_{uuid.uuid4().hex}"
        catalog.create_table(spark, table, lake.curated_root("taxi"))
        made.append(table)
        site = Site(lake.ledger, str(root / "work"), lake, table, cast=True)
        for batch in batches:
            write_source(spark, site.source(batch))
        return site

    yield make
    for table in made:
        spark.sql(f"DROP TABLE {table}")


def jobs(spark, action):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    out = action()
    return out, spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - before


def test_year_and_month_come_from_the_name(spark, tmp_path):
    batches = months(14)[11:14]
    for batch in batches:
        write_source(spark, str(tmp_path / batch.source_file))
    rows = read_batches(spark, [str(tmp_path / b.source_file) for b in batches], "trip data")
    assert {tuple(r) for r in rows.select("year", "month").collect()} == {(2020, 12), (2021, 1), (2021, 2)}
    with pytest.raises(FileNotFoundError):
        read_batches(spark, [str(tmp_path / "absent")], "trip data")


def test_first_run_rerun_and_lost_output(spark, place):
    batches = months(3)
    site = place(batches)
    first = run_all(spark, batches, site)
    assert [r["batch_id"] for r in first] == [b.batch_id for b in batches]
    assert {(r["status"], r["processing_status"], r["s3_publish_status"], r["reconciliation_status"]) for r in first} == {
        ("SUCCESS", "SUCCESS", "SUCCESS", "MATCH")
    }
    assert {(r["rows_read"], r["valid_records"], r["athena_records"]) for r in first} == {(3, 1, 2)}
    files.remove(spark, site.lake.quarantine(batches[1]))
    second = run_all(spark, batches, site)
    assert [r["s3_publish_status"] for r in second] == ["EXISTS", "BACKFILLED", "EXISTS"]
    assert {r["processing_status"] for r in second} == {"SKIPPED_ALREADY_PROCESSED"}
    assert files.is_complete(spark, site.lake.quarantine(batches[1]))
    assert read_ledger(spark, site.ledger).count() == 6


def test_jobs_do_not_grow_with_batches(spark, place):
    few, many = months(3), months(20)
    small, large = place(few, "few"), place(many, "many")
    _, one = jobs(spark, lambda: run_all(spark, few, small))
    _, other = jobs(spark, lambda: run_all(spark, many, large))
    assert other <= one + 5
    _, again = jobs(spark, lambda: run_all(spark, many, large))
    assert again <= other


def test_a_mismatch_is_recorded_and_raised_with_its_name(spark, place):
    batches = months(3)
    site = place(batches)
    run_all(spark, batches, site)
    (part,) = [f for f, _, _ in files.all_files(spark, site.lake.curated(batches[2])) if f.endswith(".parquet")]
    files.remove(spark, part)
    with pytest.raises(RuntimeError, match=batches[2].batch_id) as raised:
        run_all(spark, batches, site)
    assert batches[0].batch_id not in str(raised.value)
    last = read_ledger(spark, site.ledger).where("reconciliation_status = 'MISMATCH'").collect()
    assert [(r["batch_id"], r["status"], r["difference"]) for r in last] == [(batches[2].batch_id, "FAILED", -2)]


def test_a_source_replaced_while_it_is_read_is_not_recorded_as_processed(spark, place, monkeypatch):
    batches = months(2)
    site = place(batches)
    original = one_pass.write_batches

    def replaced(*arguments, **options):
        out = original(*arguments, **options)
        write_source(spark, site.source(batches[0]), THREE_TRIPS[:1])
        return out

    monkeypatch.setattr(one_pass, "write_batches", replaced)
    with pytest.raises(RuntimeError, match="replaced"):
        run_all(spark, batches, site)
    monkeypatch.undo()
    done = run_all(spark, batches, site)
    assert [r["processing_status"] for r in done] == ["SUCCESS", "SKIPPED_ALREADY_PROCESSED"]
    assert done[0]["rows_read"] == 1 and done[0]["reconciliation_status"] == "MATCH"


def test_empty_sources_missing_sources_and_no_batches(spark, place):
    batches = months(3)
    site = place(batches[:2])
    write_source(spark, site.source(batches[1]), [])
    out = run_all(spark, batches[:2], site)
    assert [r["rows_read"] for r in out] == [3, 0] and {r["reconciliation_status"] for r in out} == {"MATCH"}
    with pytest.raises(FileNotFoundError, match="2020-03"):
        run_all(spark, batches, site)
    assert run_all(spark, [], site) == []


def test_a_file_name_is_searched_once_per_row(spark, tmp_path):
    """Names with spaces, plus and percent signs give the same months; the search, done for every row, is done once."""
    odd = "a+b %41 c%"
    for year, month in ((2020, 1), (2021, 12)):
        spark.range(2).write.parquet(str(tmp_path / odd / f"p+q_{year}-{month:02d}.parquet"))
    found = read_batches(spark, [str(tmp_path / odd)], r"p\+q")
    assert sorted(r[1:] for r in found.collect()) == [(2020, 1)] * 2 + [(2021, 12)] * 2
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1 and "regexp_replace" not in plan
