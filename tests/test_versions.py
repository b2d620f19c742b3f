"""Versioned lakes: a run writes beside what is read, and the catalog switches."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F
from test_one_pass import months
from trip_rows import THREE_TRIPS, write_source

from sievelake.batch import Lake
from sievelake.plans import one_pass
from sievelake.plans.one_pass import run_all
from sievelake.plans.series import Site, process_batch
from sievelake.sinks import catalog, files, versions


@pytest.fixture
def site(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), versioned=True)
    table = f"t_{uuid.uuid4().hex}"
    catalog.create_table(spark, table, lake.curated_root("taxi"))
    yield Site(lake.ledger, str(tmp_path / "work"), lake, table, cast=True)
    spark.sql(f"DROP TABLE {table}")


def count(spark, site, batch):
    return spark.table(site.table).where((F.col("year") == batch.year) & (F.col("month") == batch.month)).count()


def version_folders(spark, site):
    root = site.lake.versions_root("taxi")
    return {run: {m for y in files.children(spark, f"{run}/sievelake_row_kind=curated") for m in files.children(spark, y)} for run in files.children(spark, root)}


def test_first_run_rerun_and_lost_output(spark, site):
    batches = months(3)
    for batch in batches:
        write_source(spark, site.source(batch))
    write_source(spark, site.source(batches[1]), [])  # a source without a row
    assert [r["s3_publish_status"] for r in run_all(spark, batches, site)] == ["SUCCESS"] * 3
    assert [count(spark, site, b) for b in batches] == [2, 0, 2]
    (first,) = version_folders(spark, site).values()
    assert len(first) == 3
    again = run_all(spark, batches, site)
    assert [r["s3_publish_status"] for r in again] == ["EXISTS"] * 3 and {r["glue_partition_status"] for r in again} == {"EXISTS"}
    assert len(version_folders(spark, site)) == 1
    lost = catalog.registered_location(spark, site.table, batches[0])
    files.remove(spark, f"{lost}/_SUCCESS")
    mended = run_all(spark, batches, site)
    assert [r["s3_publish_status"] for r in mended] == ["BACKFILLED", "EXISTS", "EXISTS"]
    assert catalog.registered_location(spark, site.table, batches[0]) != lost
    assert {r["reconciliation_status"] for r in mended} == {"MATCH"} and count(spark, site, batches[0]) == 2


def test_readers_see_the_old_rows_or_the_new_ones(spark, site):
    batch = months(1)[0]
    write_source(spark, site.source(batch))
    run_all(spark, [batch], site)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(count(spark, site, batch))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for copies in (3, 1, 5):
            write_source(spark, site.source(batch), THREE_TRIPS * copies)
            run_all(spark, [batch], site)
    finally:
        stop.set()
        reader.join()
    assert len(seen) > 3 and set(seen) <= {2, 6, 10} and count(spark, site, batch) == 10
    # each value is seen in one stretch: nothing flickers
    assert [n for i, n in enumerate(seen) if i == 0 or seen[i - 1] != n] in ([2, 6, 2, 10], [2, 6, 2], [2, 6, 10], [2, 10], [2])


def test_a_source_replaced_while_it_is_read_leaves_the_old_version(spark, site, monkeypatch):
    batch = months(1)[0]
    write_source(spark, site.source(batch))
    run_all(spark, [batch], site)
    before = catalog.registered_location(spark, site.table, batch)
    write_source(spark, site.source(batch), THREE_TRIPS * 2)
    original = one_pass.write_batches

    def replaced(*arguments, **options):
        out = original(*arguments, **options)
        write_source(spark, site.source(batch), THREE_TRIPS[:1])
        return out

    monkeypatch.setattr(one_pass, "write_batches", replaced)
    with pytest.raises(RuntimeError, match="replaced"):
        run_all(spark, [batch], site)
    monkeypatch.undo()
    assert catalog.registered_location(spark, site.table, batch) == before and count(spark, site, batch) == 2
    assert run_all(spark, [batch], site)[0]["rows_read"] == 1 and count(spark, site, batch) == 1


def test_old_versions_are_collected_and_read_ones_kept(spark, site):
    batches = months(2)
    for batch in batches:
        write_source(spark, site.source(batch))
    run_all(spark, batches, site)
    write_source(spark, site.source(batches[0]), THREE_TRIPS * 2)
    run_all(spark, batches, site)
    assert sum(map(len, version_folders(spark, site).values())) == 3
    assert versions.collect_versions(spark, site.table, site.lake, "taxi") == []  # too young
    gone = versions.collect_versions(spark, site.table, site.lake, "taxi", hours=-1)
    assert len(gone) == 1 and gone[0].endswith("year=2020/month=01")
    assert [count(spark, site, b) for b in batches] == [4, 2]
    assert versions.collect_versions(spark, site.table, site.lake, "taxi", hours=-1) == []


def test_versions_need_a_table_and_one_pass(spark, site, tmp_path):
    bare = Site(site.ledger, site.work_root, site.lake)
    with pytest.raises(ValueError, match="needs a table"):
        run_all(spark, months(1), bare)
    with pytest.raises(ValueError, match="one pass"):
        process_batch(spark, months(1)[0], site)
