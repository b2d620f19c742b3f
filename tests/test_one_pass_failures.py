"""Months that differ and months that fail, among others that do not."""

import os

import pytest
from pyspark.sql import functions as F
from test_one_pass import months, place  # noqa: F401
from trip_rows import write_source

from sievelake.plans import one_pass
from sievelake.plans.one_pass import SeriesFailed, run_all
from sievelake.sinks import files
from sievelake.sources.ledger import read_ledger


def change(spark, site, batch, *changes):
    """Put one raw file per change in the place of the batch's, each with its own columns."""
    plain = write_source(spark, f"{site.work_root}/plain-{batch.period}")
    files.remove(spark, site.source(batch))
    for one in changes:
        one(spark.read.parquet(plain)).coalesce(1).write.mode("append").parquet(site.source(batch))


def last_records(spark, site):
    return {r["batch_id"]: r for r in read_ledger(spark, site.ledger).collect()}


def curated(spark, site, batch):
    return spark.read.parquet(site.lake.curated(batch))


def test_no_column_of_any_month_is_lost(spark, place):  # noqa: F811
    batches = months(4)
    site = place(batches)
    change(spark, site, batches[0], lambda t: t.drop("cbd_congestion_fee"))
    change(spark, site, batches[2], lambda t: t.withColumnRenamed("Airport_fee", "airport_fee").withColumn("note", F.lit("n")))
    change(spark, site, batches[3], lambda t: t.withColumn("note", F.lit(7)))
    assert {r["status"] for r in run_all(spark, batches, site)} == {"SUCCESS"}
    none, some = (curated(spark, site, b).agg(F.count("cbd_congestion_fee"), F.count("airport_fee")).first() for b in (batches[0], batches[2]))
    assert tuple(none) == (0, 2) and tuple(some) == (2, 2)
    notes = [{r["note"] for r in curated(spark, site, b).select("note").collect()} for b in batches]
    assert notes == [{None}, {None}, {"n"}, {"7"}]  # text and number have no type in common but text


def test_types_that_differ_take_the_least_that_holds_them(spark, place):  # noqa: F811
    batches = months(2)
    site = place(batches)
    object.__setattr__(site, "cast", False)
    wide = F.col("passenger_count").cast("long")
    change(spark, site, batches[1], lambda t: t.withColumn("passenger_count", wide))
    run_all(spark, batches, site)
    for batch in batches:
        assert dict(curated(spark, site, batch).dtypes)["passenger_count"] == "bigint"
        assert {r[0] for r in curated(spark, site, batch).select("passenger_count").collect()} == {1}


def test_files_of_one_month_may_differ(spark, place):  # noqa: F811
    batches = months(2)
    site = place(batches)
    change(spark, site, batches[1], lambda t: t.drop("extra"), lambda t: t.withColumn("more", F.lit(1)))
    records = run_all(spark, batches, site)
    assert [r["rows_read"] for r in records] == [3, 6]
    rows = curated(spark, site, batches[1]).select("extra", "more").collect()
    assert sorted(map(tuple, rows), key=str) == [(0.5, 1), (0.5, 1), (None, None), (None, None)]


def test_a_month_without_a_required_column_is_refused_by_name_while_others_go_on(spark, place):  # noqa: F811
    batches = months(3)
    site = place(batches)
    change(spark, site, batches[1], lambda t: t.drop("PULocationID"))
    with pytest.raises(ValueError, match="missing required columns: PULocationID"):
        run_all(spark, batches, site)
    found = last_records(spark, site)
    assert [found[b.batch_id]["status"] for b in batches] == ["SUCCESS", "FAILED", "SUCCESS"]
    bad = found[batches[1].batch_id]
    assert (bad["error_type"], bad["processing_status"], bad["s3_publish_status"], bad["glue_partition_status"]) == ("ValueError", None, "FAILED", "FAILED")
    assert bad["reconciliation_status"] == "NOT_RUN" and bad["rows_read"] is None and bad["source_checksum"]
    assert not files.exists(spark, site.lake.curated(batches[1]))
    # mended, it is the only one that is processed
    write_source(spark, site.source(batches[1]))
    assert [r["processing_status"] for r in run_all(spark, batches, site)] == ["SKIPPED_ALREADY_PROCESSED", "SUCCESS", "SKIPPED_ALREADY_PROCESSED"]


@pytest.mark.parametrize("cast", [False, True])
def test_text_where_numbers_belong_fails_its_month_alone(spark, place, cast):  # noqa: F811
    """Without casts the type is refused; with casts texts of numbers are taken, and others fail the job, which is traced."""
    batches = months(5)
    site = place(batches)
    object.__setattr__(site, "cast", cast)
    change(spark, site, batches[1], lambda t: t.withColumn("trip_distance", F.lit("far")))
    change(spark, site, batches[3], lambda t: t.withColumn("trip_distance", F.col("trip_distance").cast("string")))
    with pytest.raises(Exception, match="trip_distance STRING|CAST_INVALID_INPUT|far"):
        run_all(spark, batches, site)
    found = last_records(spark, site)
    assert [found[b.batch_id]["status"] for b in batches] == ["SUCCESS", "FAILED", "SUCCESS", "SUCCESS" if cast else "FAILED", "SUCCESS"]
    if cast:
        assert "far" in found[batches[1].batch_id]["error_message"]
        assert found[batches[3].batch_id]["valid_records"] == 1


def test_damaged_files_and_missing_sources_are_recorded_one_by_one(spark, place):  # noqa: F811
    batches = months(6)
    site = place(batches)
    (part,) = [f for f, _, _ in files.all_files(spark, site.source(batches[0]))]
    path = part.removeprefix("file:")
    data = bytearray(open(path, "rb").read())
    data[4 : len(data) // 2] = bytes(len(data) // 2 - 4)  # pages are gone, the footer is there
    open(path, "wb").write(data)
    os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
    change(spark, site, batches[2])
    spark.createDataFrame([("no Parquet",)], "line STRING").write.text(site.source(batches[2]))
    files.remove(spark, site.source(batches[4]))
    with pytest.raises(SeriesFailed) as raised:
        run_all(spark, batches, site)
    assert set(raised.value.errors) == {batches[0], batches[2], batches[4]}
    assert all(b.batch_id in str(raised.value) for b in raised.value.errors)
    found = last_records(spark, site)
    assert [found[b.batch_id]["status"] for b in batches] == ["FAILED", "SUCCESS"] * 3
    assert found[batches[2].batch_id]["error_message"].startswith("unreadable source: ArrowInvalid")
    assert found[batches[4].batch_id]["error_type"] == "FileNotFoundError"
    assert all(found[b.batch_id]["reconciliation_status"] == "MATCH" for b in batches[1::2])


def test_a_step_that_fails_for_all_is_recorded_for_all(spark, place, monkeypatch):  # noqa: F811
    batches = months(2)
    site = place(batches)

    def broken(*_):
        raise OSError("the catalog is away")

    monkeypatch.setattr(one_pass.catalog, "register_partitions", broken)
    with pytest.raises(SeriesFailed, match="the catalog is away"):
        run_all(spark, batches, site)
    found = last_records(spark, site)
    for batch in batches:
        r = found[batch.batch_id]
        assert (r["status"], r["processing_status"], r["s3_publish_status"], r["glue_partition_status"]) == ("FAILED", "SUCCESS", "SUCCESS", "FAILED")
        assert (r["error_type"], r["reconciliation_status"]) == ("OSError", "NOT_RUN")


def test_two_columns_of_one_name_are_refused(spark, place):  # noqa: F811
    batches = months(2)
    site = place(batches)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        change(spark, site, batches[0], lambda t: t.withColumn("airport_fee", F.lit(1.0)))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    with pytest.raises(ValueError, match="columns that share a name: airport_fee"):
        run_all(spark, batches, site)
    assert [last_records(spark, site)[b.batch_id]["status"] for b in batches] == ["FAILED", "SUCCESS"]
