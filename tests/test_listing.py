"""Outputs listed in tasks."""

from test_one_pass import jobs, months

from sievelake.batch import Batch, Lake
from sievelake.sinks import files, listing, publish
from sievelake.sinks.listing import listed_outputs


def fill(root, names):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * 5)


def test_a_listing_counts_what_is_published(spark, tmp_path, monkeypatch):
    lake, batch, other = Lake(str(tmp_path / "l é%")), Batch("d", "p", 2025, 1), Batch("d", "p", 2025, 2)
    root = tmp_path / "l é%"
    fill(root / lake.curated_prefix(batch), ["part-0.parquet", ".part-0.parquet.crc", "_SUCCESS", "._SUCCESS.crc", "deep/part-1.parquet"])
    fill(root / "quarantine/d/2025-01", ["_SUCCESS"])
    fill(root / "metrics/quality/d/2025-01", ["part.json"])
    want = {"curated": (3, 2, 10, True), "quarantine": (1, 0, 0, True), "metrics": (1, 1, 5, False)}

    def told():
        rows = listed_outputs(spark, [(batch, lake), (other, lake)]).collect()
        assert all((r["objects"], r["data_files"], r["complete"]) == (0, 0, False) for r in rows if r["batch_id"] == other.batch_id)
        return {r["kind"]: (r["objects"], r["data_files"], r["size_bytes"], r["complete"]) for r in rows if r["batch_id"] == batch.batch_id}

    assert told() == want
    assert want["curated"][0] == files.object_count(spark, lake.curated(batch))

    def unknown(_):
        raise ValueError("files of this scheme cannot be opened by tasks")

    monkeypatch.setattr(listing, "address", unknown)
    assert told() == want


def test_one_job_lists_any_number_of_batches(spark, tmp_path):
    lake, many = Lake(str(tmp_path)), months(80)
    _, few = jobs(spark, lambda: publish.publication_summaries(spark, [(b, lake) for b in many[:2]]).collect())
    rows, more = jobs(spark, lambda: publish.publication_summaries(spark, [(b, lake) for b in many]).collect())
    assert len(rows) == 80 and more <= few + 1 and not any(r["complete"] for r in rows)
