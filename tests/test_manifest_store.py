"""The stored file manifest: what is read again and what is not."""

import hashlib
import os

import pytest
from test_one_pass import months, place  # noqa: F401
from trip_rows import THREE_TRIPS, write_source

from sievelake.plans.one_pass import run_all
from sievelake.sources import manifest_store
from sievelake.sources.manifest import source_checksums
from sievelake.sources.manifest_store import refresh_manifest, stored_checksums, stored_manifest


@pytest.fixture
def raw(tmp_path):
    for name, data in {"a/1": b"one", "a/2": b"two", "b/1": b"", "c d%/1": b"four"}.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return tmp_path / "raw"


def told(changes, raw):
    return {r["path"].partition("/raw/")[2]: (r["change"], r["hashed"]) for r in changes.collect()}


def test_only_what_changed_is_hashed(spark, tmp_path, raw):
    store = str(tmp_path / "store")
    first = told(refresh_manifest(spark, store, [str(raw)]), raw)
    assert set(first.values()) == {("added", True)} and len(first) == 4
    assert set(told(refresh_manifest(spark, store, [str(raw)]), raw).values()) == {("same", False)}
    (raw / "a/1").write_bytes(b"ONE")
    os.utime(raw / "a/1", (1, 1))
    os.utime(raw / "b/1", (2, 2))  # touched
    os.remove(raw / "a/2")
    (raw / "e").write_bytes(b"five")
    assert told(refresh_manifest(spark, store, [str(raw)]), raw) == {
        "a/1": ("changed", True), "a/2": ("removed", False), "b/1": ("same", True), "c d%/1": ("same", False), "e": ("added", True)
    }
    held = {r["path"].rpartition("/raw/")[2]: r["sha256"] for r in stored_manifest(spark, store).collect()}
    assert held == {k: hashlib.sha256(v).hexdigest() for k, v in {"a/1": b"ONE", "b/1": b"", "c d%/1": b"four", "e": b"five"}.items()}
    assert set(told(refresh_manifest(spark, store, [str(raw)], rehash=True), raw).values()) == {("same", True)}


def test_a_change_that_hides_behind_size_and_time_is_found_by_rehash(spark, tmp_path, raw):
    store, file = str(tmp_path / "store"), raw / "a/1"
    os.utime(file, (5, 5))
    refresh_manifest(spark, store, [str(raw)])
    file.write_bytes(b"eno")
    os.utime(file, (5, 5))
    assert told(refresh_manifest(spark, store, [str(raw)]), raw)["a/1"] == ("same", False)
    assert told(refresh_manifest(spark, store, [str(raw)], rehash=True), raw)["a/1"] == ("changed", True)


def test_other_paths_are_carried_and_missing_ones_removed(spark, tmp_path, raw):
    store = str(tmp_path / "store")
    refresh_manifest(spark, store, [str(raw / "a"), str(raw / "b")])
    assert told(refresh_manifest(spark, store, [str(raw / "c d%")]), raw) == {"c d%/1": ("added", True)}
    assert stored_manifest(spark, store).count() == 4
    os.remove(raw / "b/1")
    os.rmdir(raw / "b")
    assert told(refresh_manifest(spark, store, [str(raw / "b")]), raw) == {"b/1": ("removed", False)}
    assert stored_manifest(spark, store).count() == 3
    # a name that begins like another is no folder of it
    (raw / "a2").write_bytes(b"x")
    assert "a2" not in told(refresh_manifest(spark, store, [str(raw / "a")]), raw)
    assert len([n for n in os.listdir(store)]) == 2  # older versions go


def test_checksums_are_those_of_hashing_all(spark, tmp_path, raw):
    store, paths = str(tmp_path / "store"), [str(raw / "a"), str(raw / "a/1"), str(raw / "b"), str(raw / "absent")]
    (raw / "empty").mkdir()
    for _ in range(2):
        assert stored_checksums(spark, store, paths) == source_checksums(spark, paths)
    assert stored_checksums(spark, store, [str(raw / "empty")]) == {str(raw / "empty"): hashlib.sha256(b"").hexdigest()}


def test_a_rerun_of_unchanged_batches_hashes_nothing(spark, place, monkeypatch):  # noqa: F811
    batches = months(20)
    site = place(batches)
    run_all(spark, batches, site)
    seen = []
    original = manifest_store.hashed_files
    monkeypatch.setattr(manifest_store, "hashed_files", lambda s, found, *a: seen.append(len(found)) or original(s, found, *a))
    assert {r["s3_publish_status"] for r in run_all(spark, batches, site)} == {"EXISTS"}
    write_source(spark, site.source(batches[3]), THREE_TRIPS[:2])
    done = run_all(spark, batches, site)
    assert [b.batch_id for b, r in zip(batches, done) if r["processing_status"] == "SUCCESS"] == [batches[3].batch_id]
    object.__setattr__(site, "rehash", True)
    run_all(spark, batches, site)
    assert seen == [0, 1, 20]

