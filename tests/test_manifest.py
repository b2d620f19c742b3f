import hashlib
import os

import pytest

from sievelake.sinks.files import qualified
from sievelake.sources.manifest import (
    address,
    batch_checksums,
    file_manifest,
    source_checksum,
    source_checksums,
    with_batch_path,
)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture
def folder(tmp_path):
    content = {"a.parquet": b"first", "b.parquet": b"second", "empty.parquet": b"", "sub/c.parquet": os.urandom(100_000)}
    for name, data in content.items():
        path = tmp_path / "batch" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return tmp_path / "batch", content


@pytest.mark.parametrize("piece", [7, 8 * 1024 * 1024])
def test_every_file_is_hashed_in_pieces_of_any_size(spark, folder, piece):
    path, content = folder
    rows = file_manifest(spark, str(path), piece=piece).collect()
    found = {row["source_file"]: (row["size_bytes"], row["sha256"]) for row in rows}
    assert found == {name.split("/")[-1]: (len(data), sha256(data)) for name, data in content.items()}


def test_odd_names_large_files_and_another_working_folder(spark, tmp_path, monkeypatch):
    odd = tmp_path / "with space" / "pct%41 é"
    odd.mkdir(parents=True)
    block = os.urandom(1 << 20)
    with open(odd / "large#1.parquet", "wb") as file:
        for _ in range(300):
            file.write(block)
    digest = hashlib.sha256()
    for _ in range(300):
        digest.update(block)
    (odd / "_hidden").write_bytes(b"x")
    monkeypatch.chdir(tmp_path)
    (row,) = file_manifest(spark, str(odd)).collect()
    assert (row["source_file"], row["size_bytes"], row["sha256"]) == ("large#1.parquet", 300 << 20, digest.hexdigest())
    assert row["modified_at"] is not None


def test_schemes_are_refused_by_name_before_a_job():
    assert address("file:/a b/%41") == "/a b/%41"
    assert address("s3a://bucket/a b/x%41") == "s3://bucket/a%20b/x%2541"
    with pytest.raises(ValueError, match="ftp"):
        address("ftp://host/a")


def test_an_empty_file_changes_a_folders_checksum(spark, folder):
    path, _ = folder
    before = source_checksum(spark, str(path))
    (path / "empty.parquet").unlink()
    assert source_checksum(spark, str(path)) != before


def test_checksum_of_a_file_is_its_sha256(spark, folder):
    path, content = folder
    for name in ("a.parquet", "empty.parquet"):
        assert source_checksum(spark, str(path / name)) == sha256(content[name])


def test_directory_checksum_sees_content_and_names_but_not_the_way_it_is_hashed(spark, folder):
    path, _ = folder
    before = source_checksum(spark, str(path))
    manifest = file_manifest(spark, str(path), piece=3)
    batches = spark.createDataFrame([(qualified(spark, str(path)),)], "batch_path STRING")
    assert batch_checksums(with_batch_path(manifest, batches)).first()["source_checksum"] == before
    (path / "a.parquet").write_bytes(b"First")
    changed = source_checksum(spark, str(path))
    assert changed != before
    (path / "a.parquet").write_bytes(b"first")
    assert source_checksum(spark, str(path)) == before
    (path / "b.parquet").rename(path / "d.parquet")
    assert source_checksum(spark, str(path)) not in (before, changed)


def test_many_batches_by_one_manifest(spark, folder, tmp_path):
    path, content = folder
    paths = [str(path), str(path / "a.parquet"), str(tmp_path / "absent.parquet")]
    found = source_checksums(spark, paths)
    assert found == {name: source_checksum(spark, name) for name in paths[:2]}
    assert found[paths[1]] == sha256(content["a.parquet"])


def test_missing_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        source_checksum(spark, str(tmp_path / "absent.parquet"))
