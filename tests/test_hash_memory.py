"""Verification that remembers: files are hashed again only when they changed."""

import datetime as dt
import os
import uuid

import pyarrow as pa
import pytest

from relsync.operators import integrity
from relsync.operators.integrity import MEMORY_SCHEMA, hash_changed, known_hashes, settled
from relsync.plans.release_load import load_release
from relsync.plans.sink import CatalogSink
from relsync.sources.inventory import file_inventory
from relsync.spec import DatasetSpec, Source
from tests.release_tree import sha1_of, table, write_release

T0 = dt.datetime(2024, 1, 1)


def test_a_file_is_known_as_it_was_hashed_last(spark):
    files = spark.createDataFrame([(p, 5, T0) for p in "abcdef"], "path string, length long, modificationTime timestamp")
    hour = dt.timedelta(hours=1)
    memory = spark.createDataFrame([
        ("a", 5, T0, "h", T0), ("b", 6, T0, "h", T0), ("c", 5, T0 + hour, "h", T0),
        ("d", 5, T0, "old", T0), ("d", 5, T0, "new", T0 + hour),
        ("e", 5, T0, "h", T0), ("e", 5, T0 + hour, "later", T0 + hour),  # it changed since, and was put back
        ("zzz", 5, T0, "h", T0)] + [("a", 5, T0, "h", T0)] * 50, MEMORY_SCHEMA)
    got = {r["path"]: r["sha1"] for r in known_hashes(files, memory).collect()}
    assert got == {"a": "h", "b": None, "c": None, "d": "new", "e": None, "f": None}


@pytest.fixture
def counted(monkeypatch):
    """Files that hashing jobs were given."""
    seen = []
    real = integrity.hash_files

    def spy(spark, pattern, glob_filter=None, filesystem=None, inventory=None):
        seen.append(sorted(os.path.basename(r["path"]) for r in inventory.select("path").collect()))
        return real(spark, pattern, glob_filter, filesystem, inventory)

    monkeypatch.setattr(integrity, "hash_files", spy)
    return seen


def age(folder):
    for where, _, names in os.walk(folder):
        for n in names:
            os.utime(os.path.join(where, n), (1_600_000_000, 1_600_000_000))


def test_a_second_load_hashes_no_file_and_a_touched_one_is_hashed_again(spark, tmp_path, counted):
    src, spec = Source(str(tmp_path / "rel")), [DatasetSpec("t", ("id",))]
    parts = [table(id=pa.array(range(i, i + 3))) for i in (0, 10, 20)]
    rel = write_release(src.root, "22.06", {"t": parts})
    age(rel)
    sink = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8])
    names = [f"part-0000{i}.parquet" for i in range(3)]
    for want in (names, []):
        assert load_release(spark, spec, src, sink, force=True, remember=True).first()["status"] == "loaded"
        assert counted.pop() == want
    assert sink.hashes().count() == 3 and sink.hashes().schema.names == MEMORY_SCHEMA.names
    part = os.path.join(rel, "output/etl/parquet/t", names[1])
    os.utime(part, (1_600_000_500, 1_600_000_500))
    assert load_release(spark, spec, src, sink, force=True, remember=True).first()["status"] == "loaded"
    assert counted.pop() == [names[1]]
    with open(part, "r+b") as f:  # other bytes, equal length
        f.seek(8)
        f.write(b"tampered")
    out = load_release(spark, spec, src, sink, force=True, remember=True).first()
    assert counted.pop() == [names[1]] and out["status"] == "failed" and "mismatch" in out["message"]
    assert {r["sha1"] for r in sink.hashes().collect()} >= {sha1_of(os.path.join(rel, "output/etl/parquet/t", n)) for n in (names[0], names[2])}


def test_files_that_just_changed_are_not_remembered(spark, tmp_path):
    rel = write_release(str(tmp_path / "rel"), "22.06", {"t": [table(id=pa.array([1])), table(id=pa.array([2]))]})
    pattern = f"{rel}/output/etl/parquet/t/*.parquet"
    old = f"{rel}/output/etl/parquet/t/part-00000.parquet"
    os.utime(old, (1_600_000_000, 1_600_000_000))
    future = f"{rel}/output/etl/parquet/t/part-00001.parquet"
    os.utime(future, (4_000_000_000, 4_000_000_000))
    hashed, fresh = hash_changed(spark, pattern, spark.createDataFrame([], MEMORY_SCHEMA))
    assert {os.path.basename(r["path"]): r["sha1"] for r in hashed.collect()} == {os.path.basename(p): sha1_of(p) for p in (old, future)}
    assert [os.path.basename(r["path"]) for r in settled(fresh).collect()] == ["part-00000.parquet"]
    memory = spark.createDataFrame(settled(fresh).collect(), MEMORY_SCHEMA)
    fresh.unpersist()
    again, fresh = hash_changed(spark, pattern, memory, inventory=file_inventory(spark, pattern))
    assert again.count() == 2 and [os.path.basename(r["path"]) for r in fresh.collect()] == ["part-00001.parquet"]
    fresh.unpersist()
    nothing, fresh = hash_changed(spark, f"{rel}/none/*.parquet", memory)
    assert nothing.count() == 0
    fresh.unpersist()
