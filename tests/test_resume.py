"""Loads that go on where a killed one stopped."""

import os
import uuid

import pyarrow as pa
import pytest

from relsync.plans import release_load, resume
from relsync.plans.release_load import load_release
from relsync.plans.resume import batch_records, files_to_read, resumable_rows
from relsync.plans.sink import CatalogSink
from relsync.sources.inventory import file_inventory
from relsync.spec import DatasetSpec, Source
from tests.release_tree import table, write_release


class Killed(BaseException):
    """Stands for the end of the process."""


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def seen(monkeypatch):
    """Files given to the reader, and a way to end the process at a batch."""
    log = {"files": [], "stop": None}
    real = resume.resumable_rows

    def spy(spark, work, inventory, read, batch_files=1000):
        def watched(paths):
            if log["stop"] is not None and len(log["files"]) >= log["stop"]:
                raise Killed
            log["files"] += [os.path.basename(p) for p in paths]
            return read(paths)

        return real(spark, work, inventory, watched, batch_files)

    monkeypatch.setattr(release_load, "resumable_rows", spy)
    return log


@pytest.mark.parametrize("mode", ["strict", "merge"])
def test_a_killed_load_reads_the_rest_only(spark, tmp_path, seen, mode):
    src, spec = Source(str(tmp_path / "rel")), [DatasetSpec("t", ("id",), overrides={"v": {"rename": "value"}})]
    parts = [table(id=pa.array(range(10 * i, 10 * i + 10)), v=pa.array([f"v{i}"] * 10)) for i in range(8)]
    if mode == "merge":
        parts[5] = parts[5].append_column("late", pa.array([1.5] * 10))
        parts[6] = parts[6].append_column("late", pa.array([2] * 10))
    write_release(src.root, "22.06", {"t": parts})
    sink, work = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8]), str(tmp_path / "work")
    args = dict(resume=work, batch_files=2, schema_mode=mode, verify=False)
    seen["stop"] = 4
    with pytest.raises(Killed):
        load_release(spark, spec, src, sink, **args)
    assert len(seen["files"]) == 4 and not sink.exists("t")
    seen.update(files=[], stop=None)
    out = load_release(spark, spec, src, sink, **args).first()
    assert (out["status"], out["rows_loaded"]) == ("loaded", 80)
    assert seen["files"] == [f"part-0000{i}.parquet" for i in range(4, 8)]
    assert not os.path.exists(f"{work}/t/22.06")
    plain = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8])
    load_release(spark, spec, src, plain, schema_mode=mode, verify=False)
    assert rows(sink.read("t")) == rows(plain.read("t")) and sink.read("t").schema.simpleString() == plain.read("t").schema.simpleString()


def test_changed_and_vanished_files_make_their_batch_void(spark, tmp_path):
    d, work = str(tmp_path / "d"), str(tmp_path / "work")
    os.makedirs(d)

    def put(i, v):
        pa.parquet.write_table(pa.table({"id": [i], "v": [v]}), f"{d}/{i}.parquet")

    read = []

    def reader(paths):
        read.extend(os.path.basename(p) for p in paths)
        return spark.read.schema("id long, v string").parquet(*paths) if paths else spark.createDataFrame([], "id long, v string")

    def load():
        read.clear()
        return rows(resumable_rows(spark, work, file_inventory(spark, f"{d}/*.parquet"), reader, 3))

    assert load() == []
    for i in range(6):
        put(i, "a")
    assert load() == [(i, "a") for i in range(6)] and len(read) == 6
    assert load() == [(i, "a") for i in range(6)] and read == []
    put(1, "changed")
    assert load() == [(i, "changed" if i == 1 else "a") for i in range(6)] and sorted(read) == ["0.parquet", "1.parquet", "2.parquet"]
    os.remove(f"{d}/5.parquet")
    put(7, "new")
    assert load() == [(0, "a"), (1, "changed"), (2, "a"), (3, "a"), (4, "a"), (7, "new")]
    assert sorted(read) == ["3.parquet", "4.parquet", "7.parquet"]
    # rows without a record, of a batch that was being written, do not count
    spark.createDataFrame([(99, "half")], "id long, v string").write.parquet(f"{work}/rows/half")
    assert (99, "half") not in load() and read == []
    inventory = file_inventory(spark, f"{d}/*.parquet")
    assert files_to_read(batch_records(spark, work), inventory).count() == 0
    resume.forget(work)
    assert not os.path.exists(work)
    resume.forget(work)
