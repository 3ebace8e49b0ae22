"""Reading a table as of a release, and keeping generations by release."""

import uuid

import pyarrow as pa
import pytest

from relsync.plans.incremental import IncrementalSink
from relsync.plans.release_load import load_release
from relsync.plans.sink import CatalogSink
from relsync.spec import DatasetSpec, Source
from tests.release_tree import table, write_release


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("kind", [CatalogSink, IncrementalSink])
def test_a_table_as_of_its_releases(spark, tmp_path, kind):
    src, spec = Source(str(tmp_path / "rel")), [DatasetSpec("t", ("id",))]
    sink = kind(spark, database="db_" + uuid.uuid4().hex[:8], keep_releases=3)
    held = {}
    for version, ids in (("22.11", [1]), ("22.02", [1, 2]), ("23.04", [2, 3])):
        write_release(src.root, version, {"t": [table(id=pa.array(ids, pa.int64()))]})
        load_release(spark, spec, src, sink, version=version)
        held[version] = [(i,) for i in ids]
    assert [r for _, r in sink.releases("t")] == ["23.04", "22.02", "22.11"]
    for asked, release in (("22.02", "22.02"), ("22.09", "22.02"), ("22.11", "22.11"), ("23.03", "22.11"), ("99.01", "23.04")):
        assert sink.as_of("t", asked)[1] == release and rows(sink.read_as_of("t", asked)) == held[release]
    with pytest.raises(LookupError, match="22.01"):
        sink.read_as_of("t", "22.01")
    # loaded again, a release has one generation, the one published last
    write_release(src.root, "22.11", {"t": [table(id=pa.array([7], pa.int64()))]})
    load_release(spark, spec, src, sink, version="22.11", force=True)
    assert [r for _, r in sink.releases("t")] == ["22.11", "23.04", "22.02"]
    assert rows(sink.read_as_of("t", "22.12")) == [(7,)] == rows(sink.read("t"))
    write_release(src.root, "23.06", {"t": [table(id=pa.array([9], pa.int64()))]})
    load_release(spark, spec, src, sink)
    assert [r for _, r in sink.releases("t")] == ["23.06", "22.11", "23.04"]  # the oldest release went
    assert len(sink.published("t")) == 3


def test_tables_published_without_a_release_are_kept_by_generation(spark):
    sink = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8])
    for n in (1, 2, 3):
        sink.merge("t", spark.range(n), ["id"])
    assert [r for _, r in sink.releases("t")] == [None, None] and sink.releases("none") == []
    with pytest.raises(LookupError):
        sink.as_of("t", "22.01")
    with pytest.raises(ValueError):
        CatalogSink(spark, keep_releases=0)
