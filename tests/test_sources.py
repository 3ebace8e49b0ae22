import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from relsync.operators.integrity import (ChecksumMismatch, IntegrityError, hash_files,
                                         require_verified, verify_files)
from relsync.sources.inventory import (latest_version, list_data_files, list_datasets,
                                       list_versions, suggest_specs)
from relsync.sources.manifest import (ManifestError, load_manifest, manifest_conflicts,
                                      parse_manifest_lines, read_manifest, select_dataset,
                                      verify_manifest)
from relsync.sources.parquet import SchemaMismatch, footer_report, read_dataset
from relsync.spec import Source
from tests.release_tree import sha1_of, table, write_release


def lamps(n, first=0):
    return table(lamp=pa.array([f"L{i}" for i in range(first, first + n)]), watt=pa.array([i % 60 for i in range(n)], pa.int16()))


@pytest.fixture
def tree(tmp_path):
    """Two releases, the newer with a second dataset and a dataset of two files, and other folders."""
    root = str(tmp_path / "releases")
    shades = table(shade=pa.array([1, 2, 3]), lamp=pa.array(["L0", None, "L4"]))
    write_release(root, "22.04", {"lamps": [lamps(5)]})
    write_release(root, "22.06", {"lamps": [lamps(7), lamps(4, 7)], "shades": [shades]})
    write_release(root, "22.10-rc", {"lamps": [lamps(1)]})
    os.makedirs(os.path.join(root, "9.1"))
    with open(os.path.join(root, "INDEX.txt"), "w") as f:
        f.write("no release")
    return Source(root)


def test_versions_newest_first(spark, tree):
    got = [r["version"] for r in list_versions(spark, tree).collect()]
    assert got == ["22.06", "22.04"]
    assert latest_version(spark, tree) == "22.06"


def test_versions_numeric_order_and_empty(spark, tmp_path):
    root = str(tmp_path / "r")
    for v in ("09.12", "10.01", "9.11"):
        write_release(root, v, {"x": [table(id=pa.array([1]))]})
    assert [r["version"] for r in list_versions(spark, Source(root)).collect()] == ["10.01", "09.12"]
    empty = Source(str(tmp_path / "nothing"))
    assert list_versions(spark, empty).count() == 0
    with pytest.raises(LookupError):
        latest_version(spark, empty)


def test_datasets_and_files(spark, tree):
    with open(os.path.join(tree.parquet_root("22.06"), "manifest.txt"), "w") as f:
        f.write("a file next to the dataset folders is not a dataset")
    assert [r["dataset"] for r in list_datasets(spark, tree, "22.06").collect()] == [
        "lamps", "shades"]
    files = [os.path.basename(r["path"]) for r in list_data_files(spark, tree, "22.06", "lamps").collect()]
    assert files == ["part-00000.parquet", "part-00001.parquet"]
    specs = suggest_specs(list_datasets(spark, tree, "22.06")).collect()
    assert [(r["dataset"], r["final_table_name"], r["primary_key"]) for r in specs] == [
        ("lamps", "lamps", "id"), ("shades", "shades", "id")]


def test_manifest_parse_and_verify(spark, tree):
    verify_manifest(spark, tree, "22.06")
    m = {r["path"]: r["sha1"] for r in load_manifest(spark, tree, "22.06").collect()}
    assert set(m) == {"output/etl/parquet/lamps/part-00000.parquet",
                      "output/etl/parquet/lamps/part-00001.parquet",
                      "output/etl/parquet/shades/part-00000.parquet"}
    sel = select_dataset(load_manifest(spark, tree, "22.06"), tree, "lamps",
                         ["part-00001.parquet"]).collect()
    assert [r["path"] for r in sel] == ["output/etl/parquet/lamps/part-00001.parquet"]


def test_manifest_wrong_hash(spark, tree):
    with open(tree.manifest_hash("22.06"), "w") as f:
        f.write("0" * 40 + "  release_data_integrity\n")
    with pytest.raises(ManifestError, match="mismatch"):
        verify_manifest(spark, tree, "22.06")


def test_manifest_lines_and_last_wins(spark, tmp_path):
    p = tmp_path / "m"
    p.write_text("AAA  ./a/b.parquet\n\nbbb\t/c d.parquet  \nccc  a/b.parquet\n")
    lines = spark.read.text(str(p))
    assert sorted(tuple(r) for r in parse_manifest_lines(lines).collect()) == [
        ("a/b.parquet", "aaa"), ("a/b.parquet", "ccc"), ("c d.parquet", "bbb")]
    got = {r["path"]: r["sha1"] for r in read_manifest(spark, str(p)).collect()}
    assert got == {"a/b.parquet": "ccc", "c d.parquet": "bbb"}
    assert [(r["path"], r["n"], r["n_hashes"]) for r in manifest_conflicts(spark, str(p)).collect()] == [
        ("a/b.parquet", 2, 2)]


def test_file_verification_statuses(spark, tree):
    manifest = load_manifest(spark, tree, "22.06")
    d = tree.dataset_dir("22.06", "lamps")
    rep = verify_files(hash_files(spark, f"{d}/*.parquet"), manifest, tree.relative_prefix("lamps"))
    assert {r["status"] for r in rep.collect()} == {"ok"}
    require_verified(rep)
    # wrong content
    with open(os.path.join(d, "part-00001.parquet"), "ab") as f:
        f.write(b"x")
    # a file the manifest does not list, and a listed file that is gone
    with open(os.path.join(d, "part-00009.parquet"), "wb") as f:
        f.write(b"y")
    os.remove(os.path.join(d, "part-00000.parquet"))
    rep = verify_files(hash_files(spark, f"{d}/*.parquet"), manifest, tree.relative_prefix("lamps"))
    got = {os.path.basename(r["path"]): r["status"] for r in rep.collect()}
    assert got == {"part-00000.parquet": "missing_file", "part-00001.parquet": "mismatch",
                   "part-00009.parquet": "not_in_manifest"}
    with pytest.raises(IntegrityError):
        require_verified(rep)
    with pytest.raises(ChecksumMismatch):   # "mismatch" sorts first among the statuses
        require_verified(rep)
    with pytest.raises(FileNotFoundError):
        require_verified(rep.where("status = 'missing_file'"))
    with pytest.raises(KeyError, match="not_in_manifest"):
        require_verified(rep.where("status = 'not_in_manifest'"))


def test_every_size_is_hashed_as_a_stream(spark, tree, monkeypatch):
    from relsync.operators import integrity

    d = tree.dataset_dir("22.06", "lamps")
    want = {f"part-0000{i}.parquet": sha1_of(os.path.join(d, f"part-0000{i}.parquet")) for i in range(2)}
    hashes = lambda **a: {os.path.basename(r["path"]): r["sha1"] for r in hash_files(spark, f"{d}/*.parquet", **a).collect()}
    assert hashes() == want
    monkeypatch.setattr(integrity, "CHUNK", 10)  # files of many chunks
    assert hashes() == want
    assert hashes(inventory=list_data_files(spark, tree, "22.06", "lamps")) == want
    assert hash_files(spark, f"{d}/*.nothing").count() == 0


def test_many_files_are_dealt_about_evenly(spark, tmp_path):
    for i in range(48):
        (tmp_path / f"f{i:02d}").write_bytes(b"x" * i)
    out = hash_files(spark, str(tmp_path / "f*"))
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 40 and max(r["count"] for r in sizes) <= 3


def test_paths_with_spaces_and_a_given_file_system(spark, tmp_path):
    from pyarrow import fs

    root = str(tmp_path / "a folder, 100 % odd")
    write_release(root, "22.06", {"lamps": [lamps(3), lamps(3, 3)]})
    src = Source(root, filesystem=fs.SubTreeFileSystem("/", fs.LocalFileSystem()))
    d = src.dataset_dir("22.06", "lamps")
    for filesystem in (None, src.filesystem):
        rep = verify_files(hash_files(spark, f"{d}/*.parquet", filesystem=filesystem), load_manifest(spark, src, "22.06"), src.relative_prefix("lamps"))
        assert [r["status"] for r in rep.collect()] == ["ok", "ok"]
        assert read_dataset(spark, f"{d}/*.parquet", filesystem=filesystem).count() == 6


def test_schemes_without_a_reader_are_refused_before_any_work():
    from pyarrow import fs

    from relsync.sources.files import NoReader, locate, require_reader, split_uri

    for uri in ("ftp://host/pub/x.parquet", "https://host/x"):
        with pytest.raises(NoReader, match="filesystem"):
            require_reader(uri)
        require_reader(uri, fs.LocalFileSystem())
    assert locate("ftp://host/pub/x", fs.LocalFileSystem())[1] == "host/pub/x"
    assert split_uri("file:/a b/c") == ("file", "", "/a b/c") and split_uri("s3a://b/k%20") == ("s3a", "b", "/k%20")
    assert split_uri("/plain/x") == ("file", "", "/plain/x") and locate("file:///a b")[1] == "/a b"


def _write(spark, root, *tables):
    write_release(root, "23.01", {"x": list(tables)})
    return f"{Source(root).dataset_dir('23.01', 'x')}/*.parquet"


def test_strict_mode_compares_columns_nested_fields_and_types(spark, tmp_path):
    base = {"Key": pa.array([1]), "pos": pa.array([{"x": 1.0, "tags": [{"n": 1}]}])}
    cases = {
        "same": ({"KEY": pa.array([2]), "pos": pa.array([{"x": 2.0, "tags": [{"n": 2}], "more": 1}]), "extra": pa.array([1])}, None),
        "narrower": ({"key": pa.array([2], pa.int32()), "pos": base["pos"]}, None),
        "lacks": ({"pos": base["pos"]}, "lacks.*key"),
        "nested": ({"key": pa.array([2]), "pos": pa.array([{"x": 2.0, "tags": [{"m": 1}]}])}, r"pos\.tags\.\[\]\.n"),
        "retyped": ({"key": pa.array(["2"]), "pos": base["pos"]}, "other types.*key"),
    }
    for name, (other, error) in cases.items():
        pattern = _write(spark, str(tmp_path / name), table(**base), table(**other))
        if error:
            with pytest.raises(SchemaMismatch, match=error):
                read_dataset(spark, pattern, mode="strict")
        else:
            assert sorted(r["Key"] for r in read_dataset(spark, pattern, mode="strict").collect()) in ([1, 2], [1, 2])
    first = read_dataset(spark, str(tmp_path / "lacks") + "/23.01/output/etl/parquet/x/*.parquet", mode="first")
    assert sorted(r["Key"] for r in first.collect() if r["Key"]) == [1]


def test_merge_mode_widens_numbers_and_structs(spark, tmp_path):
    pattern = _write(
        spark, str(tmp_path / "m"),
        table(k=pa.array([1]), v=pa.array([7], pa.int64()), s=pa.array([{"a": 1}]), l=pa.array([[1, 2]], pa.list_(pa.int64()))),
        table(k=pa.array([2]), v=pa.array([0.5]), s=pa.array([{"a": 2.5, "b": "x"}]), l=pa.array([[0.5]])),
        table(k=pa.array([3], pa.int32()), n=pa.array(["only here"])),
    )
    df = read_dataset(spark, pattern, mode="merge")
    assert dict(df.dtypes) == {"k": "bigint", "v": "double", "s": "struct<a:double,b:string>", "l": "array<double>", "n": "string"}
    got = {r["k"]: r for r in df.collect()}
    assert got[1]["v"] == 7.0 and tuple(got[1]["s"]) == (1.0, None) and got[1]["l"] == [1.0, 2.0]
    assert got[2]["v"] == 0.5 and tuple(got[2]["s"]) == (2.5, "x") and got[3]["n"] == "only here" and got[3]["s"] is None


def test_datasets_are_found_beside_the_data_template(spark, tmp_path):
    write_release(str(tmp_path / "r"), "22.06", {"lamps": [lamps(2)]})
    plain = Source(str(tmp_path / "r"))
    data = plain.parquet_root("{version}") + "/{dataset_name}/"
    assert Source("x", data_template=data).parquet_root("22.06") == plain.parquet_root("22.06")
    assert Source("x", data_template=data, datasets_template="/other/{version}/").parquet_root("22.06") == "/other/22.06"
    assert Source("x", data_template="/d/{version}/{dataset_name}/parquet").parquet_root("22.06") == "/d/22.06"


def test_empty_file_between_full_ones_is_read(spark, tmp_path):
    root = str(tmp_path / "r")
    full = table(id=pa.array(["a", "b"]), value=pa.array([1, 2], pa.int64()))
    empty = full.slice(0, 0)
    write_release(root, "23.01", {"x": [full, empty, full]})
    src = Source(root)
    df = read_dataset(spark, f"{src.dataset_dir('23.01', 'x')}/*.parquet")
    assert df.count() == 4
    rep = footer_report(spark, spark.createDataFrame([(src.dataset_dir('23.01', 'x') + "/part-00001.parquet",)], "path string"),
                        src.dataset_dir('23.01', 'x') + "/part-00000.parquet").collect()
    assert list(rep[0]["missing"]) == []


def test_last_listing_wins_across_many_splits(spark, tmp_path):
    p = tmp_path / "big_manifest"
    lines = [f"{i:040x}  ./output/etl/parquet/d/part-{i:05d}.parquet" for i in range(3000)]
    lines[10] = "a" * 40 + "  ./output/etl/parquet/d/dup.parquet"
    lines[2990] = "b" * 40 + "  output/etl/parquet/d/dup.parquet"
    p.write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_manifest(spark, str(p))
        assert spark.read.text(str(p)).rdd.getNumPartitions() > 10
        got = {r["path"]: r["sha1"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got["output/etl/parquet/d/dup.parquet"] == "b" * 40
    assert len(got) == 2999


def test_malformed_manifest_line_fails(spark, tmp_path):
    root = str(tmp_path / "r")
    write_release(root, "22.06", {"x": [table(id=pa.array([1]))]}, extra_lines=["deadbeef"])
    with pytest.raises(ManifestError, match="malformed"):
        load_manifest(spark, Source(root), "22.06")


def test_merge_mode_widens_types_across_files(spark, tmp_path):
    root = str(tmp_path / "r")
    t1 = table(id=pa.array(["a"]), n=pa.array([1], pa.int32()), x=pa.array([0.5], pa.float32()))
    t2 = table(id=pa.array(["b"]), n=pa.array([2**40], pa.int64()), y=pa.array(["new"]))
    t3 = table(id=pa.array(["c"]), n=pa.array([3], pa.int32()), x=pa.array([1.5], pa.float64()))
    write_release(root, "23.01", {"x": [t1, t2, t3]})
    src = Source(root)
    df = read_dataset(spark, f"{src.dataset_dir('23.01', 'x')}/*.parquet", mode="merge")
    assert df.dtypes == [("id", "string"), ("n", "bigint"), ("x", "double"), ("y", "string")]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("a", 1, 0.5, None), ("b", 2**40, None, "new"), ("c", 3, 1.5, None)]


def test_infer_schema_from_first_file_and_incompatible_merge(spark, tmp_path):
    from relsync.sources.parquet import infer_schema
    root = str(tmp_path / "r")
    t1 = table(id=pa.array(["a"]), n=pa.array([1], pa.int64()))
    t2 = table(id=pa.array(["b"]), n=pa.array(["text"]))
    write_release(root, "23.01", {"x": [t1, t2]})
    d = Source(root).dataset_dir("23.01", "x")
    files = [f"{d}/part-00001.parquet", f"{d}/part-00000.parquet"]
    assert infer_schema(spark, files).simpleString() == "struct<id:string,n:bigint>"
    with pytest.raises(ValueError):
        infer_schema(spark, [])
    with pytest.raises(SchemaMismatch, match="cannot combine"):
        read_dataset(spark, f"{d}/*.parquet", mode="merge")
