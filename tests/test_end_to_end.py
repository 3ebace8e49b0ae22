import datetime as dt
import os
import uuid

import pyarrow as pa
import pytest

from relsync.operators.checks import KeyViolation
from relsync.plans import ledger as L
from relsync.plans.release_load import load_order, load_release
from relsync.plans.sink import CatalogSink
from relsync.plans.validate import check_specs, require_checks, run_checks
from relsync.spec import DatasetSpec, ForeignKey, Source
from relsync.streaming.release_watch import watch_releases
from tests.release_tree import table, write_release

LAMPS = table(lamp=pa.array([f"L{i}" for i in range(9)]), watt=pa.array([5 * i for i in range(9)], pa.int32()))
ROOMS = table(room=pa.array([10, 20, 30]), lamp=pa.array(["L1", None, "L8"]), area=pa.array([1.5, 2.25, None]))
SPECS = [DatasetSpec("lamps", ("lamp",)), DatasetSpec("rooms", ("room",))]
LAMP_ROWS = [(f"L{i}", 5 * i) for i in range(9)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def sink(spark):
    return CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8])


def outcomes(df):
    return {r["dataset"]: r for r in df.collect()}


def test_a_release_loads_once_unless_forced(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.06", {"lamps": [LAMPS.slice(0, 4), LAMPS.slice(4)], "rooms": [ROOMS]})
    out = outcomes(load_release(spark, SPECS, src, sink))
    assert {d: (r["status"], r["rows_loaded"], r["columns_added"]) for d, r in out.items()} == {
        "lamps": ("loaded", 9, None), "rooms": ("loaded", 3, None)}
    assert rows(sink.read("lamps")) == LAMP_ROWS
    assert {r["room"]: (r["lamp"], r["area"]) for r in sink.read("rooms").collect()} == {10: ("L1", 1.5), 20: (None, 2.25), 30: ("L8", None)}
    attempts = {(r["dataset_name"], r["version"], r["status"], r["rows_loaded"]) for r in sink.ledger().collect()}
    assert attempts == {("lamps", "22.06", "success", 9), ("rooms", "22.06", "success", 3)}
    again = outcomes(load_release(spark, SPECS, src, sink))
    assert {r["status"] for r in again.values()} == {"skipped_already_loaded"} and sink.ledger().count() == 2
    forced = outcomes(load_release(spark, SPECS, src, sink, force=True, statistics=True))
    assert {d: (r["inserted"], r["updated"], r["deleted"], r["unchanged"]) for d, r in forced.items()} == {
        "lamps": (0, 0, 0, 9), "rooms": (0, 0, 0, 3)}


def test_delta_then_new_release_merges(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.04", {"t": [table(id=pa.array([1, 2], pa.int64()),
                                                  data=pa.array(["a", "b"]))]})
    spec = [DatasetSpec("t", ("id",))]
    load_release(spark, spec, src, sink)
    gen1 = sink.generations("t")
    write_release(src.root, "22.06", {"t": [table(id=pa.array([2, 3], pa.int64()),
                                                  data=pa.array(["x", "c"]),
                                                  extra=pa.array([7, 8], pa.int32()))]})
    out = load_release(spark, spec, src, sink).collect()
    assert out[0]["version"] == "22.06" and out[0]["status"] == "loaded"
    assert rows(sink.read("t")) == [(2, "x", 7), (3, "c", 8)]
    assert sink.read("t").columns == ["id", "data", "extra"]
    assert len(sink.generations("t")) == 2 and gen1[0] in sink.generations("t")
    assert sink.last_success("t") == "22.06"


def test_a_load_reports_drift_and_counts(spark, tmp_path, sink):
    src, spec = Source(str(tmp_path / "rel")), [DatasetSpec("lamps", ("lamp",))]
    write_release(src.root, "22.04", {"lamps": [LAMPS.append_column("maker", pa.array(["m"] * 9))]})
    load_release(spark, spec, src, sink)
    ids = [f"L{i}" for i in range(3, 12)]
    new = table(lamp=pa.array(ids), watt=pa.array([5.0 * i if i != 5 else 1.0 for i in range(3, 12)]), colour=pa.array(["red"] * 9))
    write_release(src.root, "22.06", {"lamps": [new]})
    r = load_release(spark, spec, src, sink, statistics=True).first()
    assert (r["columns_added"], r["columns_retyped"], r["columns_removed"]) == (["colour"], ["watt"], ["maker"])
    assert (r["inserted"], r["updated"], r["deleted"], r["unchanged"]) == (3, 1, 3, 5)
    assert sink.read("lamps").where("maker = 'm'").count() == 6
    fractional = table(lamp=pa.array(["L1"]), watt=pa.array([2.7]))
    write_release(src.root, "22.09", {"lamps": [fractional]})
    bad = load_release(spark, spec, src, sink).first()
    assert bad["status"] == "failed" and "cannot hold" in bad["message"] and sink.read("lamps").count() == 9


def test_foreign_keys_are_checked_before_publishing(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    specs = [DatasetSpec("rooms", ("room",), foreign_keys=[{"columns": "lamp", "table": "lamps", "references": "lamp"}]), SPECS[0]]
    assert [[s.name for s in w] for w in load_order(specs)] == [["lamps"], ["rooms"]]
    write_release(src.root, "22.04", {"lamps": [LAMPS], "rooms": [ROOMS]})
    assert {r["status"] for r in outcomes(load_release(spark, specs, src, sink)).values()} == {"loaded"}
    write_release(src.root, "22.06", {"lamps": [LAMPS.slice(0, 8)], "rooms": [ROOMS]})
    out = outcomes(load_release(spark, specs, src, sink))
    assert out["lamps"]["status"] == "loaded" and out["rooms"]["status"] == "failed" and "L8" in out["rooms"]["message"]
    assert len(sink.generations("rooms")) == 1 and sink.last_success("rooms") == "22.04"
    lonely = DatasetSpec("rooms", ("room",), foreign_keys=[ForeignKey("lamp", "nowhere", "lamp")])
    assert "nowhere" in load_release(spark, [lonely], src, sink).first()["message"]
    circle = [DatasetSpec("a", ("k",), foreign_keys=[ForeignKey("k", "b", "k")]), DatasetSpec("b", ("k",), foreign_keys=[ForeignKey("k", "a", "k")])]
    assert [len(w) for w in load_order(circle)] == [2]
    with pytest.raises(ValueError):
        ForeignKey(("a", "b"), "t", ("a",))


def test_a_plain_table_is_taken_over_and_a_foreign_view_is_not(spark, tmp_path, sink):
    src, spec = Source(str(tmp_path / "rel")), [DatasetSpec("lamps", ("lamp",))]
    write_release(src.root, "22.06", {"lamps": [LAMPS]})
    sink.ensure_database()
    old = spark.createDataFrame([("L1", 1, "kept"), ("gone", 2, "x")], "lamp string, watt bigint, note string")
    old.write.saveAsTable(sink.fq("lamps"))
    r = load_release(spark, spec, src, sink, statistics=True).first()
    assert r["status"] == "loaded" and (r["inserted"], r["updated"], r["deleted"]) == (8, 1, 1)
    assert {x["lamp"] for x in sink.read("lamps").where("note = 'kept'").collect()} == {"L1"}
    assert len(sink.published("lamps")) == 2 and rows(spark.table(sink.fq(sink.published("lamps")[1]))) == rows(old)
    spark.sql(f"CREATE VIEW {sink.fq('rooms')} AS SELECT 1 AS room")
    write_release(src.root, "22.09", {"rooms": [ROOMS]})
    out = load_release(spark, [SPECS[1]], src, sink).first()
    assert out["status"] == "failed" and "view of something else" in out["message"] and not sink.generations("rooms")


def test_whatever_fails_while_publishing_leaves_nothing_behind(spark, tmp_path):
    class Broken(CatalogSink):
        def _point(self, table, kept):
            raise RuntimeError("catalog gone")

    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.06", {"lamps": [LAMPS]})
    for plain in (False, True):
        sink = Broken(spark, database="db_" + uuid.uuid4().hex[:8])
        sink.ensure_database()
        if plain:
            spark.createDataFrame([("L1", 1)], "lamp string, watt bigint").write.saveAsTable(sink.fq("lamps"))
        for _ in range(2):
            out = load_release(spark, [SPECS[0]], src, sink).first()
            assert out["status"] == "failed" and "catalog gone" in out["message"]
            assert sink.generations("lamps") == []
        assert sink.exists("lamps") == plain and (not plain or rows(sink.read("lamps")) == [("L1", 1)])


@pytest.mark.parametrize("keep", [1, 2, 4])
def test_as_many_generations_are_kept_as_asked_for(spark, keep):
    sink = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8], keep_generations=keep)
    for i in range(5):
        sink.replace("t", spark.createDataFrame([(i,)], "id bigint"), ["id"])
        assert len(sink.generations("t")) == min(keep, i + 1) and sink.current_generation("t") == sink.published("t")[0]
    assert [rows(spark.table(sink.fq(g))) for g in sink.published("t")] == [[(4 - i,)] for i in range(keep)]
    with pytest.raises(ValueError):
        CatalogSink(spark, keep_generations=0)


def test_full_refresh_replaces(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    sink.replace("lamps", spark.createDataFrame([("old", True)], "lamp string, broken boolean"), ["lamp"])
    write_release(src.root, "22.06", {"lamps": [LAMPS]})
    load_release(spark, [SPECS[0]], src, sink, load_type="full")
    assert rows(sink.read("lamps")) == LAMP_ROWS


def test_null_key_fails_and_table_is_unchanged(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.04", {"t": [table(id=pa.array(["a"]), value=pa.array([1], pa.int64()))]})
    spec = [DatasetSpec("t", ("id",))]
    load_release(spark, spec, src, sink)
    write_release(src.root, "22.06", {"t": [table(id=pa.array([None], pa.string()),
                                                  value=pa.array([1], pa.int64()))]})
    out = load_release(spark, spec, src, sink).collect()
    assert out[0]["status"] == "failed" and "null_key" in out[0]["message"]
    assert rows(sink.read("t")) == [("a", 1)]
    last = sink.ledger().orderBy("load_timestamp").collect()[-1]
    assert last["status"] == "failure" and last["rows_loaded"] == 0 and "\n" not in last["error_message"]
    assert sink.last_success("t") == "22.04"  # the failure does not hide the earlier success
    with pytest.raises(KeyViolation):
        load_release(spark, spec, src, sink, continue_on_error=False)


def test_bad_checksum_fails_dataset_others_continue(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    rel = write_release(src.root, "22.06", {"lamps": [LAMPS], "rooms": [ROOMS]})
    with open(os.path.join(rel, "output/etl/parquet/lamps/part-00000.parquet"), "ab") as f:
        f.write(b"tampered")
    out = {r["dataset"]: r["status"] for r in load_release(spark, SPECS, src, sink).collect()}
    assert out == {"lamps": "failed", "rooms": "loaded"}
    assert not sink.exists("lamps")


def test_empty_dataset_loads_zero_rows(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    empty = table(id=pa.array([], pa.string()), value=pa.array([], pa.int64()))
    write_release(src.root, "22.06", {"t": [empty]})
    out = load_release(spark, [DatasetSpec("t", ("id",))], src, sink).collect()
    assert out[0]["status"] == "loaded" and out[0]["rows_loaded"] == 0
    assert sink.read("t").count() == 0


def test_rules_apply_end_to_end(spark, tmp_path, sink):
    src, n = Source(str(tmp_path / "rel")), 12
    t = pa.table({
        "floor": pa.array([i // 4 for i in range(n)]), "door": pa.array([i % 4 for i in range(n)]),
        "sign": pa.array([(f"no {i}", i % 2 == 0) for i in range(n)], pa.struct([("text", pa.string()), ("lit", pa.bool_())])), "seen": pa.array([[i, None] for i in range(n)]),
    })
    write_release(src.root, "22.06", {"front-doors": [t]})
    spec = DatasetSpec("front-doors", ("floor", "door"), sep="__", overrides={"sign": {"action": "flatten"}, "door": {"rename": "number"}})
    load_release(spark, [spec], src, sink)
    df = sink.read("front_doors")
    assert df.columns == ["floor", "number", "sign__text", "sign__lit", "seen"]
    assert rows(df) == [(i // 4, i % 4, f"no {i}", i % 2 == 0, f"[{i},null]") for i in range(n)]


def test_preflight_checks(spark, tmp_path):
    src = Source(str(tmp_path / "none"))
    rep = {r["check"]: r for r in run_checks(spark, src, [DatasetSpec("x")]).collect()}
    assert not rep["source"]["success"] and not rep["datasets"]["success"]
    assert "x" in rep["datasets"]["message"]
    with pytest.raises(RuntimeError, match="pre-flight"):
        require_checks(run_checks(spark, src, SPECS))
    assert check_specs([]) == (False, "no datasets are defined")


def test_ledger_last_success_and_latest_per_dataset(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows_ = [
        L.ledger_row("22.04", "a", True, 5, t0, t0, load_timestamp=t0),
        L.ledger_row("22.06", "a", False, 0, t0, t0, "boom\nline2", load_timestamp=t0 + dt.timedelta(1)),
        L.ledger_row("22.02", "b", True, 3, t0, t0, load_timestamp=t0 + dt.timedelta(2)),
    ]
    led = L.ledger_frame(spark, rows_)
    assert L.last_success_version(led, "a") == "22.04"
    assert L.last_success_version(led, "zzz") is None
    got = sorted((r["dataset_name"], r["version"]) for r in L.latest_per_dataset(led).collect())
    assert got == [("a", "22.04"), ("b", "22.02")]
    assert sorted(tuple(r) for r in L.latest_per_dataset_window(led).collect()) == sorted(
        tuple(r) for r in L.latest_per_dataset(led).collect())
    assert led.where("status = 'failure'").first()["error_message"] == "boom line2"


def test_release_watcher_loads_new_releases_once(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.04", {"t": [table(id=pa.array([1], pa.int64()))]})
    spec = [DatasetSpec("t", ("id",))]
    ckpt = str(tmp_path / "ckpt")
    watch_releases(spark, src, spec, sink, checkpoint=ckpt).awaitTermination(120)
    assert sink.last_success("t") == "22.04"
    write_release(src.root, "22.06", {"t": [table(id=pa.array([1, 2], pa.int64()))]})
    watch_releases(spark, src, spec, sink, checkpoint=ckpt).awaitTermination(120)
    assert sink.last_success("t") == "22.06"
    assert rows(sink.read("t")) == [(1,), (2,)]
    n = sink.ledger().count()
    watch_releases(spark, src, spec, sink, checkpoint=ckpt).awaitTermination(120)
    assert sink.ledger().count() == n


def test_release_watcher_never_goes_back(spark, tmp_path, sink):
    src, spec, ckpt = Source(str(tmp_path / "rel")), [DatasetSpec("t", ("id",))], str(tmp_path / "ckpt")
    write_release(src.root, "23.01", {"t": [table(id=pa.array([1, 2, 3]))]})
    watch_releases(spark, src, spec, sink, checkpoint=ckpt).awaitTermination(120)
    write_release(src.root, "22.04", {"t": [table(id=pa.array([1]))]})
    watch_releases(spark, src, spec, sink, checkpoint=ckpt).awaitTermination(120)
    assert sink.last_success("t") == "23.01" and sink.read("t").count() == 3 and sink.ledger().count() == 1


def test_release_watcher_tries_a_failed_release_again(spark, tmp_path, sink):
    src, spec, ckpt = Source(str(tmp_path / "rel")), [DatasetSpec("t", ("id",))], str(tmp_path / "ckpt")
    rel = write_release(src.root, "23.01", {"t": [table(id=pa.array([1, 2, 3]))]})
    part = os.path.join(rel, "output/etl/parquet/t/part-00000.parquet")
    whole = open(part, "rb").read()
    open(part, "ab").write(b"tampered")
    with pytest.raises(Exception, match="mismatch"):
        watch_releases(spark, src, spec, sink, checkpoint=ckpt).awaitTermination(120)
    assert sink.last_success("t") is None
    open(part, "wb").write(whole)
    watch_releases(spark, src, spec, sink, checkpoint=ckpt).awaitTermination(120)
    assert sink.last_success("t") == "23.01" and sink.read("t").count() == 3


def test_bucketed_generations(spark, tmp_path):
    sink = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8], bucket_by_key=4)
    first = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id bigint, data string")
    assert sink.merge("t", first, ["id"]) == 50
    second = spark.createDataFrame([(i, f"w{i}") for i in range(25, 75)], "id bigint, data string")
    assert sink.merge("t", second, ["id"]) == 50
    assert rows(sink.read("t")) == [(i, f"w{i}") for i in range(25, 75)]
    gen = sink.generations("t")[-1]
    desc = {r["col_name"]: r["data_type"] for r in
            spark.sql(f"DESCRIBE TABLE EXTENDED {sink.fq(gen)}").collect()}
    assert desc.get("Num Buckets") == "4"
    files = spark.table(sink.fq(gen)).inputFiles()
    assert len(files) <= 4


def test_going_back_to_an_older_release_reloads(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.04", {"t": [table(id=pa.array([1], pa.int64()))]})
    write_release(src.root, "22.06", {"t": [table(id=pa.array([1, 2], pa.int64()))]})
    spec = [DatasetSpec("t", ("id",))]
    load_release(spark, spec, src, sink)                       # newest: 22.06
    out = load_release(spark, spec, src, sink, version="22.04").collect()
    assert out[0]["status"] == "loaded"                        # only the latest success counts
    assert rows(sink.read("t")) == [(1,)]
    assert load_release(spark, spec, src, sink, version="22.04").collect()[0]["status"] == \
        "skipped_already_loaded"


def test_missing_key_column_fails_clearly(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.06", {"t": [table(ident=pa.array([1], pa.int64()))]})
    out = load_release(spark, [DatasetSpec("t", ("id",))], src, sink).collect()
    assert out[0]["status"] == "failed" and "not in the projected data" in out[0]["message"]


def test_sink_interface_contract():
    from relsync.plans.sink import Sink

    class Partial(Sink):
        def exists(self, table):
            return False

    with pytest.raises(TypeError):
        Partial()
    assert issubclass(CatalogSink, Sink)


def test_manifest_listing_non_parquet_files_still_verifies(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    rel = write_release(src.root, "22.06", {"t": [table(id=pa.array([1], pa.int64()))]},
                        extra_lines=["0" * 40 + "  ./output/etl/parquet/t/_SUCCESS",
                                     "1" * 40 + "  ./output/etl/parquet/t/sub/part-0.parquet"])
    open(os.path.join(rel, "output/etl/parquet/t/_SUCCESS"), "w").close()
    out = load_release(spark, [DatasetSpec("t", ("id",))], src, sink).collect()
    assert out[0]["status"] == "loaded"


def test_checksums_and_data_in_separate_trees(spark, tmp_path, sink):
    import shutil
    data_root = str(tmp_path / "objectstore")
    check_root = str(tmp_path / "ftp")
    write_release(data_root, "22.06", {"t": [table(id=pa.array([1, 2], pa.int64()))]})
    os.makedirs(os.path.join(check_root, "22.06"))
    for f in ("release_data_integrity", "release_data_integrity.sha1"):
        shutil.move(os.path.join(data_root, "22.06", f), os.path.join(check_root, "22.06", f))
    src = Source(check_root, release_template=check_root + "/{version}/",
                 data_template=data_root + "/{version}/output/etl/parquet/{dataset_name}/")
    out = load_release(spark, [DatasetSpec("t", ("id",))], src, sink).collect()
    assert (out[0]["version"], out[0]["status"]) == ("22.06", "loaded")
    assert rows(sink.read("t")) == [(1,), (2,)]


def test_merge_into_bucketed_table_shuffles_only_staging(spark):
    import contextlib
    import io
    from pyspark.sql import functions as F
    from relsync.operators.merge import merge_snapshot
    sink = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8], bucket_by_key=8)
    first = spark.range(1000).select("id", (F.col("id") * 2).alias("old_col"), F.lit("x").alias("data"))
    sink.merge("t", first, ["id"])
    staging = spark.range(500, 1500).select("id", F.lit("y").alias("data"))
    merged = merge_snapshot(staging, sink.read("t"), ["id"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            merged.explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plan = buf.getvalue()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan


def test_failed_verification_discards_the_staged_generation(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.04", {"t": [table(id=pa.array([1], pa.int64()))]})
    spec = [DatasetSpec("t", ("id",))]
    load_release(spark, spec, src, sink)
    gens = sink.generations("t")
    rel = write_release(src.root, "22.06", {"t": [table(id=pa.array([1, 2], pa.int64()))]})
    with open(os.path.join(rel, "output/etl/parquet/t/part-00000.parquet"), "ab") as f:
        f.write(b"tampered")
    out = load_release(spark, spec, src, sink).collect()
    assert out[0]["status"] == "failed" and "mismatch" in out[0]["message"]
    assert sink.generations("t") == gens          # the written generation was dropped
    assert rows(sink.read("t")) == [(1,)]


from relsync.plans.sink import Sink  # noqa: E402


class DictSink(Sink):
    """A third-party target: keeps published snapshots in a dict (no two-phase write)."""

    def __init__(self, spark):
        self.spark, self.tables, self.rows = spark, {}, []

    def ensure_database(self):
        pass

    def exists(self, table):
        return table in self.tables

    def read(self, table):
        return self.tables[table]

    def replace(self, table, df, keys):
        self.tables[table] = self.spark.createDataFrame(df.collect(), df.schema)  # tiny test data
        return self.tables[table].count()

    def merge(self, table, df, keys):
        from relsync.operators.merge import merge_snapshot
        current = self.tables.get(table)
        return self.replace(table, merge_snapshot(df, current, keys), keys)

    def ledger(self):
        return L.ledger_frame(self.spark, self.rows)

    def record(self, row):
        self.rows.append(row)


def test_third_party_sink(spark, tmp_path):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.06", {"lamps": [LAMPS]})
    sink = DictSink(spark)
    out = load_release(spark, [SPECS[0]], src, sink).collect()
    assert out[0]["status"] == "loaded" and rows(sink.read("lamps")) == LAMP_ROWS
    assert load_release(spark, [SPECS[0]], src, sink).collect()[0]["status"] == "skipped_already_loaded"


def test_unpublished_generation_from_a_crashed_load_is_cleaned(spark):
    sink = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8])
    sink.replace("t", spark.createDataFrame([(1,)], "id bigint"), ["id"])
    first = sink.current_generation("t")
    orphan = sink.stage("t", spark.createDataFrame([(9,)], "id bigint"), ["id"], "full")  # never published
    assert rows(sink.read("t")) == [(1,)] and len(sink.generations("t")) == 2
    sink.replace("t", spark.createDataFrame([(2,)], "id bigint"), ["id"])
    gens = sink.generations("t")
    assert first in gens and sink.current_generation("t") in gens and len(gens) == 2
    assert rows(sink.read("t")) == [(2,)]
    del orphan


def test_unreachable_target_stops_before_any_work(spark, tmp_path):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.06", {"lamps": [LAMPS]})

    class Down(CatalogSink):
        def ensure_database(self):
            raise ConnectionError("catalog down")

    with pytest.raises(RuntimeError, match="target not reachable: catalog down"):
        load_release(spark, [SPECS[0]], src, Down(spark, "down"))
    rep = {r["check"]: r["success"] for r in
           run_checks(spark, src, SPECS, sink=CatalogSink(spark, "up_db")).collect()}
    assert rep == {"target": True, "source": True, "datasets": True}


def test_a_source_that_tasks_cannot_read_stops_before_any_work(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"), data_template="ftp://host/{version}/{dataset_name}/")
    write_release(src.root, "22.06", {"lamps": [LAMPS]})
    with pytest.raises(RuntimeError, match="readers: .*ftp.*filesystem"):
        load_release(spark, [SPECS[0]], src, sink)
    assert sink.ledger().count() == 0


def test_compact_ledger(spark):
    import datetime as dt_
    sink = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8])
    t0 = dt_.datetime(2024, 1, 1)
    for i in range(4):
        sink.record(L.ledger_row(f"22.0{i}", "a", True, i, t0, t0,
                                 load_timestamp=t0 + dt_.timedelta(days=i)))
    assert len(sink.ledger().inputFiles()) == 4
    assert sink.compact_ledger() == 4
    assert len(sink.ledger().inputFiles()) == 1
    assert sink.last_success("a") == "22.03" and sink.ledger().count() == 4


def test_a_compaction_cut_short_is_completed(spark):
    sink = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8])
    t0 = dt.datetime(2024, 1, 1)
    for i in range(3):
        sink.record(L.ledger_row(f"22.0{i + 1}", "a", True, i, t0, t0, load_timestamp=t0 + dt.timedelta(days=i)))
    done = sink.fq(f"{sink.ledger_table}__compact_000000000000001_x")
    sink.ledger().write.saveAsTable(done)
    spark.sql(f"DROP TABLE {sink.fq(sink.ledger_table)}")  # the process ended before the rename
    assert sink.last_success("a") == "22.03" and sink.ledger().count() == 3
    sink.ledger().write.saveAsTable(done)                    # and here before the drop
    assert sink.compact_ledger() == 3 and not spark.catalog.tableExists(done.replace("`", ""))


def test_loads_at_one_instant_agree(spark):
    t0 = dt.datetime(2024, 1, 1)
    led = L.ledger_frame(spark, [L.ledger_row(f"22.{i:02d}", "a", True, i, t0, t0, run_id=f"r{(i * 5) % 7}", load_timestamp=t0) for i in range(7)])
    want = max((f"r{(i * 5) % 7}", f"22.{i:02d}") for i in range(7))[1]
    assert L.last_success_version(led, "a") == want
    assert [r["version"] for r in L.latest_per_dataset(led).collect()] == [want]
    assert [r["version"] for r in L.latest_per_dataset_window(led).collect()] == [want]
