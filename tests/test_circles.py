"""Tables that refer to each other: staged, checked and published as one commit."""

import uuid

import pyarrow as pa
import pytest

from relsync.operators.merge import OPS, merge_counted, merge_counts, merge_snapshot
from relsync.plans.release_load import load_dataset, load_groups, load_release
from relsync.plans.sink import CatalogSink
from relsync.spec import DatasetSpec, ForeignKey, Source
from tests.release_tree import table, write_release

TEAM = DatasetSpec("teams", ("team",), foreign_keys=[ForeignKey("lead", "people", "person")])
PERSON = DatasetSpec("people", ("person",), foreign_keys=[ForeignKey("team", "teams", "team"), ForeignKey("boss", "people", "person")])
BADGE = DatasetSpec("badges", ("badge",), foreign_keys=[ForeignKey("person", "people", "person")])
SPECS = [BADGE, TEAM, PERSON]


def teams(*rows):
    return table(team=pa.array([t for t, _ in rows]), lead=pa.array([p for _, p in rows], pa.int64()))


def people(*rows):
    return table(person=pa.array([p for p, _, _ in rows]), team=pa.array([t for _, t, _ in rows]), boss=pa.array([b for _, _, b in rows], pa.int64()))


def badges(*rows):
    return table(badge=pa.array([b for b, _ in rows]), person=pa.array([p for _, p in rows]))


FIRST = {"teams": [teams(("a", 1), ("b", None))], "people": [people((1, "a", None), (2, "b", 1))], "badges": [badges(("x", 2))]}


@pytest.fixture
def sink(spark):
    return CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8])


def statuses(df):
    return {r["dataset"]: r["status"] for r in df.collect()}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_groups_are_circles_in_order():
    def names(specs):
        return [[[s.name for s in g] for g in w] for w in load_groups(specs)]

    assert names(SPECS) == [[["teams", "people"]], [["badges"]]]
    chain = [DatasetSpec("c", foreign_keys=[ForeignKey("x", "b", "x")]), DatasetSpec("b", foreign_keys=[ForeignKey("x", "a", "x")]), DatasetSpec("a")]
    assert names(chain) == [[["a"]], [["b"]], [["c"]]]
    ring = [DatasetSpec(n, foreign_keys=[ForeignKey("x", t, "x")]) for n, t in ("ab", "bc", "ca", "da", "ed")]
    assert names(ring) == [[["a", "b", "c"]], [["d"]], [["e"]]]
    two = [DatasetSpec(n, foreign_keys=[ForeignKey("x", t, "x")]) for n, t in ("ab", "ba", "cd", "dc")]
    assert names(two) == [[["a", "b"], ["c", "d"]]] and names([]) == []


def test_a_circle_loads_first_and_again(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.04", FIRST)
    assert set(statuses(load_release(spark, SPECS, src, sink)).values()) == {"loaded"}
    write_release(src.root, "22.06", {
        "teams": [teams(("b", 3), ("c", 2))], "people": [people((2, "c", 3), (3, "b", 3))], "badges": [badges(("x", 3))]})
    out = load_release(spark, SPECS, src, sink, statistics=True, max_workers=1).collect()
    assert {r["dataset"]: (r["status"], r["inserted"], r["updated"], r["deleted"]) for r in out} == {
        "teams": ("loaded", 1, 1, 1), "people": ("loaded", 1, 1, 1), "badges": ("loaded", 0, 1, 0)}
    assert rows(sink.read("people")) == [(2, "c", 3), (3, "b", 3)] and sink.decided() == {}
    assert statuses(load_release(spark, SPECS, src, sink)) == dict.fromkeys(["teams", "people", "badges"], "skipped_already_loaded")


@pytest.mark.parametrize("bad, message", [
    ({"people": [people((1, "a", None), (2, "nowhere", 1))]}, "nowhere"),  # a reference to the other member
    ({"people": [people((1, "a", 9), (2, "b", 1))]}, "9"),  # a reference to itself
    ({"people": [people((1, "a", None), (1, "b", None))]}, "duplicate_key"),  # fails while it is staged
])
def test_one_failure_leaves_all_members_as_before(spark, tmp_path, sink, bad, message):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.04", FIRST)
    load_release(spark, SPECS, src, sink)
    before = {t: (rows(sink.read(t)), sink.generations(t)) for t in ("teams", "people")}
    write_release(src.root, "22.06", {**FIRST, **bad})
    out = {r["dataset"]: r for r in load_release(spark, SPECS, src, sink).collect()}
    assert {d: out[d]["status"] for d in out} == {"teams": "failed", "people": "failed", "badges": "loaded"}
    assert message in out["people"]["message"] and "people" in out["teams"]["message"]
    assert {t: (rows(sink.read(t)), sink.generations(t)) for t in before} == before
    failed = sink.ledger().where("status = 'failure'").collect()
    assert sorted(r["dataset_name"] for r in failed) == ["people", "teams"]
    with pytest.raises(Exception):
        load_release(spark, SPECS, src, sink, continue_on_error=False, force=True)


def test_members_already_loaded_must_still_find_their_rows(spark, tmp_path, sink):
    src = Source(str(tmp_path / "rel"))
    write_release(src.root, "22.04", FIRST)
    load_release(spark, SPECS, src, sink)
    write_release(src.root, "22.06", {"teams": [teams(("a", 1))], "people": FIRST["people"]})
    # only one member is loaded: the other one's table still refers to team b
    alone = load_release(spark, [TEAM], src, sink).first()
    assert alone["status"] == "loaded"
    write_release(src.root, "22.09", {"teams": [teams(("a", 1))], "people": [people((1, "a", None))]})
    assert statuses(load_release(spark, [TEAM, PERSON], src, sink)) == {"teams": "loaded", "people": "loaded"}
    write_release(src.root, "22.11", {"teams": [teams(("z", 1))], "people": [people((1, "z", None))]})
    sink.record(("r", __import__("datetime").datetime(2100, 1, 1), None, None, "22.11", "people", 1, "success", None))
    out = {r["dataset"]: r for r in load_release(spark, [TEAM, PERSON], src, sink).collect()}
    assert out["people"]["status"] == "skipped_already_loaded" and out["teams"]["status"] == "failed"
    assert "people refers to teams" in out["teams"]["message"] and rows(sink.read("teams")) == [("a", 1)]


def test_a_table_that_refers_to_itself(spark, tmp_path, sink):
    src, spec = Source(str(tmp_path / "rel")), DatasetSpec("nodes", ("n",), foreign_keys=[ForeignKey("up", "nodes", "n")])
    write_release(src.root, "22.04", {"nodes": [table(n=pa.array([1, 2]), up=pa.array([None, 1], pa.int64()))]})
    assert load_dataset(spark, spec, src, "22.04", sink).status == "loaded"
    write_release(src.root, "22.06", {"nodes": [table(n=pa.array([2, 3]), up=pa.array([1, 2], pa.int64()))]})
    with pytest.raises(ValueError, match="orphan"):  # 1 is gone, though the published table has it
        load_dataset(spark, spec, src, "22.06", sink)
    assert rows(sink.read("nodes")) == [(1, None), (2, 1)]


class Dies(BaseException):
    """Stands for the end of the process."""


def frames(spark, n):
    return [spark.createDataFrame([(i, n)], "id bigint, gen int") for i in range(3)]


class Flaky(CatalogSink):
    broken = None

    def _point(self, table, kept):
        if self.broken and table == self.broken[0]:
            raise self.broken[1]
        super()._point(table, kept)


@pytest.mark.parametrize("existing", [False, True])
def test_an_error_between_two_switches_undoes_the_first(spark, existing):
    sink = Flaky(spark, database="db_" + uuid.uuid4().hex[:8])
    if existing:
        sink.publish_together([sink.stage(f"t{i}", df, ["id"], "delta") for i, df in enumerate(frames(spark, 1))])
    staged = [sink.stage(f"t{i}", df, ["id"], "delta") for i, df in enumerate(frames(spark, 2))]
    sink.broken = ("t2", RuntimeError("catalog gone"))
    with pytest.raises(RuntimeError):
        sink.publish_together(staged)
    for s in staged:
        s.discard()
    assert sink.decided() == {}
    for i in range(3):
        assert sink.exists(f"t{i}") == existing and len(sink.generations(f"t{i}")) == int(existing)
        assert not existing or rows(sink.read(f"t{i}")) == [(i, 1)]


def test_a_process_that_dies_between_two_switches_is_completed(spark, monkeypatch):
    sink = Flaky(spark, database="db_" + uuid.uuid4().hex[:8])
    sink.publish_together([sink.stage(f"t{i}", df, ["id"], "delta") for i, df in enumerate(frames(spark, 1))])
    staged = [sink.stage(f"t{i}", df, ["id"], "delta") for i, df in enumerate(frames(spark, 2))]
    target = {s.table: [s.generation, *sink.published(s.table)] for s in staged}
    # what a process leaves that decided, switched one view and was gone
    sink._decide(target)
    sink._point("t0", target["t0"])
    assert sink.decided() == target and rows(sink.read("t1")) == [(1, 1)]
    later = CatalogSink(spark, database=sink.database)
    later.ensure_database()  # the pre-flight check of the next load
    assert later.decided() == {} and later.recover() == []
    assert [rows(later.read(f"t{i}")) for i in range(3)] == [[(i, 2)] for i in range(3)]


def test_a_decided_commit_without_its_generations_is_dropped(spark):
    sink = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8])
    sink.replace("t0", frames(spark, 1)[0], ["id"])
    sink._decide({"t0": ["t0__g_never_written"], "t1": ["t1__g_neither"]})
    assert sink.recover() == ["t0", "t1"] and sink.decided() == {}
    assert rows(sink.read("t0")) == [(0, 1)] and not sink.exists("t1")


# --- a merge that counts what it does ---------------------------------------------------------
def test_a_counted_merge_equals_merge_and_counts(spark):
    final = spark.createDataFrame([(i, i % 3, "c%d" % i) for i in range(60)], "id bigint, v int, carried string")
    staging = spark.createDataFrame([(i, (i + (i % 7 == 0)) % 3, i) for i in range(20, 90)], "id bigint, v bigint, new bigint")
    merged, observed = merge_counted(staging, final, ["id"])
    assert merged.columns == ["id", "v", "carried", "new"]
    assert rows(merged) == rows(merge_snapshot(staging, final, ["id"]))
    merged.write.format("noop").mode("overwrite").save()
    want = merge_counts(staging, final, ["id"])
    assert {op: observed.get[op] for op in OPS} == {op: want[op] for op in OPS}
    assert want["insert"] == 30 and want["delete"] == 20 and want["update"] > 0


def test_a_counted_merge_shuffles_each_side_once(spark):
    final = spark.range(1000).selectExpr("id", "id % 5 AS v", "'x' AS carried")
    staging = spark.range(500, 1500).selectExpr("id", "id % 7 AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge_counted(staging, final, ["id"], check_keys=False)[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan


def test_counts_that_do_not_fit_the_rows_are_taken_again(spark, monkeypatch):
    sink = CatalogSink(spark, database="db_" + uuid.uuid4().hex[:8])
    sink.replace("t", spark.range(10).selectExpr("id", "0 AS v"), ["id"])

    class Twice:
        get = {"insert": 10, "update": 0, "delete": 10, "unchanged": 10}

    real = merge_counted
    monkeypatch.setattr("relsync.plans.sink.merge_counted", lambda *a: (real(*a)[0], Twice))
    staged = sink.stage("t", spark.range(5, 15).selectExpr("id", "0 AS v"), ["id"], "delta", statistics=True)
    assert {op: staged.counts[op] for op in OPS} == {"insert": 5, "update": 0, "delete": 5, "unchanged": 5}
